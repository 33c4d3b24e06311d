"""Mixing sources to target weights by iterative proportional fitting; DataFrame functions only.

Tokens are summed by cell (source, language, topic).  Sweeps rake the cells' weights to the target share of every
source, language and topic in turn, until all three are met.  A cell's sampling probability is proportional to weight over tokens, capped at
one, with the factor that makes the expected kept tokens the asked share of all (found exactly on the sorted cells).
Documents are kept where a hash of their id falls below their cell's probability.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arbora.llm.shared import discard, fresh, materialize, quoted

#: Sweeps of a round; rounds end when no margin is off its target by more than TOLERANCE, or after MOST_ROUNDS.
SWEEPS = 8
TOLERANCE = 1e-10
MOST_ROUNDS = 20
KEEP = 0.7
MARGINS = ("source", "lang", "topic")
#: Target share of a category is its token share to this power, made to add up to one.
TEMPER = {"source": 0.5, "lang": 0.7, "topic": 0.7}
Topics = list[tuple[str, str]]
#: The topics of a table without a topic column: names and SQL predicates on ``text``; the first that holds names it.
TOPICS: Topics = [("table", "contains(text, ' | ')"), ("licence", "contains(text, 'icense')"), ("markup", "contains(text, '&&&') or contains(text, '***')"), ("long", "length(text) > 4000"), ("short", "length(text) < 400")]
OTHER = "prose"


def tokens_of(text: str) -> Column:
    """An estimate that needs no tokenizer: a quarter of the UTF-8 bytes, at least one."""
    return F.greatest(F.lit(1), F.ceil(F.octet_length(F.coalesce(F.col(text), F.lit(""))) / 4)).cast("long")


def celled(docs: DataFrame, names: dict[str, str] | None = None, topics: Topics = TOPICS) -> DataFrame:
    """``docs`` with _source, _lang, _topic (nulls named) and _tokens, or with columns of the given names."""
    topic = F.lit(OTHER)
    for name, predicate in reversed(topics):
        topic = F.when(F.coalesce(F.expr(re.sub(r"\btext\b", "coalesce(text, '')", predicate)), F.lit(False)), F.lit(name)).otherwise(topic)
    none = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("(none)"))
    made = {"source": none("source"), "lang": none("lang"), "topic": topic, "tokens": tokens_of("text")}
    return docs.withColumns({(names or {}).get(k, f"_{k}"): c for k, c in made.items()})


def tempered(cells: DataFrame, margin: str, power: float) -> Column:
    """Target share of the row's category; over cells in one partition."""
    own = F.sum("tokens").over(Window.partitionBy(margin))
    # each category counts once: its power is dealt to its cells by their tokens
    each = F.pow(own, F.lit(power))
    return each / F.sum(each * F.col("tokens") / own).over(Window.partitionBy())


def _off(cells: DataFrame) -> float:
    """By how much the worst category misses its target."""
    worst = [F.max(F.abs(F.col(f"_held_{m}") - F.col(f"_{m}"))).alias(m) for m in MARGINS]
    held = cells.withColumns({f"_held_{m}": F.sum("weight").over(Window.partitionBy(m)) for m in MARGINS})
    return max((x for x in held.agg(*worst).first() if x is not None), default=0.0)


def probabilities(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, keep: float = KEEP, topics: Topics = TOPICS, tolerance: float = TOLERANCE) -> DataFrame:
    """(source, lang, topic, tokens, n_docs, weight, probability), a row a cell.

    ``targets``: by margin, explicit shares of categories; other margins are tempered.  Categories that an explicit
    margin leaves out get weight zero.  Targets that contradict each other are met as far as MOST_ROUNDS bring them.
    The cells, a few for each source, are raked in one task; documents are not.
    """
    rows = celled(docs.select("source", "lang", "text"), topics=topics).groupBy(F.col("_source").alias("source"), F.col("_lang").alias("lang"), F.col("_topic").alias("topic"))
    cells = materialize(rows.agg(F.sum("_tokens").alias("tokens"), F.count(F.lit(1)).alias("n_docs")), "cells").coalesce(1)
    for margin in MARGINS:
        if targets and margin in targets:
            shares = F.create_map(*[x for k, v in targets[margin].items() for x in (F.lit(k), F.lit(float(v) / sum(targets[margin].values())))])
            cells = cells.withColumn(f"_{margin}", F.coalesce(F.try_element_at(shares, F.col(margin)), F.lit(0.0)))
        else:
            cells = cells.withColumn(f"_{margin}", tempered(cells, margin, TEMPER[margin]))
    cells = cells.withColumn("weight", F.col("tokens") / F.sum("tokens").over(Window.partitionBy()))
    before = None
    for _ in range(MOST_ROUNDS):
        for margin in MARGINS * SWEEPS:
            held = F.sum("weight").over(Window.partitionBy(margin))
            cells = cells.withColumn("weight", F.when(held > 0, F.col("weight") * F.col(f"_{margin}") / held).otherwise(F.lit(0.0)))
        raked = materialize(cells, "raked")
        if before is not None:
            discard(before)
        before, cells = raked, raked.coalesce(1)
        if _off(cells) <= tolerance:
            break
    # capped proportional probabilities: the first k cells by rate are certain, the others share what is left
    cells = cells.withColumn("rate", F.col("weight") / F.col("tokens"))
    order = Window.orderBy(F.desc("rate"), *MARGINS)
    certain = F.coalesce(F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("tokens").over(Window.partitionBy())
    cells = cells.withColumn("_factor", F.when(rest > 0, (keep * total - certain) / rest))
    fits = F.when(F.col("_factor") * F.col("rate") <= 1, F.struct(F.lit(0) - F.col("rate"), *MARGINS, F.col("_factor").alias("f")))
    factor = F.min(fits).over(Window.partitionBy())["f"]
    p = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce(factor * F.col("rate"), F.lit(1.0))))
    return cells.withColumn("probability", p).select(*MARGINS, "tokens", "n_docs", "weight", "probability")


def uniform(doc_id: str = "doc_id") -> Column:
    """A number in [0, 1) from the id's MD5."""
    return F.conv(F.substring(F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 1, 8), 16, 10).cast("double") / 4294967296.0


def _drawn(docs: DataFrame, targets: dict | None, keep: float, topics: Topics) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with cell, tokens, weight, probability and selected, and the names of these columns."""
    names = {k: fresh(docs, f"_{k}") for k in (*MARGINS, "tokens", "weight", "probability", "selected")}
    cells = materialize(probabilities(docs, targets, keep, topics), "probabilities")
    cells = cells.select(*[F.col(k).alias(names[k]) for k in (*MARGINS, "weight", "probability")])
    rows = celled(docs, names, topics).join(cells, [names[m] for m in MARGINS])
    return rows.withColumn(names["selected"], uniform() < F.col(names["probability"])), names


def mixture(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, keep: float = KEEP, topics: Topics = TOPICS) -> DataFrame:
    """A row per row of ``docs``: doc_id, source, lang, topic, tokens, weight (its cell's), probability, selected.

    Null sources and languages are categories of their own, "(none)"; null and empty texts weigh one token.  Rows with
    one id, or a null id, are drawn alike.  An empty table gives none.  Other columns are not read.  Very long texts weigh
    by all their bytes.
    """
    drawn, names = _drawn(docs.select("doc_id", "source", "lang", "text"), targets, keep, topics)
    rounded = {k: F.round(names[k], 9) for k in ("weight", "probability")}
    return drawn.select("doc_id", *[F.col(names[k]).alias(k) for k in (*MARGINS, "tokens")], *[c.alias(k) for k, c in rounded.items()], F.col(names["selected"]).alias("selected"))


def sample(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, keep: float = KEEP, topics: Topics = TOPICS) -> DataFrame:
    """The drawn rows of ``docs``, all columns."""
    drawn, names = _drawn(docs, targets, keep, topics)
    return drawn.where(F.col(names["selected"])).select(*quoted(docs.columns))


def oracle_sql(sweeps: int = 24, keep: float = KEEP) -> str:
    """DuckDB SQL for mixture(), with as many sweeps as meet the tolerance on any of the test tables."""
    topic = " ".join(f"WHEN {p.replace('text', "coalesce(text, '')")} THEN '{n}'" for n, p in TOPICS)
    steps = ["d AS (SELECT doc_id, coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang, "
             f"CASE {topic} ELSE '{OTHER}' END AS topic, greatest(1, ceil(strlen(coalesce(text, '')) / 4.0))::BIGINT AS tokens, "
             "('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u FROM documents)",
             "c AS (SELECT source, lang, topic, sum(tokens)::DOUBLE AS tokens FROM d GROUP BY ALL)"]
    for m, power in TEMPER.items():
        steps.append(f"g_{m} AS (SELECT {m}, pow(sum(tokens), {power}) AS e FROM c GROUP BY {m})")
        steps.append(f"t_{m} AS (SELECT {m}, e / sum(e) OVER () AS t_{m} FROM g_{m})")
    steps.append("w0 AS (SELECT *, tokens / sum(tokens) OVER () AS weight FROM c JOIN t_source USING (source) JOIN t_lang USING (lang) JOIN t_topic USING (topic))")
    k = 0
    for _ in range(sweeps):
        for m in MARGINS:
            steps.append(f"w{k + 1} AS (SELECT * REPLACE (weight * t_{m} / sum(weight) OVER (PARTITION BY {m}) AS weight) FROM w{k})")
            k += 1
    steps += [f"r AS (SELECT *, weight / tokens AS rate FROM w{k})",
              f"f AS (SELECT *, ({keep} * sum(tokens) OVER () - coalesce(sum(tokens) OVER (ORDER BY rate DESC, source, lang, topic ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) "
              "/ sum(weight) OVER (ORDER BY rate DESC, source, lang, topic ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS factor FROM r)",
              "b AS (SELECT factor FROM f WHERE factor * rate <= 1 ORDER BY rate DESC, source, lang, topic LIMIT 1)",
              "p AS (SELECT source, lang, topic, weight, least(1.0, greatest(0.0, coalesce((SELECT factor FROM b) * rate, 1.0))) AS probability FROM r)"]
    return ("WITH " + ", ".join(steps) + " SELECT doc_id, source, lang, topic, tokens, round(weight, 9) AS weight, round(probability, 9) AS probability, u < probability AS selected FROM d JOIN p USING (source, lang, topic)")
