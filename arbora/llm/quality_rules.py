"""Quality rules whose cutoffs carry a risk guarantee; DataFrame functions only.

Each rule rejects a document whose metric exceeds a cutoff.  On labelled documents that pass the base rules, the
false rejections k among n good ones are tested for every stratum, rule and candidate cutoff with the exact binomial
test of "the false rejection rate is over alpha": P(Bin(n, alpha) <= k).  A cutoff is certified if that is at most
delta over the number of tests made (Bonferroni), where alpha is the allowed rate over the number of rules.  So with
probability 1 - delta every stratum falsely rejects at most ``allowed`` of its good documents.  Of the certified
cutoffs the one that rejects most bad documents for the good ones it costs is taken, the laxest of equals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arbora.llm.shared import lookup, materialize

ALLOWED = 0.05
DELTA = 0.05
GOOD_COST = 5
WINDOW = 8
CUTOFFS = [0.01, 0.03, 0.05, 0.1, 0.15, 0.2, 0.3, 0.5, 0.75, 1.0]
LENGTHS = [7.0, 8.0, 9.0, 10.0, 12.0, 15.0, 20.0, 30.0, 50.0, 100.0]
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

#: rule -> (metric over the measured columns, candidate cutoffs from strict to lax)
RULES: dict[str, tuple[str, list[float]]] = {
    "symbols": ("n_symbols / n_words", CUTOFFS),
    "dup_lines": ("n_dup_lines / greatest(n_lines, 1)", CUTOFFS),
    "repeat_words": ("n_repeat_words / n_words", CUTOFFS),
    "capitals": ("n_capitals / greatest(word_chars, 1)", CUTOFFS),
    "marks": ("n_marks / n_words", CUTOFFS),
    "word_length": ("word_chars / n_words", LENGTHS),
}


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once a row though ``body`` uses it in inner lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words of ``words`` that lie in a window found twice or more, the first find included.

    Hashes of the windows tell most texts to have none; only where two agree are the windows themselves sorted.
    """
    starts = F.sequence(F.lit(0), F.size(words) - window)

    def exact(w: Column) -> Column:
        keyed = F.array_sort(F.transform(F.sequence(F.lit(0), F.size(w) - window), lambda i: F.struct(F.array_join(F.slice(w, i + 1, window), " ").alias("k"), i.alias("i"))))
        same = lambda s, j, x: F.coalesce(F.get(s, j)["k"] == x["k"], F.lit(False))
        twice = let(keyed, lambda s: F.filter(s, lambda x, j: same(s, F.greatest(j - 1, F.lit(0)), x) & (j > 0) | same(s, j + 1, x)))
        at = F.array_sort(F.transform(twice, lambda x: x["i"]))
        step = lambda acc, i: F.struct((acc["n"] + i + window - F.greatest(i, acc["end"])).alias("n"), (i + window).alias("end"))
        return F.aggregate(at, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), step, lambda acc: acc["n"])

    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i + 1, window)))
    some = let(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return F.when(F.size(words) < window, F.lit(0)).when(some, exact(words)).otherwise(F.lit(0)).cast("long")


def measures(text: Column) -> Column:
    """The struct of counts of a whole text; null counts as empty."""
    text = F.coalesce(text, F.lit(""))

    def of(t: Column) -> Column:
        words = F.array_remove(F.split(t, "[\\x20\\x09-\\x0D]+"), "")
        lines = F.filter(F.split(t, "\n"), lambda line: F.translate(line, SPACES, "") != "")
        count = lambda chars: (F.length(t) - F.length(F.translate(t, chars, ""))).cast("long")
        of_words = let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("rep")))
        of_lines = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup")))
        return F.struct(
            of_words.alias("w"), of_lines.alias("l"), F.length(F.translate(t, SPACES, "")).cast("long").alias("word_chars"), count(SYMBOLS).alias("n_symbols"),
            count("ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("n_capitals"), count("!").alias("n_marks"),
        )

    return let(text, of)


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", stratum: str = "lang") -> DataFrame:
    """doc_id, stratum ("und" for null) and counts of every row, with the verdict of the base rules."""
    m = F.col("m")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(stratum).cast("string"), F.lit("und")).alias("stratum"), measures(F.col(text)).alias("m"))
    counts = {"n_words": m["w"]["n"], "n_repeat_words": m["w"]["rep"], "n_lines": m["l"]["n"], "n_dup_lines": m["l"]["dup"]} | {c: m[c] for c in ("word_chars", "n_symbols", "n_capitals", "n_marks")}
    rows = rows.select("doc_id", "stratum", *[c.alias(k) for k, c in counts.items()])
    return rows.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """ln P(Bin(n, p) <= k), exact but for rounding; 0 (no evidence) where k is over n p."""
    start = n * F.log(F.lit(1 - p))
    step = lambda acc, i: let(
        acc["t"] + F.log((n - i + 1) / i * (p / (1 - p))),
        lambda t: F.struct(t.alias("t"), (F.greatest(acc["s"], t) + F.log1p(F.exp(-F.abs(acc["s"] - t)))).alias("s")),
    )
    steps = F.when(k > 0, F.sequence(F.lit(1), k.cast("int"))).otherwise(F.array().cast("array<int>"))
    total = F.aggregate(steps, F.struct(start.alias("t"), start.alias("s")), step, lambda acc: acc["s"])
    return F.when(k > n * p, F.lit(0.0)).otherwise(total)


def level(rule: str) -> Column:
    """How many of the rule's cutoffs the metric exceeds."""
    metric, cuts = RULES[rule]
    exceeded = F.lit(0)
    for c in cuts:
        exceeded = exceeded + (F.expr(metric) > c).cast("int")
    return F.when(F.col("n_words") > 0, exceeded).otherwise(F.lit(0))


def cutoffs(rows: DataFrame, labels: DataFrame, allowed: float = ALLOWED, delta: float = DELTA) -> DataFrame:
    """(stratum, rule, level, cutoff, n_good, false_rejected, bad_rejected) of the certified cutoffs taken.

    ``rows``: of measured().  ``labels``: doc_id, quality; of repeated labels the lowest counts, null ones do not.
    """
    labels = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = rows.where("not base_failed").join(labels, "doc_id")
    each = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), level(r).alias("level")) for r in RULES])).alias("x")
    hist = known.select("stratum", "quality", each).groupBy("stratum", F.col("x.rule").alias("rule"), F.col("x.level").alias("level"))
    hist = hist.agg(F.sum((F.col("quality") >= 1).cast("long")).alias("good"), F.sum((F.col("quality") < 1).cast("long")).alias("bad"))
    hist = materialize(hist, "levels")
    # rejected at the j-th strictest cutoff: all whose level is at least j
    most = max(len(c) for _, c in RULES.values())
    reach = hist.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("level"))))
    at = reach.groupBy("stratum", "rule", F.col("j").alias("level")).agg(F.sum("good").alias("false_rejected"), F.sum("bad").alias("bad_rejected"))
    totals = hist.groupBy("stratum", "rule").agg(F.sum("good").alias("n_good"))
    grid = F.explode(F.sequence(F.lit(1), F.lit(most))).alias("level")
    tests = totals.select("stratum", "rule", "n_good", grid).join(at, ["stratum", "rule", "level"], "left")
    tests = tests.fillna(0, ["false_rejected", "bad_rejected"])
    n_tests = max(1, hist.select("stratum").distinct().count()) * sum(len(c) for _, c in RULES.values())
    alpha = allowed / len(RULES)
    sure = tests.where((F.col("n_good") > 0) & (binomial_tail(F.col("n_good"), F.col("false_rejected"), alpha) <= F.log(F.lit(delta / n_tests))))
    worth = F.col("bad_rejected") - GOOD_COST * F.col("false_rejected")
    best = sure.where(worth > 0).groupBy("stratum", "rule").agg(F.max_by(F.struct("level", "n_good", "false_rejected", "bad_rejected"), F.struct(worth, F.col("level"))).alias("b"))
    cut = F.create_map(*[x for r, (_, cuts) in RULES.items() for x in (F.lit(r), F.array(*map(F.lit, cuts)))])
    return best.select("stratum", "rule", "b.*").withColumn("cutoff", F.get(F.element_at(cut, F.col("rule")), F.col("level") - 1))


def quality_verdicts(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", stratum: str = "lang") -> DataFrame:
    """One row per row of ``docs``: doc_id, the counts, ``base_failed``, ``kept`` and ``rejected_by`` (rules, comma-joined).

    Null and empty texts have no words and fail the base rules.  A stratum with too few labelled rows to certify a
    cutoff rejects nothing beyond the base rules, and so does an empty label table.  Repeated rows are judged alike;
    rows with a null id are judged but teach nothing.  Other columns are not read.
    """
    rows = materialize(measured(docs, doc_id, text, stratum), "measures")
    taken = materialize(cutoffs(rows, labels).coalesce(1), "cutoffs")
    by_stratum = taken.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "level"))).alias("levels"))
    judged = lookup(rows, by_stratum, "stratum", rows.count())
    hits = [F.when(level(r) >= F.element_at("levels", F.lit(r)), F.lit(r)) for r in RULES]
    judged = judged.withColumn("rejected_by", F.when(F.col("base_failed"), F.lit("base")).otherwise(F.concat_ws(",", *hits)))
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return judged.select(*columns, (F.col("rejected_by") == "").alias("kept"), "rejected_by")


def oracle_sql(allowed: float = ALLOWED, delta: float = DELTA, window: int = WINDOW) -> str:
    """DuckDB SQL for quality_verdicts() of documents and labels."""
    space = "[\\x20\\x09-\\x0D]"
    level_of = {r: "CASE WHEN n_words > 0 THEN " + " + ".join(f"({metric} > {c})::INT" for c in cuts) + " ELSE 0 END" for r, (metric, cuts) in RULES.items()}
    alpha, most = allowed / len(RULES), max(len(c) for _, c in RULES.values())
    n_tests = sum(len(c) for _, c in RULES.values())
    tail = f"list_sum(list_transform(range(0, f + 1), lambda i: exp(lgamma(g + 1) - lgamma(i + 1) - lgamma(g - i + 1) + i * ln({alpha}) + (g - i) * ln(1 - {alpha}))))"
    steps = [
        "d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(lang, 'und') AS stratum, coalesce(text, '') AS t FROM documents)",
        f"w AS (SELECT *, list_filter(regexp_split_to_array(t, '{space}+'), lambda x: x <> '') AS words, list_filter(string_split(t, chr(10)), lambda x: regexp_replace(x, '{space}', '', 'g') <> '') AS lines FROM d)",
        f"g AS (SELECT rid, i, array_to_string(words[i:i + {window - 1}], ' ') AS gram FROM (SELECT rid, words, unnest(range(1, len(words) - {window - 2})) AS i FROM w WHERE len(words) >= {window}))",
        "twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS n FROM g) WHERE n > 1)",
        f"rep AS (SELECT rid, count(DISTINCT i + j) AS n FROM twice, (SELECT unnest(range(0, {window})) AS j) GROUP BY rid)",
        f"m AS (SELECT w.rid, doc_id, stratum, len(words)::BIGINT AS n_words, length(regexp_replace(t, '{space}', '', 'g'))::BIGINT AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, "
        "(len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines)::BIGINT AS n_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_capitals, "
        "length(regexp_replace(t, '[^!]', '', 'g')) AS n_marks FROM w LEFT JOIN rep ON rep.rid = w.rid)",
        "b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, " + ", ".join(f"{e} AS l_{r}" for r, e in level_of.items()) + " FROM m)",
        "known AS (SELECT b.*, quality FROM b JOIN (SELECT doc_id, min(quality) AS quality FROM labels WHERE quality IS NOT NULL GROUP BY doc_id) q ON q.doc_id = b.doc_id WHERE NOT base_failed)",
        "hist AS (" + " UNION ALL ".join(f"SELECT stratum, '{r}' AS rule, l_{r} AS level, (quality >= 1)::INT AS good FROM known" for r in RULES) + ")",
        f"tests AS (SELECT stratum, rule, j, sum(good)::BIGINT AS g, coalesce(sum(good) FILTER (level >= j), 0)::BIGINT AS f, count(*) FILTER (level >= j AND good = 0) AS r FROM hist, (SELECT unnest(range(1, {most + 1})) AS j) GROUP BY stratum, rule, j)",
        f"sure AS (SELECT *, r - {GOOD_COST} * f AS worth FROM tests WHERE g > 0 AND f <= g * {alpha} AND {tail} <= {delta} / ({n_tests} * (SELECT count(DISTINCT stratum) FROM hist)))",
        "cuts AS (SELECT stratum, " + ", ".join(f"arg_max(j, (worth, j)) FILTER (rule = '{r}') AS c_{r}" for r in RULES) + " FROM sure WHERE worth > 0 GROUP BY stratum)",
        "v AS (SELECT b.*, CASE WHEN base_failed THEN 'base' ELSE array_to_string(list_filter([" + ", ".join(f"CASE WHEN l_{r} >= c_{r} THEN '{r}' END" for r in RULES) + "], lambda x: x IS NOT NULL), ',') END AS rejected_by FROM b LEFT JOIN cuts ON cuts.stratum = b.stratum)",
    ]
    return "WITH " + ",\n".join(steps) + "\nSELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, rejected_by = '' AS kept, rejected_by FROM v"
