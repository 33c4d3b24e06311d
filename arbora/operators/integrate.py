"""Wide tables from many sources, with availability flags and strict keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arbora.operators.skew import numbered_rows


def last_of(rows: DataFrame, key: list[str], ordinal: str) -> DataFrame:
    """One row a key: the last by ordinal."""
    rest = [c for c in rows.columns if c not in key]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*rest), ordinal).alias("_r")).select(*key, *[F.col(f"_r.{c}").alias(c) for c in rest])


def first_of(rows: DataFrame, key: list[str], ordinal: str) -> DataFrame:
    rest = [c for c in rows.columns if c not in key]
    return rows.groupBy(*key).agg(F.min_by(F.struct(*rest), ordinal).alias("_r")).select(*key, *[F.col(f"_r.{c}").alias(c) for c in rest])


def with_source(base: DataFrame, source: DataFrame, name: str, key: list[str], covered: DataFrame | None = None, cover_key: str | None = None) -> DataFrame:
    """Left join of a source that has one row a key, with ``<name>_available``: true where the source covers the row's
    ``cover_key`` (or, without one, where it has the row), so that a missing value is not mistaken for a missing source."""
    out = base.join(source, key, "left") if covered is not None else base.join(source.withColumn(f"{name}_available", F.lit(True)), key, "left")
    if covered is not None:
        out = out.join(covered.select(cover_key).distinct().withColumn(f"{name}_available", F.lit(True)), cover_key, "left")
    return out.fillna(False, [f"{name}_available"])


def universe_of(key: list[str], *sources: DataFrame) -> DataFrame:
    """Distinct keys of all sources."""
    return reduce(lambda a, b: a.unionByName(b), [s.select(*key) for s in sources]).distinct()


def require_all(left: DataFrame, right: DataFrame, key: list[str], what: str) -> DataFrame:
    """Inner join that raises for a left row without match; right has one row a key."""
    joined = left.join(right.withColumn("_found", F.lit(True)), key, "left")
    return joined.where(F.assert_true(F.col("_found").isNotNull(), f"unresolved {what}").isNull()).drop("_found")


def resolved_or_null(left: DataFrame, right: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """Left join, and one row with the number of left rows that stay unresolved."""
    joined = left.join(right.withColumn("_found", F.lit(True)), key, "left")
    return joined.drop("_found"), joined.agg(F.coalesce(F.sum(F.col("_found").isNull().cast("long")), F.lit(0)).alias("unresolved"))


def three_axes(entities: DataFrame, axes: dict[str, DataFrame], key: str) -> DataFrame:
    """A flag an axis (is the entity in its table?), the axes that know it, and unlabelled: none does."""
    out = entities
    for name, known in axes.items():
        out = out.join(known.select(key).distinct().withColumn(name, F.lit(True)), key, "left")
    out = out.fillna(False, list(axes))
    names = F.array_join(F.array_compact(F.array(*[F.when(F.col(a), F.lit(a)) for a in axes])), ",")
    return out.withColumns({"axes": names, "unlabelled": ~reduce(lambda a, b: a | b, [F.col(a) for a in axes])})


def rollup_counts(rows: DataFrame, by: str, flags: list[str]) -> DataFrame:
    """Counts per key and for all (null key) in one pass of grouping sets."""
    sums = [F.sum(F.col(f).cast("long")).alias(f) for f in flags]
    out = rows.rollup(by).agg(F.count(F.lit(1)).alias("n"), *sums)
    return out.withColumns({f"{f}_percent": F.bround(100.0 * F.col(f) / F.col("n"), 2) for f in flags})


def evidence(rows: DataFrame, entity: str, source: str, sources: list[str], columns: dict[str, Column]) -> DataFrame:
    """A row an entity with ``<column>_<source>`` of each generic column and source; null where the source is silent."""
    return rows.groupBy(entity).pivot(source, sources).agg(*[c.alias(f"v_{n}") for n, c in columns.items()])


def cluster_features(members: DataFrame, features: DataFrame, flags: list[str]) -> DataFrame:
    """Per cluster: members, those with each flag, their sorted ids, and how many have the feature known at all.

    members: (cluster, entity); features: (entity, flags...), a null flag meaning unknown.
    """
    rows = members.join(features, "entity", "left")
    cells = [F.count(F.lit(1)).alias("members")]
    for f in flags:
        ids = F.array_join(F.array_sort(F.collect_list(F.when(F.col(f), F.col("entity").cast("string")))), ",")
        cells += [F.sum(F.coalesce(F.col(f), F.lit(False)).cast("long")).alias(f"n_{f}"), F.count(f).alias(f"known_{f}"), ids.alias(f"ids_{f}")]
    return rows.groupBy("cluster").agg(*cells)


def parallel_lists(rows: DataFrame, key: str, list_column: str, lookup: DataFrame, lookup_key: str, values: list[str], na: str = "NA") -> DataFrame:
    """A list cell's items looked up, each value column gathered again in the list's order, ``na`` keeping its slots."""
    items = rows.select(key, F.posexplode(list_column).alias("_at", lookup_key)).join(lookup, lookup_key, "left")
    slot = F.struct("_at", *[F.coalesce(F.col(v).cast("string"), F.lit(na)).alias(v) for v in values])
    got = items.groupBy(key).agg(F.array_sort(F.collect_list(slot)).alias("_s"))

    def cell(v: str) -> Column:
        return F.array_join(F.transform("_s", lambda x: x[v]), ",").alias(v)

    return rows.join(got, key, "left").select(*rows.columns, *map(cell, values))


def top_values(rows: DataFrame, key: str, order: list[Column], value: str, k: int = 10) -> DataFrame:
    """(key, top): the first k values in order, comma-joined."""
    names = [f"_o{i}" for i in range(len(order))]
    ranked = F.array_sort(F.collect_list(F.struct(*[o.alias(n) for o, n in zip(order, names, strict=True)], F.col(value).alias("_v"))))
    return rows.groupBy(key).agg(F.array_join(F.transform(F.slice(ranked, 1, k), lambda x: x["_v"].cast("string")), ",").alias("top"))


def closure_members(closure: DataFrame, members: DataFrame) -> DataFrame:
    """(group, member) of a group and all below it; closure: (ancestor, descendant, distance), members: (grp, member)."""
    own = members.select("grp", "member")
    below = closure.where("distance > 0").join(members, closure["descendant"] == members["grp"]).select(F.col("ancestor").alias("grp"), "member")
    return own.unionByName(below).distinct()


def resolve_names(names: DataFrame, direct: DataFrame, aliases: DataFrame, previous: DataFrame) -> DataFrame:
    """(name, id, how): by current name, else alias, else previous name; ties go to the smallest id, else NOT_FOUND.

    The tables are (name, id)."""
    routes = [("direct", direct), ("alias", aliases), ("previous", previous)]
    every = reduce(lambda a, b: a.unionByName(b), [t.select("name", "id", F.lit(k).alias("k"), F.lit(h).alias("how")) for k, (h, t) in enumerate(routes)])
    best = names.select("name").distinct().join(every, "name").groupBy("name").agg(F.min(F.struct("k", "id", "how")).alias("b"))
    out = names.join(best, "name", "left").select("name", F.col("b.id").alias("id"), F.col("b.how").alias("how"))
    return out.fillna("NOT_FOUND", ["how"])


#: Names that are asked for at once: a user's list, collected, and each compared with all known names.
MOST_NAMES = 10_000


def suggestions(missing: DataFrame, known: DataFrame, k: int = 5, least: float = 0.6) -> DataFrame:
    """(name, suggestion, rank): known names that contain it, then those of a matching ratio of at least ``least``.

    The ratio is twice the characters in matching blocks over all characters, whatever the case.  A table of over
    MOST_NAMES names raises; known names may be any number, and are read once.
    """
    wanted = [r["name"] for r in missing.select("name").where("name is not null").distinct().limit(MOST_NAMES + 1).collect()]
    if len(wanted) > MOST_NAMES:
        raise ValueError(f"over {MOST_NAMES} names to suggest for")

    def compare(frames):
        from difflib import SequenceMatcher

        for pdf in frames:
            rows = []
            for s in pdf["suggestion"].dropna():
                m = SequenceMatcher(None, "", "", autojunk=False)
                m.set_seq2(s.lower())
                for name in wanted:
                    low = name.lower()
                    if low in s.lower():
                        rows.append((name, s, True, 1.0))
                        continue
                    m.set_seq1(low)
                    if m.real_quick_ratio() >= least and m.quick_ratio() >= least and (ratio := m.ratio()) >= least:
                        rows.append((name, s, False, ratio))
            yield type(pdf)(rows, columns=["name", "suggestion", "inside", "ratio"])

    found = known.select(F.col("name").alias("suggestion")).distinct().mapInPandas(compare, "name string, suggestion string, inside boolean, ratio double")
    rank = F.row_number().over(Window.partitionBy("name").orderBy(F.desc("inside"), F.desc("ratio"), "suggestion"))
    return found.select("name", "suggestion", (rank - 1).alias("rank")).where(F.col("rank") < k)


def wide_base(base: DataFrame, key: str, sources: dict[str, DataFrame]) -> DataFrame:
    """``base`` with the columns of every source as <source>_<column>; a source has one row a key, which is asserted.

    Where a source is silent its columns are null, and <source>_available says whether it has the row.
    """
    out = base
    for name, source in sources.items():
        rest = [c for c in source.columns if c != key]
        again = F.count(F.lit(1))
        one = source.groupBy(key).agg(F.first(F.struct(*rest)).alias("_r"), again.alias("_n")).where(F.assert_true(F.col("_n") == 1, f"{name} repeats a key").isNull())
        out = with_source(out, one.select(key, *[F.col(f"_r.{c}").alias(f"{name}_{c}") for c in rest]), name, [key])
    return out


def species_matrix(rows: DataFrame, cluster: str, tip: str, tips: list[str]) -> DataFrame:
    """Counts a tip, their sum, and the tips with any."""
    wide = rows.groupBy(cluster).pivot(tip, tips).agg(F.count(F.lit(1))).fillna(0, tips)
    total = reduce(lambda a, b: a + b, [F.col(f"`{t}`") for t in tips])
    present = reduce(lambda a, b: a + b, [(F.col(f"`{t}`") > 0).cast("long") for t in tips])
    return wide.withColumns({"total_count": total, "tip_count": present})


def ordered_distinct(rows: DataFrame, key: str, value: str, ordinal: str, delimiter: str = ";") -> DataFrame:
    """(key, list): distinct values in first-seen order; only the distinct ones of a key are gathered."""
    items = F.transform(F.array_sort(F.collect_list(F.struct("_o", value))), lambda x: x[value])
    return rows.groupBy(key, value).agg(F.min(ordinal).alias("_o")).groupBy(key).agg(F.array_join(items, delimiter).alias("list"))


def set_differences(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """(key, side): items only expected, or only found."""
    a = expected.select(key).distinct().join(found, key, "left_anti").withColumn("side", F.lit("missing"))
    return a.unionByName(found.select(key).distinct().join(expected, key, "left_anti").withColumn("side", F.lit("unexpected")))


def header_matches(rows: DataFrame, key: str, headers: str, tokens: list[str] | None = None, delimiter: str = "|") -> DataFrame:
    """Keys with evidence in a header cell: with ``tokens``, a header that holds one (any case, blanks or underscores);
    without, any header that is neither empty nor a dash."""
    items = F.split(F.coalesce(F.col(headers), F.lit("")), f"[{delimiter}]")
    if tokens is None:
        ok = F.exists(items, lambda h: ~F.trim(h).isin("", "-"))
    else:
        forms = sorted({f for t in tokens for f in (t.lower(), t.lower().replace(" ", "_"), t.lower().replace("_", " "))})
        ok = F.exists(items, lambda h: reduce(lambda a, b: a | b, [F.contains(F.lower(h), F.lit(f)) for f in forms]))
    return rows.where(ok).select(key).distinct()


def lockstep(a: DataFrame, b: DataFrame, ordinal: str, key: str) -> DataFrame:
    """Joins two tables row by row in order; raises where their keys diverge or one is longer."""
    other = b.withColumnRenamed(key, "_key")
    rows = a.join(other, ordinal, "full")
    return rows.where(F.assert_true(F.col(key).eqNullSafe(F.col("_key")), "rows diverge").isNull()).drop("_key")


def first_described(rows: DataFrame, code: str, description: str, ordinal: str) -> DataFrame:
    """(code, description): the first that is not null, by ordinal; null if none is."""
    return rows.groupBy(code).agg(F.min_by(F.when(F.col(description).isNotNull(), F.col(description)), F.when(F.col(description).isNotNull(), F.col(ordinal))).alias(description))


def fillers(universe: DataFrame, annotated: DataFrame, database: str, *order: str) -> DataFrame:
    """Universe rows without annotation, numbered over all in order: unannotated_<database>-1, ..."""
    rest = universe.join(annotated.select("entity").distinct(), "entity", "left_anti")
    numbered = numbered_rows(rest, "_number", *order)
    return numbered.withColumn("code", F.concat(F.lit(f"unannotated_{database}-"), (F.col("_number") + 1).cast("string"))).drop("_number")


def vocabulary_counts(rows: DataFrame, by: str, code: str, category: str) -> DataFrame:
    """Per key: annotations, distinct codes, their ratio, and annotations of each category as a sorted ``name:n`` list."""
    per = rows.groupBy(by, category).agg(F.count(F.lit(1)).alias("n"))
    cells = per.groupBy(by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(category, "n"))), lambda x: F.concat(x[category], F.lit(":"), x["n"].cast("string"))), ",").alias("categories"))
    base = rows.groupBy(by).agg(F.count(F.lit(1)).alias("annotations"), F.count_distinct(code).alias("codes"))
    return base.withColumn("diversity", F.bround(F.col("codes") / F.col("annotations"), 4)).join(cells, by)


def feature_lookup(keys: list[str], **sources: DataFrame) -> DataFrame:
    """Every key of any source with a flag a source; sources may repeat keys."""
    out = universe_of(keys, *sources.values())
    for name, rows in sources.items():
        out = out.join(rows.select(*keys).distinct().withColumn(name, F.lit(True)), keys, "left")
    return out.fillna(False, list(sources))


def quality_summary(base: DataFrame, key: str, parts: dict[str, DataFrame], long: DataFrame, long_key: str, long_values: list[str], value: str) -> DataFrame:
    """A row a key with the columns of each part (one row a key) and a column a value of a long table's ``long_key``."""
    out = base
    for part in parts.values():
        out = out.join(part, key, "left")
    return out.join(long.groupBy(key).pivot(long_key, long_values).agg(F.first(value)), key, "left")


def taxonomy_summary(rows: DataFrame, ranks: list[str]) -> DataFrame:
    """(rank, name, n): rows under each name of each rank."""
    cells = F.explode(F.array(*[F.struct(F.lit(r).alias("rank"), F.col(r).alias("name")) for r in ranks])).alias("x")
    return rows.select(cells).groupBy("x.rank", "x.name").agg(F.count(F.lit(1)).alias("n"))


def overridden(rows: DataFrame, overrides: DataFrame, key: str, column: str) -> DataFrame:
    """Rows with the override where there is one, and whether there was."""
    out = rows.join(overrides.select(key, F.col(column).alias("_new")), key, "left")
    return out.withColumns({"overridden": F.col("_new").isNotNull(), column: F.coalesce("_new", column)}).drop("_new")


def wanted_sets(sets: DataFrame, wanted: DataFrame) -> DataFrame:
    """(grp, member, found): the members asked for, and whether the group has them; sets and wanted: (grp, member)."""
    return wanted.join(sets.select("grp", "member").distinct().withColumn("found", F.lit(True)), ["grp", "member"], "left").fillna(False, ["found"])
