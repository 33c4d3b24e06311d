"""Ranks, percentiles, scores, agreement and enrichment."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def quantile_ranks(rows: DataFrame, value: str, name: str, *by: str, digits: int = 6) -> DataFrame:
    """Adds the mean zero-based rank of ties over n - 1, 0.5 where n is 1; half-even rounding.

    Rows are counted by value first; ranks are then those of distinct values, joined back by group and value."""
    part = Window.partitionBy(*by)
    counts = rows.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_c"))
    upto = F.sum("_c").over(part.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    counts = counts.withColumns({"_low": upto - F.col("_c"), "_n": F.sum("_c").over(part)})
    rank = F.when(F.col("_n") == 1, F.lit(0.5)).otherwise(F.bround((F.col("_low") + (F.col("_c") - 1) / 2.0) / (F.col("_n") - 1), digits))
    return rows.join(counts.select(*by, value, rank.alias(name)), [*by, value])


def summary(rows: DataFrame, value: str, *by: str) -> DataFrame:
    """count, mean (2 digits), median, least, greatest, and the two quartiles: P25 is the element floor(n/4) - 1 from
    zero, at least the first; P75 the element floor(3n/4), at most the last.  A group's rows are first counted by value
    in place, so that windows see distinct values."""
    part = Window.partitionBy(*by)
    counts = rows.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_c"))
    upto = F.sum("_c").over(part.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    counts = counts.withColumns({"_upto": upto, "_n": F.sum("_c").over(part)})
    n = F.col("_n")
    at = lambda k: F.min(F.when(F.col("_upto") > k, F.col(value)))
    quarter, three = F.greatest(F.lit(0), F.floor(n * 0.25) - 1), F.least(n - 1, F.floor(n * 0.75))
    middle = (at(F.floor((n - 1) / 2)) + at(F.floor(n / 2))) / 2
    return counts.groupBy(*by).agg(
        F.max("_n").alias("n"), F.bround(F.sum(F.col(value) * F.col("_c")) / F.max("_n"), 2).alias("mean"), middle.cast("double").alias("median"), F.min(value).alias("least"), F.max(value).alias("greatest"), at(quarter).alias("p25"), at(three).alias("p75")
    )


def cluster_statistics(sizes: DataFrame, size: str = "size", total: int | None = None) -> DataFrame:
    """One row: clusters, members, least, greatest, mean, upper median, singletons, and coverage of ``total`` in percent."""
    rows = sizes.groupBy(size).agg(F.count(F.lit(1)).alias("k"))  # the histogram is small
    upto = F.sum("k").over(Window.orderBy(size).rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumns({"_upto": upto, "_n": F.sum("k").over(Window.partitionBy())})
    median = F.min(F.when(F.col("_upto") > F.floor(F.col("_n") / 2), F.col(size)))
    members = F.sum(F.col(size) * F.col("k"))
    out = rows.agg(
        F.coalesce(F.sum("k"), F.lit(0)).alias("clusters"), F.coalesce(members, F.lit(0)).alias("members"), F.min(size).alias("least"), F.max(size).alias("greatest"),
        F.bround(members / F.sum("k"), 2).alias("mean"), median.alias("upper_median"), F.coalesce(F.sum(F.when(F.col(size) == 1, F.col("k"))), F.lit(0)).alias("singletons"),
    )
    return out.withColumn("coverage", F.bround(100.0 * F.col("members") / F.lit(total), 2)) if total else out


def zscore(value: str, *by: str) -> Column:
    """Sample z-score; 0 where the deviation is 0 or there are fewer than two rows."""
    part = Window.partitionBy(*by)
    sd = F.stddev_samp(value).over(part)
    return F.when(F.coalesce(sd, F.lit(0.0)) > 0, (F.col(value) - F.avg(value).over(part)) / sd).otherwise(F.lit(0.0))


def low_flag(value: str, *by: str) -> Column:
    """Below the mean by more than one population deviation."""
    part = Window.partitionBy(*by)
    return F.col(value) < F.avg(value).over(part) - F.stddev_pop(value).over(part)


def dense_counts(counts: DataFrame, rows: DataFrame, columns: DataFrame, value: str) -> DataFrame:
    """Every (row, column) of two small dimensions, absent cells null."""
    grid = rows.crossJoin(columns)
    return grid.join(counts, [*rows.columns, *columns.columns], "left").select(*rows.columns, *columns.columns, value)


def zscore_with_zeros(grid: DataFrame, value: str, by: str) -> DataFrame:
    """z-scores where absent cells count as 0 in mean and deviation but stay null themselves."""
    part, filled = Window.partitionBy(by), F.coalesce(F.col(value), F.lit(0))
    sd = F.stddev_samp(filled).over(part)
    z = F.when(F.coalesce(sd, F.lit(0.0)) > 0, (F.col(value) - F.avg(filled).over(part)) / sd).otherwise(F.lit(0.0))
    return grid.withColumn("z", F.when(F.col(value).isNotNull(), F.bround(z, 4)))


def jaccard(sets: DataFrame, item: str, label: str, *by: str) -> DataFrame:
    """(by, first, second, both, either, percent) of every pair of labels; sets: distinct (by, label, item)."""
    sets = sets.select(*by, label, item).distinct()
    sizes = sets.groupBy(*by, label).agg(F.count(F.lit(1)).alias("n"))
    a, b = sets.withColumnRenamed(label, "first"), sets.withColumnRenamed(label, "second")
    both = a.join(b, [*by, item]).where("first < second").groupBy(*by, "first", "second").agg(F.count(F.lit(1)).alias("both"))
    pairs = sizes.withColumnsRenamed({label: "first", "n": "n1"}).join(sizes.withColumnsRenamed({label: "second", "n": "n2"}), list(by)).where("first < second")
    out = pairs.join(both, [*by, "first", "second"], "left").fillna(0, ["both"]).withColumn("either", F.col("n1") + F.col("n2") - F.col("both"))
    return out.select(*by, "first", "second", "both", "either", F.when(F.col("either") > 0, F.bround(100.0 * F.col("both") / F.col("either"), 2)).otherwise(F.lit(0.0)).alias("percent"))


def pair_counts(codes: DataFrame, entity: str, code: str, top: int | None = None) -> DataFrame:
    """(first, second, n): entities that have both codes; ``top`` commonest, ties by code."""
    codes = codes.select(entity, code).distinct()
    a, b = codes.withColumnRenamed(code, "first"), codes.withColumnRenamed(code, "second")
    out = a.join(b, entity).where("first < second").groupBy("first", "second").agg(F.count(F.lit(1)).alias("n"))
    return out.orderBy(F.desc("n"), "first", "second").limit(top) if top else out


def top_per_group(counts: DataFrame, group: str, value: str, tie: str, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(group).orderBy(F.desc(value), F.asc(tie)))
    return counts.withColumn("rank", rank).where(F.col("rank") <= k)


def group_means(counts: DataFrame, members: DataFrame, group: str, member: str, category: str, value: str) -> DataFrame:
    """(group, category, mean): mean over the group's members, absent cells as 0."""
    sizes = members.groupBy(group).agg(F.count(F.lit(1)).alias("_m"))
    sums = counts.join(members, member).groupBy(group, category).agg(F.sum(value).alias("_s"))
    grid = sizes.crossJoin(counts.select(category).distinct())
    return grid.join(sums, [group, category], "left").select(group, category, F.bround(F.coalesce("_s", F.lit(0)) / F.col("_m"), 4).alias("mean"))


def fold_changes(means: DataFrame, group: str, category: str) -> DataFrame:
    """(category, first, second, fold, direction) of every pair of groups; null and NA where the second mean is 0."""
    a = means.select(F.col(group).alias("first"), category, F.col("mean").alias("x"))
    b = means.select(F.col(group).alias("second"), category, F.col("mean").alias("y"))
    out = a.join(b, category).where("first < second")
    way = F.when(F.col("y") == 0, "NA").when(F.col("x") > F.col("y"), "first").when(F.col("x") < F.col("y"), "second").otherwise("equal")
    return out.select(category, "first", "second", F.when(F.col("y") != 0, F.bround(F.col("x") / F.col("y"), 4)).alias("fold"), way.alias("direction"))


def size_histogram(sizes: DataFrame, size: str = "size") -> DataFrame:
    return sizes.groupBy(size).agg(F.count(F.lit(1)).alias("clusters"))


def size_buckets(n: Column) -> Column:
    return F.when(n <= 1, "1").when(n == 2, "2").when(n == 3, "3").otherwise("4+")


def size_classes(n: Column) -> Column:
    return F.when(n <= 1, "1").when(n <= 10, "2-10").when(n <= 100, "11-100").when(n <= 1000, "101-1000").otherwise(">1000")


def copy_class(n: Column) -> Column:
    return F.when(n == 1, "1").when(n == 2, "2").when(n <= 5, "3-5").otherwise("6+")


def clustering_metrics(members: DataFrame, tips: DataFrame, near: int = 50, some: int = 10, broad: int = 10) -> DataFrame:
    """(metric, value) of a clustering; members: (cluster, tip, entity), tips: (tip, phylum), all tips that were clustered.

    Sections: totals, clusters whose tips have one copy each (in one, several or all tips) or nearly so (of those with
    several tips), completeness in tips, sizes, copies as means a tip, and breadth in phyla (of those with several tips).
    """
    n = F.lit(tips.select("tip").distinct().count())
    pair = members.groupBy("cluster", "tip").agg(F.count(F.lit(1)).alias("c")).join(tips, "tip", "left")
    held = F.count_distinct(F.coalesce("phylum", F.lit("Unknown")))
    per = pair.groupBy("cluster").agg(F.sum("c").alias("size"), F.count(F.lit(1)).alias("tips"), F.sum((F.col("c") == 1).cast("long")).alias("single"), held.alias("phyla"))
    size, held_tips, single, phyla = F.col("size"), F.col("tips"), F.col("single"), F.when(F.col("tips") >= 2, F.col("phyla"))
    several, share = held_tips >= 2, single / held_tips
    count = lambda cond: F.coalesce(F.sum(F.coalesce(cond, F.lit(False)).cast("long")), F.lit(0))
    total = F.count(F.lit(1))
    a = {
        "clusters": total, "members": F.coalesce(F.sum("size"), F.lit(0)), "singletons": count(size == 1),
        "singleton_percent": F.coalesce(F.bround(100.0 * count(size == 1) / F.nullif(total, F.lit(0)), 1), F.lit(0.0)), "multi_member": count(size != 1),
        "one_copy_one_tip": count((single == held_tips) & (held_tips == 1)), "one_copy_several_tips": count((single == held_tips) & several), "one_copy_all_tips": count((single == held_tips) & (held_tips == n)),
        **{f"one_copy_in_{int(100 * x)}_percent": count(several & (share >= x)) for x in (0.5, 0.75, 0.9)},
        "complete_all": count(held_tips == n), f"complete_{near}_plus": count((held_tips < n) & (held_tips >= near)), "complete_half_plus": count((held_tips < n) & (held_tips < near) & (held_tips >= F.floor(n / 2))),
        f"complete_{some}_to_half": count((held_tips < F.least(n, F.lit(near), F.floor(n / 2))) & (held_tips >= some)),
        f"complete_2_to_{some - 1}": count((held_tips < F.least(n, F.lit(near), F.floor(n / 2), F.lit(some))) & several),
        "size_greatest": F.coalesce(F.max("size"), F.lit(0)), "size_mean": F.coalesce(F.bround(F.avg("size"), 2), F.lit(0.0)), "size_median": F.coalesce(F.median("size"), F.lit(0.0)),
        "size_2_to_10": count((size >= 2) & (size <= 10)), "size_11_to_100": count((size >= 11) & (size <= 100)), "size_101_to_1000": count((size >= 101) & (size <= 1000)), "size_over_1000": count(size > 1000),
        "phyla_mean": F.coalesce(F.bround(F.avg(phyla), 2), F.lit(0.0)), "phyla_median": F.coalesce(F.median(phyla), F.lit(0.0)), "phyla_greatest": F.coalesce(F.max(phyla), F.lit(0)),
        f"phyla_{broad}_plus": count(phyla >= broad), "phyla_one": count(phyla == 1),
    }
    b = {f"tip_mean_copies_{s}": F.bround(count(copy_class(F.col("c")) == s) / n, 0) for s in ("1", "2", "3-5", "6+")}
    long = lambda df, ms: df.agg(*[m.cast("double").alias(k) for k, m in ms.items()]).select(F.explode(F.array(*[F.struct(F.lit(k).alias("metric"), F.col(f"`{k}`").alias("value")) for k in ms])).alias("x"))
    tips_row = tips.agg(F.count_distinct("tip").cast("double").alias("value")).select(F.lit("tips").alias("metric"), "value")
    return long(per, a).unionByName(long(pair, b)).select("x.metric", "x.value").unionByName(tips_row)


def co_clustering(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: entity pairs together in both clusterings, in each, and the agreement; exact, from the contingency
    table, where sampling pairs would only estimate it.  a, b: (entity, cluster)."""
    pairs = lambda df, *by: df.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum(F.expr("n * (n - 1) div 2")), F.lit(0)).alias("p"))
    shared = a.select("entity", F.col("cluster").alias("ca")).join(b.select("entity", F.col("cluster").alias("cb")), "entity")
    x, y, z = pairs(shared, "ca", "cb"), pairs(shared, "ca"), pairs(shared, "cb")
    out = x.select(F.col("p").alias("both")).crossJoin(y.select(F.col("p").alias("first"))).crossJoin(z.select(F.col("p").alias("second")))
    either = F.col("first") + F.col("second") - F.col("both")
    return out.withColumn("agreement", F.when(either > 0, F.bround(F.col("both") / either, 6)))


def n50(lengths: DataFrame, length: str, *by: str) -> DataFrame:
    """(by, n, total, n50): the length at which the sorted lengths reach half of the total; from counts by length."""
    counts = lengths.groupBy(*by, length).agg(F.count(F.lit(1)).alias("_c"))
    part, sum_ = Window.partitionBy(*by), F.col(length) * F.col("_c")
    run = F.sum(sum_).over(part.orderBy(F.desc(length)).rowsBetween(Window.unboundedPreceding, 0))
    rows = counts.withColumns({"_run": run, "_all": F.sum(sum_).over(part)})
    return rows.groupBy(*by).agg(F.sum("_c").alias("n"), F.sum(sum_).alias("total"), F.max(F.when(F.col("_run") * 2 >= F.col("_all"), F.col(length))).alias("n50"))


def assembly(sequences: DataFrame, by: str, sequence: str) -> DataFrame:
    """Per assembly: sequences, residues, n50, longest, percent of G and C among A, C, G and T, percent of N, and runs of N."""
    base = F.upper(sequence)
    of = lambda chars: F.length(base) - F.length(F.translate(base, chars, ""))
    rows = sequences.select(by, F.length(sequence).cast("long").alias("_l"), of("GC").alias("_gc"), of("ACGT").alias("_acgt"), of("N").alias("_n"), F.size(F.regexp_extract_all(base, F.lit("N+"), F.lit(0))).alias("_gaps"))
    totals = rows.groupBy(by).agg(
        F.max("_l").alias("longest"), F.bround(100.0 * F.sum("_gc") / F.nullif(F.sum("_acgt"), F.lit(0)), 2).alias("gc_percent"), F.bround(100.0 * F.sum("_n") / F.nullif(F.sum("_l"), F.lit(0)), 2).alias("n_percent"), F.sum("_gaps").alias("gaps")
    )
    return n50(rows, "_l", by).join(totals, by)


def additive_counts(by: str, *tables: DataFrame) -> DataFrame:
    """(by, n): rows of all tables together, seeds and what they found."""
    return reduce(lambda a, b: a.unionAll(b), [t.groupBy(by).agg(F.count(F.lit(1)).alias("n")) for t in tables]).groupBy(by).agg(F.sum("n").alias("n"))


def summary_matrix(rows: DataFrame, outer: str, inner: str, entity: str) -> DataFrame:
    """(outer, inner, n, entities): rows and distinct entities of each pair, of each outer value, and of all (nulls)."""
    sets = rows.select(outer, inner, entity).groupingSets([[F.col(outer), F.col(inner)], [F.col(outer)], []], outer, inner)
    return sets.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(entity).alias("entities"))


def pass_kinds(rows: DataFrame, entity: str, kind: str) -> DataFrame:
    """(n_kinds, entities, rows): entities by how many kinds of features they have."""
    per = rows.groupBy(entity).agg(F.count_distinct(kind).alias("n_kinds"), F.count(F.lit(1)).alias("n"))
    return per.groupBy("n_kinds").agg(F.count(F.lit(1)).alias("entities"), F.sum("n").alias("rows"))


def membrane_counts(topology: DataFrame, entity: str, string: str) -> DataFrame:
    """(entity, passes, signal, kind) from a string of one letter a residue: H or h and B or b in membranes, S in a signal.

    A pass is a run of membrane letters; kind is none, single or multi, with _signal where a signal is.
    """
    passes = F.size(F.regexp_extract_all(string, F.lit("[HhBb]+"), F.lit(0)))
    signal = F.contains(F.col(string), F.lit("S"))
    kind = F.when(passes == 0, "none").when(passes == 1, "single").otherwise("multi")
    return topology.select(entity, passes.cast("long").alias("passes"), signal.alias("signal"), F.concat(kind, F.when(signal, "_signal").otherwise("")).alias("kind"))


def completeness(facts: DataFrame, taxon: str, database: str, entity: str) -> DataFrame:
    """Per taxon: databases, their sorted list, rows, and distinct entities over all databases."""
    return facts.groupBy(taxon).agg(F.count_distinct(database).alias("databases"), F.array_join(F.array_sort(F.collect_set(database)), ",").alias("database_list"), F.count(F.lit(1)).alias("annotations"), F.count_distinct(entity).alias("entities"))


def tool_rollup(counts: DataFrame, tool: str, database: str) -> DataFrame:
    """Per tool: the most unique entities of its databases, and the sum of annotations; counts: (tool, database, uniques, annotations)."""
    return counts.groupBy(tool).agg(F.max("uniques").alias("uniques"), F.sum("annotations").alias("annotations"), F.count_distinct(database).alias("databases"))
