"""Queries of statistics, similarity and clusters."""

from __future__ import annotations

from pyspark.sql import functions as F

from arbora.operators import graphs, integrate, similarity, statistics
from arbora.plans.world import Query, table, tip_groups

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle:
            SQL[name] = oracle
        return fn

    return register


def _located(spark, sf):
    """Lines with the nation of their supplier and the brand of their part."""
    items = table(spark, sf, "lineitem")
    s, n, p = table(spark, sf, "supplier"), table(spark, sf, "nation"), table(spark, sf, "part")
    at = s.join(n, s["s_nationkey"] == n["n_nationkey"]).select("s_suppkey", "n_name")
    rows = items.join(at, items["l_suppkey"] == at["s_suppkey"])
    return rows.join(p.select("p_partkey", "p_brand", "p_type"), rows["l_partkey"] == F.col("p_partkey"))


LOCATED = "loc AS (SELECT * FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey)"
COUNTS = LOCATED + ", cnt AS (SELECT n_name, p_brand, count(*) AS n FROM loc GROUP BY ALL)"


def _counts(spark, sf):
    """(n_name, p_brand, n); not every pair need be there."""
    return _located(spark, sf).groupBy("n_name", "p_brand").agg(F.count(F.lit(1)).alias("n"))


@query("quantile_ranks", """SELECT p_partkey, CASE WHEN n = 1 THEN 0.5 ELSE round_even((lo + (t - 1) / 2.0::DOUBLE) / (n - 1), 6) END AS q FROM (SELECT p_partkey, count(*) OVER (PARTITION BY p_brand) AS n,
  rank() OVER (PARTITION BY p_brand ORDER BY p_size) - 1 AS lo, count(*) OVER (PARTITION BY p_brand, p_size) AS t FROM part)""")  # fmt: skip
def quantile_ranks(spark, sf):
    return statistics.quantile_ranks(table(spark, sf, "part"), "p_size", "q", "p_brand").select("p_partkey", "q")


@query("summary_statistics", """WITH r AS (SELECT p_brand, p_retailprice AS v, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice) - 1 AS k, count(*) OVER (PARTITION BY p_brand) AS c FROM part)
  SELECT p_brand, count(*) AS n, round_even(avg(v), 2) AS mean, median(v) AS median, min(v) AS least, max(v) AS greatest, max(CASE WHEN k = greatest(0, floor(c * 0.25) - 1) THEN v END) AS p25,
  max(CASE WHEN k = least(c - 1, floor(c * 0.75)) THEN v END) AS p75 FROM r GROUP BY p_brand""")  # fmt: skip
def summary_statistics(spark, sf):
    return statistics.summary(table(spark, sf, "part"), "p_retailprice", "p_brand")


SIZES = "sz AS (SELECT l_partkey, count(*) AS size FROM lineitem GROUP BY 1)"


def _sizes(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("size"))


@query("cluster_statistics", f"""WITH {SIZES} SELECT count(*) AS clusters, sum(size)::BIGINT AS members, min(size) AS least, max(size) AS greatest, round_even(avg(size), 2) AS mean,
  list_sort(list(size))[count(*) // 2 + 1] AS upper_median, count(*) FILTER (size = 1) AS singletons, round_even(100.0::DOUBLE * sum(size) / (SELECT count(*) FROM lineitem), 2) AS coverage FROM sz""")  # fmt: skip
def cluster_statistics(spark, sf):
    return statistics.cluster_statistics(_sizes(spark, sf), total=table(spark, sf, "lineitem").count())


@query("size_histogram", f"WITH {SIZES} SELECT size, count(*) AS clusters FROM sz GROUP BY size")
def size_histogram(spark, sf):
    return statistics.size_histogram(_sizes(spark, sf))


@query("size_buckets", f"WITH {SIZES} SELECT CASE WHEN size <= 1 THEN '1' WHEN size = 2 THEN '2' WHEN size = 3 THEN '3' ELSE '4+' END AS bucket, count(*) AS n, max(size) AS most, arg_max(l_partkey, (size, -l_partkey)) AS largest FROM sz GROUP BY 1")
def size_buckets(spark, sf):
    """Buckets with their largest cluster, the smaller key on ties."""
    largest = F.max_by("l_partkey", F.struct("size", -F.col("l_partkey")))
    return _sizes(spark, sf).groupBy(statistics.size_buckets(F.col("size")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("most"), largest.alias("largest"))


@query("z_scores", f"""WITH {COUNTS} SELECT n_name, p_brand, n, round_even(CASE WHEN coalesce(stddev_samp(n) OVER w, 0) > 0 THEN (n - avg(n) OVER w) / stddev_samp(n) OVER w ELSE 0.0 END, 4) AS z FROM cnt WINDOW w AS (PARTITION BY p_brand)""")
def z_scores(spark, sf):
    return _counts(spark, sf).withColumn("z", F.bround(statistics.zscore("n", "p_brand"), 4))


@query("z_scores_with_zeros", f"""WITH {COUNTS}, grid AS (SELECT n.n_name, b.p_brand, c.n FROM nation n CROSS JOIN (SELECT DISTINCT p_brand FROM part) b LEFT JOIN cnt c ON c.n_name = n.n_name AND c.p_brand = b.p_brand)
  SELECT n_name, p_brand, n, CASE WHEN n IS NOT NULL THEN round_even(CASE WHEN coalesce(stddev_samp(coalesce(n, 0)) OVER w, 0) > 0 THEN (n - avg(coalesce(n, 0)) OVER w) / stddev_samp(coalesce(n, 0)) OVER w ELSE 0.0 END, 4) END AS z
  FROM grid WINDOW w AS (PARTITION BY p_brand)""")  # fmt: skip
def z_scores_with_zeros(spark, sf):
    grid = statistics.dense_counts(_counts(spark, sf), table(spark, sf, "nation").select("n_name"), table(spark, sf, "part").select("p_brand").distinct(), "n")
    return statistics.zscore_with_zeros(grid, "n", "p_brand")


@query("low_flags", f"WITH {COUNTS} SELECT n_name, p_brand, n < avg(n) OVER w - stddev_pop(n) OVER w AS low FROM cnt WINDOW w AS (PARTITION BY p_brand)")
def low_flags(spark, sf):
    return _counts(spark, sf).select("n_name", "p_brand", statistics.low_flag("n", "p_brand").alias("low"))


@query("count_matrix", f"WITH {LOCATED} SELECT p_brand, " + ", ".join(f"count(*) FILTER (n_name = 'NATION_{i}') AS NATION_{i}" for i in range(25)) + ", count(*) AS total_count, count(DISTINCT n_name) AS tip_count FROM loc GROUP BY p_brand")
def count_matrix(spark, sf):
    return integrate.species_matrix(_located(spark, sf), "p_brand", "n_name", [f"NATION_{i}" for i in range(25)])


@query("jaccard_agreement", f"""WITH {LOCATED}, s AS (SELECT DISTINCT n_name, l_returnflag AS f, l_partkey FROM loc), z AS (SELECT n_name, f, count(*) AS n FROM s GROUP BY ALL),
  b AS (SELECT x.n_name, x.f AS first, y.f AS second, count(*) AS both FROM s x JOIN s y ON x.n_name = y.n_name AND x.l_partkey = y.l_partkey AND x.f < y.f GROUP BY ALL)
  SELECT p.n_name, p.f AS first, q.f AS second, coalesce(b.both, 0) AS "both", p.n + q.n - coalesce(b.both, 0) AS either, round_even(100.0::DOUBLE * coalesce(b.both, 0) / (p.n + q.n - coalesce(b.both, 0)), 2) AS percent
  FROM z p JOIN z q ON p.n_name = q.n_name AND p.f < q.f LEFT JOIN b ON b.n_name = p.n_name AND b.first = p.f AND b.second = q.f""")  # fmt: skip
def jaccard_agreement(spark, sf):
    return statistics.jaccard(_located(spark, sf), "l_partkey", "l_returnflag", "n_name").withColumnRenamed("l_returnflag", "first")


@query("code_pairs", """WITH c AS (SELECT DISTINCT l_orderkey, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey) SELECT a.p_brand AS first, b.p_brand AS second, count(*) AS n FROM c a JOIN c b ON a.l_orderkey = b.l_orderkey AND a.p_brand < b.p_brand
  GROUP BY ALL ORDER BY n DESC, first, second LIMIT 10""")  # fmt: skip
def code_pairs(spark, sf):
    """The ten commonest pairs (a top-k report)."""
    p = table(spark, sf, "part").select("p_partkey", "p_brand")
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    return statistics.pair_counts(items.join(p, items["l_partkey"] == p["p_partkey"]), "l_orderkey", "p_brand", 10)


@query("top_brands", f"WITH {COUNTS} SELECT n_name, p_brand, n, k::INTEGER AS rank FROM (SELECT *, row_number() OVER (PARTITION BY n_name ORDER BY n DESC, p_brand) AS k FROM cnt) WHERE k <= 3")
def top_brands(spark, sf):
    return statistics.top_per_group(_counts(spark, sf), "n_name", "n", "p_brand", 3)


MEANS = """means AS (SELECT m.grp, b.p_brand, round_even(coalesce(s.s, 0)::DOUBLE / m.m, 4) AS mean FROM (SELECT r_name AS grp, count(*) AS m FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1) m
  CROSS JOIN (SELECT DISTINCT p_brand FROM cnt) b LEFT JOIN (SELECT r_name AS grp, p_brand, sum(n) AS s FROM cnt JOIN nation USING (n_name) JOIN region ON n_regionkey = r_regionkey GROUP BY ALL) s ON s.grp = m.grp AND s.p_brand = b.p_brand)"""


def _means(spark, sf):
    members = tip_groups(spark, sf).withColumnRenamed("tip", "n_name")
    return statistics.group_means(_counts(spark, sf), members, "grp", "n_name", "p_brand", "n")


@query("group_means", f"WITH {COUNTS}, {MEANS} SELECT grp, p_brand, mean FROM means")
def group_means(spark, sf):
    return _means(spark, sf)


@query("fold_changes", f"""WITH {COUNTS}, {MEANS} SELECT a.p_brand, a.grp AS first, b.grp AS second, CASE WHEN b.mean <> 0 THEN round_even(a.mean / b.mean, 4) END AS fold,
  CASE WHEN b.mean = 0 THEN 'NA' WHEN a.mean > b.mean THEN 'first' WHEN a.mean < b.mean THEN 'second' ELSE 'equal' END AS direction FROM means a JOIN means b ON a.p_brand = b.p_brand AND a.grp < b.grp""")  # fmt: skip
def fold_changes(spark, sf):
    return statistics.fold_changes(_means(spark, sf), "grp", "p_brand")


@query("cluster_qc", f"WITH {LOCATED} SELECT n_name, count(*) AS sequences, count(DISTINCT l_partkey) AS clusters, round_even(100.0::DOUBLE * count(*) FILTER (l_quantity >= 25) / count(*), 2) AS coverage FROM loc GROUP BY n_name")
def cluster_qc(spark, sf):
    rows = _located(spark, sf).groupBy("n_name")
    return rows.agg(F.count(F.lit(1)).alias("sequences"), F.count_distinct("l_partkey").alias("clusters"), F.bround(100.0 * F.sum((F.col("l_quantity") >= 25).cast("long")) / F.count(F.lit(1)), 2).alias("coverage"))


CLUSTERS = f"""{LOCATED}, pr AS (SELECT l_partkey AS cluster, n_name AS tip, count(*) AS c FROM loc GROUP BY ALL),
pc AS (SELECT cluster, sum(c) AS size, count(*) AS tips, count(*) FILTER (c = 1) AS single, count(DISTINCT r_name) AS phyla FROM pr JOIN nation ON n_name = tip JOIN region ON n_regionkey = r_regionkey GROUP BY cluster), many AS (SELECT * FROM pc WHERE tips >= 2)"""
_METRICS = {
    "tips": "(SELECT count(*) FROM nation)", "clusters": "(SELECT count(*) FROM pc)", "members": "(SELECT sum(size) FROM pc)", "singletons": "(SELECT count(*) FROM pc WHERE size = 1)",
    "singleton_percent": "(SELECT round_even(100.0::DOUBLE * count(*) FILTER (size = 1) / count(*), 1) FROM pc)", "multi_member": "(SELECT count(*) FROM pc WHERE size > 1)",
    "one_copy_one_tip": "(SELECT count(*) FROM pc WHERE single = 1 AND tips = 1)", "one_copy_several_tips": "(SELECT count(*) FROM many WHERE single = tips)", "one_copy_all_tips": "(SELECT count(*) FROM pc WHERE single = 25)",
    **{f"one_copy_in_{int(100 * x)}_percent": f"(SELECT count(*) FROM many WHERE single::DOUBLE / tips >= {x})" for x in (0.5, 0.75, 0.9)},
    "complete_all": "(SELECT count(*) FROM pc WHERE tips = 25)", "complete_20_plus": "(SELECT count(*) FROM pc WHERE tips BETWEEN 20 AND 24)", "complete_half_plus": "(SELECT count(*) FROM pc WHERE tips BETWEEN 12 AND 19)",
    "complete_5_to_half": "(SELECT count(*) FROM pc WHERE tips BETWEEN 5 AND 11)", "complete_2_to_4": "(SELECT count(*) FROM pc WHERE tips BETWEEN 2 AND 4)",
    "size_greatest": "(SELECT max(size) FROM pc)", "size_mean": "(SELECT round_even(avg(size), 2) FROM pc)", "size_median": "(SELECT median(size) FROM pc)",
    "size_2_to_10": "(SELECT count(*) FROM pc WHERE size BETWEEN 2 AND 10)", "size_11_to_100": "(SELECT count(*) FROM pc WHERE size BETWEEN 11 AND 100)", "size_101_to_1000": "(SELECT count(*) FROM pc WHERE size BETWEEN 101 AND 1000)", "size_over_1000": "(SELECT count(*) FROM pc WHERE size > 1000)",
    "phyla_mean": "(SELECT coalesce(round_even(avg(phyla), 2), 0) FROM many)", "phyla_median": "(SELECT coalesce(median(phyla), 0) FROM many)", "phyla_greatest": "(SELECT coalesce(max(phyla), 0) FROM many)", "phyla_4_plus": "(SELECT count(*) FROM many WHERE phyla >= 4)", "phyla_one": "(SELECT count(*) FROM many WHERE phyla = 1)",
    **{f"tip_mean_copies_{k}": f"(SELECT round_even(count(*) / 25.0::DOUBLE, 0) FROM pr WHERE {w})" for k, w in (("1", "c = 1"), ("2", "c = 2"), ("3-5", "c BETWEEN 3 AND 5"), ("6+", "c >= 6"))},
}


@query("clustering_metrics", f"WITH {CLUSTERS} " + " UNION ALL ".join(f"SELECT '{k}' AS metric, {v}::DOUBLE AS value" for k, v in _METRICS.items()))
def clustering_metrics(spark, sf):
    rows = _located(spark, sf).select(F.col("l_partkey").alias("cluster"), F.col("n_name").alias("tip"), F.col("l_orderkey").alias("entity"))
    return statistics.clustering_metrics(rows, tip_groups(spark, sf).withColumnRenamed("grp", "phylum"), near=20, some=5, broad=4)


@query("assembly_statistics", """WITH s AS (SELECT source, upper(text) AS t FROM documents), r AS (SELECT source, length(t) AS l, length(regexp_replace(t, '[^GC]', '', 'g')) AS gc, length(regexp_replace(t, '[^ACGT]', '', 'g')) AS acgt, length(regexp_replace(t, '[^N]', '', 'g')) AS nn,
  len(regexp_extract_all(t, 'N+')) AS g, sum(length(t)) OVER (PARTITION BY source ORDER BY length(t) DESC ROWS UNBOUNDED PRECEDING) AS run, sum(length(t)) OVER (PARTITION BY source) AS total FROM s)
  SELECT source, count(*) AS n, max(total)::BIGINT AS total, max(CASE WHEN run * 2 >= total THEN l END) AS n50, max(l) AS longest, round_even(100.0::DOUBLE * sum(gc) / sum(acgt), 2) AS gc_percent, round_even(100.0::DOUBLE * sum(nn) / sum(l), 2) AS n_percent, sum(g)::BIGINT AS gaps FROM r GROUP BY source""")  # fmt: skip
def assembly_statistics(spark, sf):
    """Documents as sequences of assemblies by source."""
    return statistics.assembly(table(spark, sf, "documents").select("source", "text"), "source", "text")


@query("membrane_counts", """WITH t AS (SELECT o_orderkey, repeat('i', 3) || string_agg(CASE WHEN l_returnflag = 'N' THEN 'HHH' WHEN l_returnflag = 'A' THEN 'oo' ELSE 'S' END, '' ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag) AS s FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL)
  SELECT o_orderkey, len(regexp_extract_all(s, 'H+')) AS passes, contains(s, 'S') AS signal, CASE len(regexp_extract_all(s, 'H+')) WHEN 0 THEN 'none' WHEN 1 THEN 'single' ELSE 'multi' END || CASE WHEN contains(s, 'S') THEN '_signal' ELSE '' END AS kind FROM t""")  # fmt: skip
def membrane_counts(spark, sf):
    """Orders as chains whose lines are stretches in, out of and before a membrane."""
    items = table(spark, sf, "lineitem")
    letter = F.when(F.col("l_returnflag") == "N", "HHH").when(F.col("l_returnflag") == "A", "oo").otherwise("S")
    ordered = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", letter.alias("x"))))
    chains = items.join(table(spark, sf, "orders").select("o_orderkey"), items["l_orderkey"] == F.col("o_orderkey")).groupBy("o_orderkey")
    rows = chains.agg(F.concat(F.lit("iii"), F.array_join(F.transform(ordered, lambda v: v["x"]), "")).alias("s"))
    return statistics.membrane_counts(rows, "o_orderkey", "s")


@query("co_clustering", """WITH a AS (SELECT p_partkey, p_brand, p_type FROM part), f(n) AS (SELECT unnest([1])), x AS (SELECT count(*) AS n FROM a GROUP BY p_brand, p_type), y AS (SELECT count(*) AS n FROM a GROUP BY p_brand), z AS (SELECT count(*) AS n FROM a GROUP BY p_type)
  SELECT b AS "both", f1 AS first, s AS second, round_even(b::DOUBLE / (f1 + s - b), 6) AS agreement FROM (SELECT (SELECT sum(n * (n - 1) // 2)::BIGINT FROM x) AS b, (SELECT sum(n * (n - 1) // 2)::BIGINT FROM y) AS f1, (SELECT sum(n * (n - 1) // 2)::BIGINT FROM z) AS s)""")  # fmt: skip
def co_clustering(spark, sf):
    p = table(spark, sf, "part")
    return statistics.co_clustering(p.select(F.col("p_partkey").alias("entity"), F.col("p_brand").alias("cluster")), p.select(F.col("p_partkey").alias("entity"), F.col("p_type").alias("cluster")))


@query("n50", """WITH r AS (SELECT source, n_chars, sum(n_chars) OVER (PARTITION BY source ORDER BY n_chars DESC ROWS UNBOUNDED PRECEDING) AS run, sum(n_chars) OVER (PARTITION BY source) AS total FROM documents)
  SELECT source, count(*) AS n, sum(n_chars)::BIGINT AS total, max(CASE WHEN run * 2 >= total THEN n_chars END) AS n50 FROM r GROUP BY source""")  # fmt: skip
def n50(spark, sf):
    return statistics.n50(table(spark, sf, "documents").select("source", "n_chars"), "n_chars", "source")


@query("completeness", f"WITH {LOCATED} SELECT n_name, count(DISTINCT p_type) AS databases, string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS database_list, count(*) AS annotations, count(DISTINCT l_partkey) AS entities FROM loc GROUP BY n_name")
def completeness(spark, sf):
    return statistics.completeness(_located(spark, sf), "n_name", "p_type", "l_partkey")


@query("tool_rollup", f"WITH {LOCATED}, d AS (SELECT p_type, p_brand, count(DISTINCT l_partkey) AS uniques, count(*) AS annotations FROM loc GROUP BY ALL) SELECT p_type, max(uniques) AS uniques, sum(annotations)::BIGINT AS annotations, count(*) AS databases FROM d GROUP BY p_type")
def tool_rollup(spark, sf):
    per = _located(spark, sf).groupBy("p_type", "p_brand").agg(F.count_distinct("l_partkey").alias("uniques"), F.count(F.lit(1)).alias("annotations"))
    return statistics.tool_rollup(per, "p_type", "p_brand")


@query("additive_counts", "SELECT p_brand, sum(n)::BIGINT AS n FROM (SELECT p_brand, count(*) AS n FROM part GROUP BY 1 UNION ALL SELECT p_brand, count(*) FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1) GROUP BY p_brand")
def additive_counts(spark, sf):
    """Seeds and found members counted together."""
    return statistics.additive_counts("p_brand", table(spark, sf, "part"), _located(spark, sf))


@query("ordered_distinct", "SELECT user_id, string_agg(event_type, ';' ORDER BY first_id) AS list FROM (SELECT user_id, event_type, min(event_id) AS first_id FROM events GROUP BY ALL) GROUP BY user_id")
def ordered_distinct(spark, sf):
    return integrate.ordered_distinct(table(spark, sf, "events"), "user_id", "event_type", "event_id")


@query("pass_kinds", "SELECT n_kinds, count(*) AS entities, sum(n)::BIGINT AS events FROM (SELECT user_id, count(DISTINCT event_type) AS n_kinds, count(*) AS n FROM events GROUP BY 1) GROUP BY n_kinds")
def pass_kinds(spark, sf):
    """Entities by how many kinds they have: a two-level count."""
    return statistics.pass_kinds(table(spark, sf, "events"), "user_id", "event_type").withColumnRenamed("rows", "events")


@query("summary_matrix", f"""WITH {LOCATED} SELECT n_name, p_type, count(*) AS n, count(DISTINCT l_partkey) AS parts FROM loc GROUP BY GROUPING SETS ((n_name, p_type), (n_name), ())""")
def summary_matrix(spark, sf):
    return statistics.summary_matrix(_located(spark, sf), "n_name", "p_type", "l_partkey").withColumnRenamed("entities", "parts")


# similarity
def _hits(spark, sf):
    """Lines as hits of orders on parts, the price a score, the discount an e-value."""
    items = table(spark, sf, "lineitem")
    e = F.when(F.col("l_discount") == 0, F.lit(0.0)).otherwise(F.pow(F.lit(10.0), -F.col("l_quantity") * 2))
    return items.select(F.col("l_orderkey").alias("query"), F.col("l_partkey").alias("subject"), e.alias("evalue"), "l_extendedprice", "l_linenumber", "l_suppkey", "l_quantity")


@query("strong_hits", "SELECT l_orderkey AS query, l_partkey AS subject, l_linenumber FROM lineitem WHERE l_orderkey <> l_partkey AND (l_discount = 0 OR l_quantity * 2 >= 60)")
def strong_hits(spark, sf):
    return similarity.strong_hits(_hits(spark, sf), "query", "subject", "evalue", 1.0000001e-60).select("query", "subject", "l_linenumber")


TOTAL = "l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"


@query("top_hits", f"""WITH h AS (SELECT l_orderkey AS query, l_partkey AS subject, l_quantity >= 40 AS own, row_number() OVER (PARTITION BY l_orderkey ORDER BY {TOTAL}) AS k FROM lineitem)
  SELECT query, count(*) AS n_hits, arg_min(subject, k) FILTER (own) AS self_hit, arg_min(subject, k) FILTER (NOT own) AS other_hit, (min(k) FILTER (NOT own))::INTEGER AS other_rank FROM h WHERE k <= 10 GROUP BY query""")  # fmt: skip
def top_hits(spark, sf):
    hits = _hits(spark, sf).withColumn("ordinal", F.struct("l_linenumber", "subject", "l_suppkey", "l_quantity", "l_extendedprice"))
    return similarity.top_hits(hits, "query", "ordinal", F.col("l_quantity") >= 40, "subject")


@query("reciprocal_best", f"""WITH {LOCATED}, s AS (SELECT n_name, l_partkey, sum(l_quantity::BIGINT)::BIGINT AS score FROM loc GROUP BY ALL), a AS (SELECT *, row_number() OVER (PARTITION BY n_name ORDER BY score DESC, l_partkey) AS k FROM s),
  b AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY score DESC, n_name) AS k FROM s) SELECT a.n_name, a.l_partkey, a.score FROM a JOIN b USING (n_name, l_partkey) WHERE a.k = 1 AND b.k = 1""")  # fmt: skip
def reciprocal_best(spark, sf):
    scores = _located(spark, sf).groupBy("n_name", "l_partkey").agg(F.sum(F.col("l_quantity").cast("long")).alias("score"))
    return similarity.reciprocal_best(scores, "n_name", "l_partkey", "score")


@query("reciprocal_keepers", """SELECT DISTINCT l_partkey AS candidate FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 9000)
  AND l_partkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 9000) AND l_partkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)""")  # fmt: skip
def reciprocal_keepers(spark, sf):
    items = table(spark, sf, "lineitem")
    seeds = table(spark, sf, "supplier").where("s_acctbal > 9000").select(F.col("s_suppkey").alias("id"))
    sources = table(spark, sf, "customer").where("c_acctbal > 5000").select(F.col("c_custkey").alias("id"))
    return similarity.reciprocal_keepers(items.select(F.col("l_partkey").alias("candidate")), items.select(F.col("l_partkey").alias("candidate"), F.col("l_suppkey").alias("hit")), seeds, sources)


@query("threshold_hits", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_quantity * 2 >= 95 AND 100 - l_discount * 100 >= 95 AND 100 - l_tax * 100 >= 95 AND l_linenumber <= p_size")
def threshold_hits(spark, sf):
    items, p = table(spark, sf, "lineitem"), table(spark, sf, "part").select("p_partkey", "p_size")
    rows = items.join(p, items["l_partkey"] == p["p_partkey"])
    rows = rows.withColumns({"identity": F.col("l_quantity") * 2, "qcov": 100 - F.col("l_discount") * 100, "scov": 100 - F.col("l_tax") * 100, "seed_length": F.col("l_linenumber"), "target_length": F.col("p_size")})
    return similarity.thresholds(rows).select("l_orderkey", "l_linenumber", "l_partkey")


@query("unique_claims", "WITH p AS (SELECT DISTINCT doc_id, md5(text) AS claim FROM documents) SELECT doc_id, claim FROM (SELECT *, count(*) OVER (PARTITION BY doc_id) AS a, count(*) OVER (PARTITION BY claim) AS b FROM p) WHERE a = 1 AND b = 1")
def unique_claims(spark, sf):
    """Documents that alone have their text."""
    return similarity.unique_claims(table(spark, sf, "documents").select("doc_id", F.md5("text").alias("claim")), "doc_id", "claim")


@query("optimal_assignment", f"""WITH {LOCATED}, s AS (SELECT n_name AS block, l_returnflag AS a, l_linenumber % 3 AS b, sum(l_quantity::BIGINT)::DOUBLE AS score FROM loc GROUP BY ALL),
  w AS (SELECT k.n_name AS block, x.b AS b1, y.b AS b2, z.b AS b3, coalesce(p.score, 0) + coalesce(q.score, 0) + coalesce(r.score, 0) AS total FROM nation k, (SELECT unnest([0, 1, 2]) AS b) x, (SELECT unnest([0, 1, 2]) AS b) y, (SELECT unnest([0, 1, 2]) AS b) z
    LEFT JOIN s p ON p.block = k.n_name AND p.a = 'A' AND p.b = x.b LEFT JOIN s q ON q.block = k.n_name AND q.a = 'N' AND q.b = y.b LEFT JOIN s r ON r.block = k.n_name AND r.a = 'R' AND r.b = z.b WHERE x.b <> y.b AND y.b <> z.b AND x.b <> z.b)
  SELECT block, arg_max(b1, total) AS "A", arg_max(b2, total) AS "N", arg_max(b3, total) AS "R", max(total) AS total FROM w WHERE block IN (SELECT block FROM s) GROUP BY block""")  # fmt: skip
def optimal_assignment(spark, sf):
    """Return flags to thirds of the line numbers in each nation, the pairing of greatest total quantity; the oracle tries all."""
    rows = _located(spark, sf).groupBy(F.col("n_name").alias("block"), F.col("l_returnflag").alias("a"), (F.col("l_linenumber") % 3).alias("b")).agg(F.sum(F.col("l_quantity").cast("long")).cast("double").alias("score"))
    found = similarity.optimal_assignment(rows, "block", "a", "b", "score").groupBy("block")
    return found.agg(*[F.max(F.when(F.col("a") == x, F.col("b"))).alias(x) for x in "ANR"], F.sum("score").alias("total"))


SEEDED = LOCATED + """, h AS (SELECT p_brand AS seed, substr(p_brand, 7)::INTEGER AS acc, n_nationkey AS nk, n_name AS target, sum(l_quantity::BIGINT)::BIGINT AS score FROM loc WHERE n_nationkey // 2 = substr(p_brand, 7)::INTEGER // 2 GROUP BY ALL),
  seeds AS (SELECT DISTINCT p_brand AS seed, substr(p_brand, 7)::INTEGER AS acc FROM part), direct AS (SELECT seed, n_name AS target FROM seeds JOIN nation ON n_nationkey = acc WHERE acc < 5),
  lft AS (SELECT * FROM h WHERE seed NOT IN (SELECT seed FROM direct) AND target NOT IN (SELECT target FROM direct)),
  alone AS (SELECT seed, target FROM (SELECT *, count(*) OVER (PARTITION BY seed) AS a, count(*) OVER (PARTITION BY target) AS b FROM lft) WHERE a = 1 AND b = 1),
  more AS (SELECT * FROM lft WHERE seed NOT IN (SELECT seed FROM alone)), tot AS (SELECT m.seed, m.target, m.acc // 2 AS block, m.score + coalesce(o.score, 0) AS total FROM more m LEFT JOIN more o ON o.acc // 2 = m.acc // 2 AND o.seed <> m.seed AND o.target <> m.target),
  solved AS (SELECT seed, target FROM (SELECT *, max(total) OVER (PARTITION BY block) AS best FROM tot) WHERE total = best),
  found AS (SELECT *, 'ACCESSION' AS status FROM direct UNION ALL SELECT *, 'UNIQUE' FROM alone UNION ALL SELECT *, 'ASSIGNED' FROM solved)"""


@query("seed_mapping", f"WITH {SEEDED} SELECT seed, target, coalesce(status, 'NOT_FOUND') AS status FROM seeds LEFT JOIN found USING (seed)")
def seed_mapping(spark, sf):
    """Brands mapped to nations of neighbouring numbers: by accession, by an only close hit, by assignment in pairs."""
    p = table(spark, sf, "part")
    accession = F.substring("p_brand", 7, 9).cast("int")
    seeds = p.select(F.col("p_brand").alias("seed"), accession.alias("accession")).distinct()
    accessions = table(spark, sf, "nation").where("n_nationkey < 5").select(F.col("n_nationkey").cast("int").alias("accession"), F.col("n_name").alias("target"))
    nations = table(spark, sf, "nation").select("n_name", "n_nationkey")
    rows = _located(spark, sf).select("n_name", "p_brand", "l_quantity").join(nations, "n_name").where(F.expr("n_nationkey div 2") == F.expr("int(substring(p_brand, 7, 9)) div 2"))
    rows = rows.groupBy(F.col("p_brand").alias("seed"), F.col("n_name").alias("target")).agg(F.sum(F.col("l_quantity").cast("long")).alias("score"))
    hits = rows.select("seed", "target", F.lit(99.0).alias("identity"), F.lit(100.0).alias("qcov"), F.lit(100.0).alias("scov"), F.lit(1).alias("seed_length"), F.lit(1).alias("target_length"), "score")
    return similarity.seed_mapping(seeds, accessions, hits)


@query("homologs", """WITH seeds AS (SELECT s_suppkey AS id FROM supplier WHERE s_acctbal > 5000), sources AS (SELECT s_suppkey AS id FROM supplier WHERE s_nationkey < 3),
  k AS (SELECT DISTINCT l_partkey AS id FROM lineitem WHERE l_suppkey IN (SELECT id FROM seeds) EXCEPT (SELECT id FROM seeds UNION SELECT id FROM sources)),
  f AS (SELECT k.id FROM k JOIN part ON p_partkey = id WHERE p_brand <> 'Brand#1')
  SELECT id, role, p_name AS sequence FROM (SELECT id, 'seed' AS role FROM seeds UNION ALL SELECT id, 'homolog' FROM f) JOIN part ON p_partkey = id""")  # fmt: skip
def homologs(spark, sf):
    """Suppliers as seeds, parts as candidates and brands as species, from seeds to whole sequences."""
    s, p, items = (table(spark, sf, t) for t in ("supplier", "part", "lineitem"))
    seeds, sources = s.where("s_acctbal > 5000").select(F.col("s_suppkey").alias("id")), s.where("s_nationkey < 3").select(F.col("s_suppkey").alias("id"))
    hits = items.select(F.col("l_suppkey").alias("query"), F.col("l_partkey").alias("subject"), F.lit("1-9").alias("region"))
    reverse = items.select(F.col("l_partkey").alias("candidate"), F.col("l_suppkey").alias("hit"))
    brands = p.select(F.col("p_partkey").alias("candidate"), "p_brand")
    keepers = p.where("p_brand <> 'Brand#1'").select(F.concat_ws("/", "p_brand", (F.col("p_partkey") % 5).cast("string")).alias("taxon"))
    named = hits.join(brands, F.col("subject") == F.col("candidate")).select("query", F.concat_ws("|", F.col("subject").cast("string"), F.concat_ws("/", "p_brand", (F.col("subject") % 5).cast("string"))).alias("subject"), "region")
    back = reverse.join(brands, "candidate").select(F.concat_ws("|", F.col("candidate").cast("string"), F.concat_ws("/", "p_brand", (F.col("candidate") % 5).cast("string"))).alias("candidate"), F.col("hit").cast("string").alias("hit"))
    full = p.select(F.concat_ws("|", F.col("p_partkey").cast("string"), F.concat_ws("/", "p_brand", (F.col("p_partkey") % 5).cast("string"))).alias("id"), F.col("p_name").alias("sequence"))
    text = lambda df: df.select(F.col("id").cast("string").alias("id"))
    own = lambda df: text(df).join(full.withColumn("_k", F.substring_index("id", "|", 1)).withColumnRenamed("id", "_id"), F.col("id") == F.col("_k")).select(F.col("_id").alias("id"))
    back = back.join(full.select(F.substring_index("id", "|", 1).alias("hit"), F.col("id").alias("_hit")), "hit").select("candidate", F.col("_hit").alias("hit"))
    out = similarity.homologs(named, back, own(seeds), own(sources), keepers, full, F.substring_index("candidate", "|", -1))
    return out.select(F.substring_index("id", "|", 1).cast("long").alias("id"), "role", "sequence")


ISLANDS = """f AS (SELECT user_id, event_type, pos, CASE WHEN pos - lag(pos) OVER (PARTITION BY user_id, event_type ORDER BY pos) <= 3 THEN 0 ELSE 1 END AS fresh
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos FROM events)), i AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id, event_type ORDER BY pos) AS k FROM f)"""


@query("position_islands", f"WITH {ISLANDS} SELECT user_id, event_type, count(*) AS members, min(pos)::INTEGER AS first, max(pos)::INTEGER AS last FROM i GROUP BY user_id, event_type, k HAVING count(*) >= 2")
def position_islands(spark, sf):
    placed = similarity.positions(table(spark, sf, "events"), "user_id", "ts", "event_id")
    return similarity.islands(placed, ["user_id", "event_type"], "position", 3)


def _event_genes(spark, sf):
    """Events of a user as genes along a chromosome; neighbours of one type are similar."""
    e = table(spark, sf, "events")
    start = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01', ts)")
    genes = e.select(F.lit("sp").alias("species"), F.col("event_id").cast("string").alias("gene"), F.col("user_id").cast("string").alias("chromosome"), start.alias("start"), (start + 1).alias("stop"), "event_type", "user_id")
    placed = similarity.positions(genes, "user_id", "start", "stop", "gene")
    a, b = placed.alias("a"), placed.alias("b")
    near = a.join(b, (F.col("a.user_id") == F.col("b.user_id")) & (F.col("a.event_type") == F.col("b.event_type")) & (F.col("b.position") > F.col("a.position")) & (F.col("b.position") <= F.col("a.position") + 5))
    return genes.drop("event_type", "user_id"), near.select(F.lit("sp").alias("species"), F.col("a.gene").alias("query"), F.col("b.gene").alias("subject"))


HOT = ISLANDS.replace("ORDER BY ts, event_id", "ORDER BY epoch_us(ts), event_id::VARCHAR").replace("SELECT user_id, event_type, pos,", "SELECT user_id, event_type, event_id, ts, pos,")


@query("hotspots", f"""WITH {HOT}, h AS (SELECT user_id::VARCHAR AS chromosome, count(*) AS genes, min(epoch_us(ts)) AS hotspot_start, max(epoch_us(ts)) + 1 AS hotspot_end, string_agg(event_id::VARCHAR, ',' ORDER BY epoch_us(ts), event_id::VARCHAR) AS gene_ids
  FROM i GROUP BY user_id, event_type, k HAVING count(*) >= 2)
  SELECT 'sp' AS species, chromosome, genes, hotspot_start, hotspot_end, hotspot_end AS max_end, gene_ids, 'sp_w6_' || lpad(row_number() OVER (ORDER BY chromosome, hotspot_start, hotspot_end, gene_ids)::VARCHAR, 5, '0') AS hotspot_id FROM h""")  # fmt: skip
def hotspots(spark, sf):
    genes, hits = _event_genes(spark, sf)
    return similarity.hotspots(hits, genes, window=6)


@query("hotspot_summary", f"""WITH {HOT}, h AS (SELECT count(*) AS genes FROM i GROUP BY user_id, event_type, k HAVING count(*) >= 2) SELECT 'sp' AS species, count(*) AS hotspots, sum(genes)::BIGINT AS genes, max(genes) AS largest, 'PROCESSED' AS status FROM h
  UNION ALL SELECT 'none', 0, 0, 0, 'EXCLUDED' UNION ALL SELECT NULL, count(*), sum(genes)::BIGINT, max(genes), 'TOTAL' FROM h""")  # fmt: skip
def hotspot_summary(spark, sf):
    genes, hits = _event_genes(spark, sf)
    manifest = spark.createDataFrame([("sp", False), ("none", True)], "species string, excluded boolean")
    return similarity.species_summary(similarity.hotspots(hits, genes, window=6), manifest)


@query("unplaced_hits", "SELECT (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT p_partkey FROM part)) AS query_unplaced, (SELECT count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)) AS subject_unplaced")
def unplaced_hits(spark, sf):
    return similarity.unplaced(_hits(spark, sf), table(spark, sf, "part").select(F.col("p_partkey").alias("gene")))


@query("even_split", "SELECT doc_id, ntile(7) OVER (ORDER BY doc_id)::INTEGER AS part FROM documents")
def even_split(spark, sf):
    return similarity.deal(table(spark, sf, "documents").select("doc_id"), 7, "doc_id")


@query("fixed_chunks", "SELECT source, doc_id, (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 20 AS chunk FROM documents")
def fixed_chunks(spark, sf):
    return similarity.deal_within(table(spark, sf, "documents").select("source", "doc_id"), 20, ["source"], "doc_id").withColumn("chunk", F.col("chunk").cast("long"))


@query("missing_chunks", "SELECT DISTINCT o_orderkey AS k FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def missing_chunks(spark, sf):
    return similarity.missing_chunks(table(spark, sf, "orders").select(F.col("o_orderkey").alias("k")), table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k")), "k")


@query("hit_regions", "SELECT l_partkey::VARCHAR AS subject, substr(p_name, 1 + (l.l_linenumber % 3), 4) AS region FROM (SELECT l_partkey, arg_max(l_linenumber, (l_orderkey, l_linenumber, l_suppkey)) AS l_linenumber FROM lineitem GROUP BY 1) l JOIN part ON p_partkey = l_partkey")
def hit_regions(spark, sf):
    items = table(spark, sf, "lineitem")
    start = (1 + F.col("l_linenumber") % 3).cast("long")
    hits = items.select(F.col("l_partkey").cast("string").alias("subject"), start.alias("sstart"), (start + 3).alias("send"), F.struct("l_orderkey", "l_linenumber", "l_suppkey").alias("ordinal"))
    return similarity.subsequences(hits, table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("sequence")))


@query("similar_vectors", """WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings) SELECT query, subject, cosine FROM (SELECT x.vec_id AS query, y.vec_id AS subject, round_even(list_dot_product(x.e, y.e) / (sqrt(list_dot_product(x.e, x.e)) * sqrt(list_dot_product(y.e, y.e))), 6) AS cosine
  FROM v x JOIN v y ON x.vec_id <> y.vec_id WHERE x.vec_id % 50 = 0) WHERE cosine >= 0.1""")  # fmt: skip
def similar_vectors(spark, sf):
    """Every fiftieth vector is a query against all vectors."""
    v = table(spark, sf, "embeddings")
    return similarity.similar_to(v.where("vec_id % 50 = 0"), v, "vec_id", "embedding", 0.1)


@query("order_components", "WITH e AS (SELECT DISTINCT o_custkey, o_orderkey FROM orders) SELECT o_orderkey AS node, min(o_orderkey) OVER (PARTITION BY o_custkey) AS comp FROM e QUALIFY count(*) OVER (PARTITION BY o_custkey) > 1")
def order_components(spark, sf):
    """Orders linked to the next order of their customer: long chains, one component a customer."""
    from pyspark.sql import Window

    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey").distinct()
    links = o.withColumn("next", F.lead("o_orderkey").over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))).where("next is not null")
    return graphs.components(links, "o_orderkey", "next")
