"""Queries of lookups, fillers, vocabularies and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from arbora.operators import composition, history, integrate, similarity, topology
from arbora.operators import trees as T
from arbora.operators.skew import numbered_rows
from arbora.plans.q_history import ALL, BASE, MEMBERS, OCC, _members, _occupied
from arbora.plans.world import LOT, PRESENCE, REGIONS, WORLD, Query, presence, sql, table, tip_groups, topologies, tree

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle:
            SQL[name] = oracle
        return fn

    return register


@query("header_matches", "SELECT p_partkey, strict, true AS broad FROM (SELECT p_partkey, contains(p_name, 'red') OR contains(p_name, 'small_bolt') OR contains(p_name, 'small bolt') AS strict FROM part)")
def header_matches(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", F.upper("p_name").alias("h"))
    strict = integrate.header_matches(p, "p_partkey", "h", ["Red", "small_bolt"]).withColumn("strict", F.lit(True))
    broad = integrate.header_matches(p, "p_partkey", "h").withColumn("broad", F.lit(True))
    return p.select("p_partkey").join(strict, "p_partkey", "left").join(broad, "p_partkey", "left").fillna(False, ["strict", "broad"])


@query("lockstep_join", "SELECT row_number() OVER (ORDER BY c_custkey)::INTEGER AS k, c_custkey, c_name, c_acctbal FROM customer")
def lockstep_join(spark, sf):
    c = numbered_rows(table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal"), "_number", "c_custkey").withColumn("k", (F.col("_number") + 1).cast("int"))
    return integrate.lockstep(c.select("k", "c_custkey", "c_name"), c.select("k", "c_custkey", "c_acctbal"), "k", "c_custkey")


@query("first_descriptions", "SELECT p_brand, arg_min(p_name, p_partkey) FILTER (p_size > 25) AS p_name FROM part GROUP BY p_brand")
def first_descriptions(spark, sf):
    p = table(spark, sf, "part").select("p_brand", F.when(F.col("p_size") > 25, F.col("p_name")).alias("p_name"), "p_partkey")
    return integrate.first_described(p, "p_brand", "p_name", "p_partkey")


@query("filler_codes", "SELECT o_orderkey AS entity, o_orderstatus, 'unannotated_flags-' || row_number() OVER (ORDER BY o_orderstatus, o_orderkey) AS code FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def filler_codes(spark, sf):
    every = table(spark, sf, "orders").select(F.col("o_orderkey").alias("entity"), "o_orderstatus")
    return integrate.fillers(every, table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("entity")), "flags", "o_orderstatus", "entity")


@query("vocabulary_counts", """WITH l AS (SELECT l_suppkey, p_brand, p_type FROM lineitem JOIN part ON l_partkey = p_partkey), c AS (SELECT l_suppkey, string_agg(p_type || ':' || n, ',' ORDER BY p_type) AS categories FROM (SELECT l_suppkey, p_type, count(*) AS n FROM l GROUP BY ALL) GROUP BY 1)
  SELECT l_suppkey, count(*) AS annotations, count(DISTINCT p_brand) AS codes, round_even(count(DISTINCT p_brand) / count(*), 4) AS diversity, any_value(categories) AS categories FROM l JOIN c USING (l_suppkey) GROUP BY l_suppkey""")  # fmt: skip
def vocabulary_counts(spark, sf):
    items, p = table(spark, sf, "lineitem"), table(spark, sf, "part")
    return integrate.vocabulary_counts(items.join(p, items["l_partkey"] == p["p_partkey"]), "l_suppkey", "p_brand", "p_type")


@query("feature_lookup", """WITH a AS (SELECT DISTINCT source, doc_id FROM documents WHERE n_chars < 500), b AS (SELECT DISTINCT source, doc_id FROM documents JOIN labels USING (doc_id) WHERE toxic = 1), c AS (SELECT DISTINCT source, doc_id FROM documents WHERE contains(text, ' | '))
  SELECT source, doc_id, a.doc_id IS NOT NULL AS short, b.doc_id IS NOT NULL AS toxic, c.doc_id IS NOT NULL AS tabular FROM (SELECT * FROM a UNION SELECT * FROM b UNION SELECT * FROM c) u
  LEFT JOIN a USING (source, doc_id) LEFT JOIN b USING (source, doc_id) LEFT JOIN c USING (source, doc_id)""")  # fmt: skip
def feature_lookup(spark, sf):
    d = table(spark, sf, "documents")
    toxic = d.select("doc_id", "source").join(table(spark, sf, "labels").where("toxic = 1"), "doc_id")
    return integrate.feature_lookup(["source", "doc_id"], short=d.where("n_chars < 500"), toxic=toxic, tabular=d.where("contains(text, ' | ')"))


@query("quality_summary", "SELECT source, documents, n50, en, de, labelled FROM (SELECT source, count(*) AS documents, count(*) FILTER (lang = 'en') AS en, count(*) FILTER (lang = 'de') AS de FROM documents GROUP BY 1) JOIN (SELECT source, max(CASE WHEN run * 2 >= total THEN n_chars END) AS n50 FROM (SELECT source, n_chars, sum(n_chars) OVER (PARTITION BY source ORDER BY n_chars DESC ROWS UNBOUNDED PRECEDING) AS run, sum(n_chars) OVER (PARTITION BY source) AS total FROM documents) GROUP BY 1) USING (source) LEFT JOIN (SELECT source, count(*) AS labelled FROM documents JOIN labels USING (doc_id) GROUP BY 1) USING (source)")
def quality_summary(spark, sf):
    from arbora.operators import statistics

    d = table(spark, sf, "documents").select("doc_id", "source", "lang", "n_chars")
    base = d.groupBy("source").agg(F.count(F.lit(1)).alias("documents"))
    labelled = d.join(table(spark, sf, "labels"), "doc_id").groupBy("source").agg(F.count(F.lit(1)).alias("labelled"))
    long = d.groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n"))
    parts = {"n50": statistics.n50(d, "n_chars", "source").select("source", "n50"), "labels": labelled}
    return integrate.quality_summary(base, "source", parts, long, "lang", ["en", "de"], "n").fillna(0, ["en", "de"])


@query("taxonomy_summary", "SELECT 'region' AS rank, r_name AS name, count(*) AS n FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name UNION ALL SELECT 'nation', n_name, count(*) FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name")
def taxonomy_summary(spark, sf):
    s, n = table(spark, sf, "supplier"), table(spark, sf, "nation")
    rows = s.join(n, s["s_nationkey"] == n["n_nationkey"]).join(tip_groups(spark, sf), F.col("n_name") == F.col("tip"))
    return integrate.taxonomy_summary(rows.select(F.col("grp").alias("region"), F.col("n_name").alias("nation")), ["region", "nation"])


@query("overridden_names", "SELECT n_nationkey, CASE WHEN n_nationkey % 5 = 0 THEN 'custom_' || n_nationkey ELSE n_name END AS n_name, n_nationkey % 5 = 0 AS overridden FROM nation")
def overridden_names(spark, sf):
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    custom = n.where("n_nationkey % 5 = 0").select("n_nationkey", F.concat(F.lit("custom_"), F.col("n_nationkey").cast("string")).alias("n_name"))
    return integrate.overridden(n, custom, "n_nationkey", "n_name")


@query("wanted_sets", "WITH w AS (SELECT DISTINCT p_brand AS grp, p_type AS member FROM part, (SELECT 1) WHERE p_partkey < 50 UNION SELECT 'Brand#1', 'NONE') SELECT grp, member, EXISTS (SELECT 1 FROM part WHERE p_brand = grp AND p_type = member AND p_size > 40) AS found FROM w")
def wanted_sets(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_brand").alias("grp"), F.col("p_type").alias("member"), "p_partkey", "p_size")
    wanted = p.where("p_partkey < 50").select("grp", "member").union(spark.createDataFrame([("Brand#1", "NONE")], "grp string, member string")).distinct()
    return integrate.wanted_sets(p.where("p_size > 40"), wanted)


@query("composite_summary", sql(PRESENCE, WORLD, OCC, MEMBERS, """pick AS (SELECT feature, CASE WHEN g0::INT + g2::INT >= 2 THEN 'early' END AS a, CASE WHEN NOT g2 AND NOT outside THEN 'no_asia' END AS b FROM occ),
  c AS (SELECT feature, a AS composite FROM pick WHERE a IS NOT NULL UNION ALL SELECT feature, b FROM pick WHERE b IS NOT NULL)""",
  "SELECT composite, count(DISTINCT feature) AS groups, count(DISTINCT entity) AS entities, count(*) AS rows FROM c JOIN mem ON group_key = feature GROUP BY composite"))
def composite_summary(spark, sf):
    rule, inner = composition.composite_rule, ["AFRICA", "ASIA", "EUROPE"]
    picked = composition.composite_table(_occupied(spark, sf), {"early": rule("core_early_clade", inner, ["AFRICA", "ASIA"]), "no_asia": rule("absent", inner, ["ASIA", "outside"])})
    rows = picked.join(_members(spark, sf), "group_key").groupBy("composite")
    return rows.agg(F.count_distinct("group_key").alias("groups"), F.count_distinct("entity").alias("entities"), F.count(F.lit(1)).alias("rows"))


@query("clade_order", sql(ALL, "SELECT topology, node, n::INTEGER AS n_tips, (row_number() OVER (PARTITION BY topology ORDER BY n DESC, node))::INTEGER AS place FROM (SELECT topology, node, count(*) AS n FROM paths3 GROUP BY ALL)"))
def clade_order(spark, sf):
    """Nodes from the largest clade to the tips, as columns of wide tables are ordered."""
    from pyspark.sql import Window

    nodes = T.tables(spark, topologies(spark, sf))["nodes"]
    return nodes.select("topology", "node", "n_tips", F.row_number().over(Window.partitionBy("topology").orderBy(F.desc("n_tips"), "node")).alias("place"))


@query("clade_presence", sql(PRESENCE, WORLD, "SELECT feature, " + ", ".join(f"bool_or(grp = '{g}') AS \"{g}\"" for g in REGIONS) + " FROM pres JOIN geo USING (tip) GROUP BY feature"))
def clade_presence(spark, sf):
    rows = presence(spark, sf).join(tip_groups(spark, sf), "tip").groupBy("feature").pivot("grp", REGIONS).agg(F.count(F.lit(1)))
    return rows.select("feature", *[F.coalesce(F.col(f"`{g}`") > 0, F.lit(False)).alias(g) for g in REGIONS])


@query("group_counts_by_tip", sql(MEMBERS, "SELECT tip, count(DISTINCT group_key) AS groups, count(DISTINCT entity) AS entities, count(*) AS rows FROM mem GROUP BY tip"))
def group_counts_by_tip(spark, sf):
    return _members(spark, sf).groupBy("tip").agg(F.count_distinct("group_key").alias("groups"), F.count_distinct("entity").alias("entities"), F.count(F.lit(1)).alias("rows"))


@query("origin_depths", sql(*BASE, "SELECT depth::INTEGER AS depth, count(*) AS features, avg(n_tips) AS mean_tips FROM origin GROUP BY depth"))
def origin_depths(spark, sf):
    return history.origins(presence(spark, sf), tree(spark, sf)).groupBy("depth").agg(F.count(F.lit(1)).alias("features"), F.avg("n_tips").alias("mean_tips"))


@query("self_hits", "SELECT count(*) AS hits, count(*) FILTER (l_quantity = 50 AND l_linenumber = 1 AND l_discount = 0) AS own FROM lineitem")
def self_hits(spark, sf):
    """The strict test of a hit on oneself."""
    rows = table(spark, sf, "lineitem").select((F.col("l_quantity") * 2).alias("pident"), (F.col("l_linenumber") - 1).alias("mismatch"), (F.col("l_discount") * 100).alias("gapopen"), F.lit(1).alias("qstart"), F.lit(98).alias("qend"), F.lit(100).alias("qlen"))
    return rows.agg(F.count(F.lit(1)).alias("hits"), F.sum(similarity.is_self_hit().cast("long")).alias("own"))


@query("near_pairs", "WITH p AS (SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos FROM events) SELECT a.user_id::VARCHAR AS chromosome, a.event_id AS a, b.event_id AS b FROM p a JOIN p b ON a.user_id = b.user_id AND b.event_id = a.event_id + 150 AND abs(a.pos - b.pos) <= 2")
def near_pairs(spark, sf):
    """Given hits kept where both genes lie near each other on one chromosome."""
    e = table(spark, sf, "events")
    placed = similarity.positions(e, "user_id", "ts", "event_id").select(F.col("event_id").alias("gene"), F.col("user_id").cast("string").alias("chromosome"), "position")
    hits = e.select(F.col("event_id").alias("query"), (F.col("event_id") + 150).alias("subject"))
    return similarity.neighbour_pairs(hits, placed, window=4)


@query("newick_paths", sql(ALL, "SELECT topology, node, string_agg(up, '>' ORDER BY d) AS path FROM (SELECT DISTINCT a.topology, a.node, b.node AS up, b.depth AS d FROM paths3 a JOIN paths3 b ON a.topology = b.topology AND a.tip = b.tip AND b.depth <= a.depth) GROUP BY ALL"))
def newick_paths(spark, sf):
    """The path from the root of every clade of several topologies."""
    rows = [(t, n, ">".join(p)) for t, root in topologies(spark, sf) for n, p in T.paths_of(root).items()]
    return spark.createDataFrame(rows, "topology string, node string, path string")


@query("direct_children", sql(ALL, "SELECT DISTINCT topology FROM edges3 WHERE parent = 'ASIA' AND child = 'NATION_2'"))
def direct_children(spark, sf):
    return topology.select_topologies(T.tables(spark, topologies(spark, sf))["edges"], direct_child=[("ASIA", "NATION_2")])


@query("large_lots", f"SELECT l_partkey AS feature, count(*) AS lots, count(DISTINCT l_suppkey) AS suppliers FROM lineitem WHERE l_quantity >= {LOT} GROUP BY 1 HAVING count(DISTINCT l_suppkey) >= 5")
def large_lots(spark, sf):
    rows = table(spark, sf, "lineitem").where(F.col("l_quantity") >= LOT).groupBy(F.col("l_partkey").alias("feature"))
    return rows.agg(F.count(F.lit(1)).alias("lots"), F.count_distinct("l_suppkey").alias("suppliers")).where("suppliers >= 5")
