"""Queries of origins, states and topologies."""

from __future__ import annotations

from pyspark.sql import functions as F

from arbora.operators import checks, composition, history, topology
from arbora.operators import trees as T
from arbora.plans.world import HELD, LOT, ORIGIN, PRESENCE, REGIONS, WORLD, Query, presence, sql, table, tip_groups, topologies, tree

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle:
            SQL[name] = oracle
        return fn

    return register


BASE = (PRESENCE, WORLD, ORIGIN)


@query("origin_by_feature", sql(*BASE, """SELECT '001' AS topology, feature, o.n_tips, n_tips AS n_tips_raw, tips, origin, parent || '::' || origin AS origin_edge,
  parent || '::' || origin || '-O' AS origin_state, route AS path FROM origin o JOIN edges ON child = origin
  JOIN (SELECT feature, string_agg(tip, ',' ORDER BY tip) AS tips FROM pres GROUP BY feature) USING (feature)
  JOIN (SELECT DISTINCT a.node AS origin, string_agg(b.node, ',' ORDER BY b.depth) AS route FROM paths a JOIN paths b ON a.tip = b.tip AND b.depth <= a.depth GROUP BY a.tip, a.node) USING (origin)"""))  # fmt: skip
def origin_by_feature(spark, sf):
    return history.origin_table(presence(spark, sf), tree(spark, sf))


@query("edge_states", sql(*BASE, HELD, "SELECT '001' AS topology, feature, parent, child, state FROM states"))
def edge_states(spark, sf):
    return history.edge_states(presence(spark, sf), tree(spark, sf))


@query("edge_counts", sql(*BASE, HELD, """SELECT '001' AS topology, parent, child, inherited, conserved, inherited - conserved AS lost,
  CASE WHEN inherited > 0 THEN round_even(100.0::DOUBLE * conserved / inherited, 4) ELSE 0.0 END AS conservation_rate,
  CASE WHEN inherited > 0 THEN round_even(100.0::DOUBLE * (inherited - conserved) / inherited, 4) ELSE 0.0 END AS loss_rate FROM counts"""))  # fmt: skip
def edge_counts(spark, sf):
    return history.edge_counts(presence(spark, sf), tree(spark, sf))


@query("feature_counts", sql(*BASE, HELD, """SELECT '001' AS topology, feature, max(n_tips) AS n_tips, max(origin) AS origin, count(*) FILTER (state = 'P') AS conserved,
  count(*) FILTER (state = 'L') AS lost, count(*) FILTER (state = 'X') AS absent FROM states JOIN origin USING (feature) GROUP BY feature"""))  # fmt: skip
def feature_counts(spark, sf):
    return history.feature_counts(presence(spark, sf), tree(spark, sf))


@query("clade_summary", sql(*BASE, HELD, """SELECT '001' AS topology, node, tips, coalesce(origins, 0) AS origins, coalesce(present, 0) AS present, coalesce(c, 0)::BIGINT AS conserved,
  coalesce(l, 0)::BIGINT AS lost FROM (SELECT node, count(DISTINCT tip) AS tips FROM paths GROUP BY node)
  LEFT JOIN (SELECT origin AS node, count(*) AS origins FROM origin GROUP BY 1) USING (node)
  LEFT JOIN (SELECT node, count(DISTINCT feature) AS present FROM pres JOIN paths USING (tip) GROUP BY node) USING (node)
  LEFT JOIN (SELECT parent AS node, sum(conserved) AS c, sum(inherited - conserved) AS l FROM counts GROUP BY 1) USING (node)"""))  # fmt: skip
def clade_summary(spark, sf):
    return history.clade_summary(presence(spark, sf), tree(spark, sf))


@query("tip_summary", sql(*BASE, """SELECT '001' AS topology, tip, coalesce(f, 0) AS features, coalesce(s, 0) AS tip_specific, coalesce(f, 0) - coalesce(s, 0) AS conserved FROM geo
  LEFT JOIN (SELECT tip, count(*) AS f FROM pres GROUP BY tip) USING (tip) LEFT JOIN (SELECT origin AS tip, count(*) AS s FROM origin GROUP BY 1) USING (tip)"""))  # fmt: skip
def tip_summary(spark, sf):
    return history.tip_summary(presence(spark, sf), tree(spark, sf))


@query("path_states", sql(*BASE, HELD, """SELECT '001' AS topology, o.feature, p.tip, string_agg(coalesce(s.state, 'A'), '' ORDER BY p.depth) AS path_state
  FROM origin o CROSS JOIN paths p LEFT JOIN states s ON s.feature = o.feature AND s.child = p.node GROUP BY o.feature, p.tip"""))  # fmt: skip
def path_states(spark, sf):
    return history.path_states(presence(spark, sf), tree(spark, sf))


@query("origin_summary", sql(*BASE, """SELECT '001' AS topology, child, parent, coalesce(n, 0) AS features, round_even(100.0::DOUBLE * coalesce(n, 0) / sum(coalesce(n, 0)) OVER (), 4) AS percent
  FROM edges LEFT JOIN (SELECT origin AS child, count(*) AS n FROM origin GROUP BY 1) USING (child)"""))  # fmt: skip
def origin_summary(spark, sf):
    return history.origin_summary(presence(spark, sf), tree(spark, sf))


@query("innovations", sql(*BASE, """SELECT '001' AS topology, node, coalesce(a, 0) AS any_tips, coalesce(e, 0)::BIGINT AS every_tip, coalesce(b, 0) AS origin_at FROM (SELECT node, count(*) AS n_tips FROM paths GROUP BY node)
  LEFT JOIN (SELECT node, count(*) AS a, count(*) FILTER (n = clade) AS e FROM shared JOIN sizes USING (feature) JOIN (SELECT node, count(*) AS clade FROM paths GROUP BY node) USING (node) WHERE k = n GROUP BY node) USING (node)
  LEFT JOIN (SELECT origin AS node, count(*) AS b FROM origin GROUP BY 1) USING (node)"""))  # fmt: skip
def innovations(spark, sf):
    return history.innovations(presence(spark, sf), tree(spark, sf))


@query("shared_by_two", sql(PRESENCE, WORLD, """SELECT first, second, count(*) AS features FROM (SELECT feature, min(grp) AS first, max(grp) AS second FROM pres JOIN geo USING (tip)
  GROUP BY feature HAVING count(DISTINCT grp) = 2) GROUP BY ALL"""))  # fmt: skip
def shared_by_two(spark, sf):
    return history.shared_by_two(presence(spark, sf), tip_groups(spark, sf))


@query("run_totals", sql(*BASE, HELD, """SELECT '001' AS topology, (SELECT count(*) FROM origin) AS features, (SELECT count(*) FROM origin WHERE n_tips = 1) AS single_tip,
  sum(conserved)::BIGINT AS conserved, sum(inherited - conserved)::BIGINT AS lost, count(*) FILTER (inherited = 0) AS empty_edges FROM counts"""))  # fmt: skip
def run_totals(spark, sf):
    return history.run_totals(presence(spark, sf), tree(spark, sf))


@query("state_explode", sql(*BASE, HELD, "SELECT '001' AS topology, feature, parent, child, state FROM states WHERE state IN ('O', 'P', 'L')"))
def state_explode(spark, sf):
    t = tree(spark, sf)
    return history.explode_path_states(history.path_states(presence(spark, sf), t), t)


@query("history_checks", "SELECT * FROM (VALUES " + ", ".join(f"('{c}', 0::BIGINT)" for c in (
    "inherited is conserved and lost", "edge sums equal state sums", "each feature in the tree has one origin", "the origin is on every member''s path", "P, L and X cover the origin''s clade",
    "path states follow A*(O P* (L X*)?)?", "path states are as long as paths", "a path ends in P or O where the tip is a member")) + ") v(\"check\", violations)")
def history_checks(spark, sf):
    return checks.history_checks(presence(spark, sf), tree(spark, sf))


# several topologies, which the oracle enumerates by itself: clades are put together from smaller ones by bit masks, the
# trees numbered with the comb first and then by canonical form, inner nodes named as they are first met, breadth first
_PART = """SELECT '(' || least(a.form, b.form) || ',' || greatest(a.form, b.form) || ')' AS form, a.mask | b.mask AS mask,
  list_concat([{'form': '(' || least(a.form, b.form) || ',' || greatest(a.form, b.form) || ')', 'route': ''}],
  list_transform(a.parts, lambda x: {'form': x.form, 'route': '0' || x.route}), list_transform(b.parts, lambda x: {'form': x.form, 'route': '1' || x.route})) AS parts
  FROM smaller a JOIN smaller b ON a.mask & b.mask = 0 AND a.mask & -a.mask < b.mask & -b.mask AND bit_count(a.mask) + bit_count(b.mask) = """
_CLADES = "t1 AS (SELECT r_name AS form, (1 << (row_number() OVER (ORDER BY r_name) - 1)::INTEGER) AS mask, [{'form': r_name, 'route': ''}] AS parts FROM region),\n"
for _n in range(2, len(REGIONS) + 1):
    _CLADES += f"s{_n} AS (" + " UNION ALL ".join(f"SELECT * FROM t{_k}" for _k in range(1, _n)) + f"),\nt{_n} AS ({_PART.replace('smaller', f's{_n}')}{_n}),\n"
_COMB = "(" * (len(REGIONS) - 1) + REGIONS[0] + "".join(f",{r})" for r in REGIONS[1:])
_TOP = _CLADES + f"""numbered AS (SELECT lpad(row_number() OVER (ORDER BY form <> '{_COMB}', form)::VARCHAR, 3, '0') AS topology, parts FROM t{len(REGIONS)}),
parts AS (SELECT topology, x.form AS form, x.route AS route FROM (SELECT topology, unnest(parts) AS x FROM numbered)),
inner_names AS (SELECT form, 'N' || lpad(row_number() OVER (ORDER BY min((topology, length(route), route)))::VARCHAR, 3, '0') AS name FROM parts WHERE starts_with(form, '(') GROUP BY form),
named AS (SELECT topology, route, coalesce(name, form) AS name FROM parts LEFT JOIN inner_names USING (form)),
top(topology, parent, child) AS (SELECT n.topology, CASE WHEN n.route = '' THEN 'OOL' ELSE p.name END, n.name FROM named n LEFT JOIN named p ON p.topology = n.topology AND n.route <> '' AND p.route = left(n.route, length(n.route) - 1))"""
ALL = f"""RECURSIVE {_TOP},
geo AS (SELECT n_name AS tip, r_name AS grp FROM nation JOIN region ON n_regionkey = r_regionkey),
edges3 AS (SELECT * FROM top UNION ALL SELECT topology, grp, tip FROM geo CROSS JOIN (SELECT DISTINCT topology FROM top)),
up AS (SELECT topology, tip, tip AS node, 0 AS h FROM geo CROSS JOIN (SELECT DISTINCT topology FROM top) UNION ALL
  SELECT u.topology, u.tip, e.parent, u.h + 1 FROM up u JOIN edges3 e ON e.topology = u.topology AND e.child = u.node WHERE e.parent <> 'OOL'),
paths3 AS (SELECT topology, tip, node, max(h) OVER (PARTITION BY topology, tip) - h AS depth FROM up)"""
#: The first three only, for the queries that are about three.
THREE = ALL.replace("edges3 AS (SELECT * FROM top UNION", "edges3 AS (SELECT * FROM top WHERE topology <= '003' UNION").replace("(SELECT DISTINCT topology FROM top)", "(SELECT DISTINCT topology FROM top WHERE topology <= '003')")
ORIGIN3 = """sizes AS (SELECT feature, count(*) AS n FROM pres GROUP BY feature),
shared3 AS (SELECT topology, feature, node, depth, count(*) AS k FROM pres JOIN paths3 USING (tip) GROUP BY ALL),
origin3 AS (SELECT topology, feature, max(n) AS n_tips, arg_max(node, depth) AS origin, max(depth) AS depth FROM shared3 JOIN sizes USING (feature) WHERE k = n GROUP BY ALL)"""
HELD3 = """held3 AS (SELECT DISTINCT topology, feature, node FROM pres JOIN paths3 p USING (tip) JOIN origin3 o USING (topology, feature) WHERE p.depth >= o.depth),
counts3 AS (SELECT e.topology, e.parent, e.child, count(h.feature) AS inherited, count(c.feature) AS conserved FROM edges3 e LEFT JOIN held3 h ON h.topology = e.topology AND h.node = e.parent
  LEFT JOIN held3 c ON c.topology = e.topology AND c.node = e.child AND c.feature = h.feature GROUP BY ALL)"""


@query("origins_three_topologies", sql(THREE, PRESENCE, ORIGIN3, "SELECT topology, feature, n_tips, origin, depth::INTEGER AS depth FROM origin3"))
def origins_three_topologies(spark, sf):
    return history.origins(presence(spark, sf), T.tables(spark, topologies(spark, sf, 3)))


@query("edge_counts_three_topologies", sql(THREE, PRESENCE, ORIGIN3, HELD3, "SELECT topology, parent, child, inherited, conserved, inherited - conserved AS lost FROM counts3"))
def edge_counts_three_topologies(spark, sf):
    return history.edge_counts(presence(spark, sf), T.tables(spark, topologies(spark, sf, 3))).select("topology", "parent", "child", "inherited", "conserved", "lost")


@query("topology_aggregate", sql(ALL, PRESENCE, ORIGIN3, HELD3, """SELECT metric, sum(v)::DOUBLE AS total, min(v)::DOUBLE AS least, max(v)::DOUBLE AS greatest, median(v)::DOUBLE AS median,
  round_even(avg(v), 4) AS mean, count(*) AS n FROM (SELECT topology, 'conserved' AS metric, sum(conserved)::DOUBLE AS v FROM counts3 GROUP BY topology
  UNION ALL SELECT topology, 'lost', sum(inherited - conserved)::DOUBLE FROM counts3 GROUP BY topology) GROUP BY metric"""))  # fmt: skip
def topology_aggregate(spark, sf):
    totals = history.run_totals(presence(spark, sf), T.tables(spark, topologies(spark, sf)))
    return history.topology_aggregate(totals, ["conserved", "lost"], [])


@query("origins_all_topologies", sql(ALL, PRESENCE, ORIGIN3, "SELECT topology, origin, count(*) AS features FROM origin3 GROUP BY ALL"))
def origins_all_topologies(spark, sf):
    """Origins by topology and node, counted: 105 topologies in one job."""
    return history.origin_counts(presence(spark, sf), T.tables(spark, topologies(spark, sf))["paths"])


@query("ambiguous_nodes", sql(ALL, "SELECT node, count(DISTINCT topology) AS topologies, 105::BIGINT AS \"of\" FROM paths3 GROUP BY node HAVING count(DISTINCT topology) < 105"))
def ambiguous_nodes(spark, sf):
    return history.ambiguous_nodes(T.tables(spark, topologies(spark, sf))["nodes"])


@query("project_topologies", sql(ALL, "SELECT DISTINCT topology, node FROM paths3 WHERE topology IN ('001', '003')"))
def project_topologies(spark, sf):
    return history.project_topologies(T.tables(spark, topologies(spark, sf))["nodes"].select("topology", "node"), "some", ["001", "003"])


@query("expected_unique", sql(PRESENCE, WORLD, """m AS (SELECT grp, count(*) AS m FROM geo GROUP BY grp),
  k AS (SELECT feature, grp, count(*) AS k FROM pres JOIN geo USING (tip) GROUP BY ALL),
  p AS (SELECT feature, grp, 1.0::DOUBLE - list_product(list_transform(range(0, least(2, m)), lambda i: greatest(0, m - k - i)::DOUBLE / (m - i))) AS p FROM k JOIN m USING (grp)),
  e AS (SELECT a.grp, a.p * coalesce(list_product(list(1 - b.p)), 1.0) AS e FROM p a LEFT JOIN p b ON b.feature = a.feature AND b.grp <> a.grp GROUP BY a.feature, a.grp, a.p)""",
  "SELECT grp, round_even(sum(e), 6) AS expected_unique FROM e GROUP BY grp"))
def expected_unique(spark, sf):
    return history.equalized_uniqueness(presence(spark, sf), tip_groups(spark, sf))


@query("ancestral_loss", sql(PRESENCE, WORLD, """g AS (SELECT DISTINCT feature, grp FROM pres JOIN geo USING (tip)),
  r AS (SELECT * FROM g WHERE grp <> 'AFRICA' AND feature IN (SELECT feature FROM g WHERE grp = 'AFRICA')),
  k AS (SELECT feature, count(*) AS k FROM r GROUP BY feature)""", """SELECT n.grp, (SELECT count(*) FROM r JOIN k USING (feature) WHERE r.grp = n.grp AND k = 1) AS kept_alone,
  (SELECT count(*) FROM k WHERE k = 3 AND NOT EXISTS (SELECT 1 FROM r WHERE r.feature = k.feature AND r.grp = n.grp)) AS lost_alone FROM (SELECT DISTINCT grp FROM geo WHERE grp <> 'AFRICA') n"""))  # fmt: skip
def ancestral_loss(spark, sf):
    return history.ancestral_loss(presence(spark, sf), tip_groups(spark, sf), ["AFRICA"])


# trees
@query("clade_table", sql(WORLD, """SELECT '001' AS topology, parent, child AS node, coalesce(n, 0) AS tips, coalesce(l, '') AS tip_list FROM edges
  LEFT JOIN (SELECT node AS child, count(*) AS n, string_agg(tip, ',' ORDER BY tip) AS l FROM paths WHERE node <> tip GROUP BY node) USING (child)"""))  # fmt: skip
def clade_table(spark, sf):
    return topology.clade_table(tree(spark, sf))


@query("root_paths", sql(ALL, "SELECT topology, tip, string_agg(node, '>' ORDER BY depth) AS path FROM paths3 GROUP BY ALL"))
def root_paths(spark, sf):
    return topology.root_paths(T.tables(spark, topologies(spark, sf)))


@query("tree_edges", sql(ALL, "SELECT topology, parent, child FROM edges3"))
def tree_edges(spark, sf):
    return T.tables(spark, topologies(spark, sf))["edges"]


@query("select_topologies", sql(ALL, """SELECT DISTINCT a.topology FROM edges3 a JOIN edges3 b ON a.topology = b.topology AND a.parent = b.parent
  WHERE a.child = 'AFRICA' AND b.child = 'AMERICA'"""))  # fmt: skip
def select_topologies(spark, sf):
    return topology.select_topologies(T.tables(spark, topologies(spark, sf))["edges"], sister=[("AFRICA", "AMERICA")])


@query("representative_topology", sql(ALL, """SELECT topology, shared FROM (SELECT e.topology, count(r.child) AS shared FROM edges3 e LEFT JOIN edges3 r ON r.topology = '001' AND r.parent = e.parent AND r.child = e.child
  WHERE e.topology <> '001' GROUP BY e.topology) ORDER BY shared DESC, topology LIMIT 1"""))  # fmt: skip
def representative_topology(spark, sf):
    edges = T.tables(spark, topologies(spark, sf))["edges"]
    return topology.representative(edges, edges.where("topology <> '001'").select("topology").distinct(), "001")


@query("path_sums", sql(*BASE, HELD, "SELECT '001' AS topology, tip, sum(inherited)::BIGINT AS inherited, sum(conserved)::BIGINT AS conserved FROM paths JOIN counts ON child = node GROUP BY tip"))
def path_sums(spark, sf):
    t = tree(spark, sf)
    return topology.path_sums(history.edge_counts(presence(spark, sf), t).drop("parent"), t["paths"], ["inherited", "conserved"])


@query("path_sums_between", sql(*BASE, HELD, "SELECT '001' AS topology, tip, count(*) AS edges, sum(inherited)::BIGINT AS inherited FROM paths JOIN counts ON child = node WHERE depth = 1 GROUP BY tip"))
def path_sums_between(spark, sf):
    t = tree(spark, sf)
    return topology.path_sums_between(history.edge_counts(presence(spark, sf), t).drop("parent"), t["paths"], "ROOT", ["inherited"], depth=1)


@query("topology_count", "SELECT n::BIGINT AS n, list_product(list_transform(range(1, n), lambda i: (2 * i - 1)::DOUBLE))::BIGINT AS topologies FROM range(2, 7) t(n)")
def topology_count(spark, sf):
    """Enumerated trees of two to six leaves: (2n - 3)!! distinct ones."""
    rows = [(n, len({T.canonical(t) for t in T.enumerate_topologies([chr(97 + i) for i in range(n)])})) for n in range(2, 7)]
    return spark.createDataFrame(rows, "n long, topologies long")


@query("lowest_common", sql(*BASE, "SELECT feature, origin AS node FROM origin"))
def lowest_common(spark, sf):
    """Lowest common ancestors by relational division."""
    return history.origins(presence(spark, sf), tree(spark, sf)).select("feature", F.col("origin").alias("node"))


@query("topology_forms", f"WITH {_TOP} SELECT topology, max(form) FILTER (route = '') AS canonical, count(*) AS nodes FROM parts GROUP BY topology")
def topology_forms(spark, sf):
    """The canonical form of every topology, and its nodes."""
    rows = []
    for t, root in topologies(spark, sf):
        small = T.prune(root, {r for r in REGIONS if any(n.name == r for n in root.walk())})
        rows.append((t, T.canonical(small), sum(1 for _ in small.walk())))
    return spark.createDataFrame(rows, "topology string, canonical string, nodes long")


@query("unfiltered_origins", sql(PRESENCE.replace(f" WHERE l_quantity >= {LOT}", ""), WORLD, ORIGIN, "SELECT feature, n_tips, origin, depth::INTEGER AS depth FROM origin"))
def unfiltered_origins(spark, sf):
    """Origins of all parts, whatever the lots they were sold in."""
    return history.origins(presence(spark, sf, 0), tree(spark, sf)).select("feature", "n_tips", "origin", "depth")


@query("newick_renderings")
def newick_renderings(spark, sf):
    """Each topology as Newick, pruned to the regions, and its canonical form."""
    rows = []
    for t, root in topologies(spark, sf):
        small = T.prune(root, {r for r in REGIONS if any(n.name == r for n in root.walk())})
        rows.append((t, T.to_newick(root), T.to_newick(small, "structure"), T.canonical(small)))
    return spark.createDataFrame(rows, "topology string, newick string, structure string, canonical string")


# composition
def _members(spark, sf):
    """(group_key, tip, entity): parts sold in large lots, by supplier."""
    items = table(spark, sf, "lineitem").where(F.col("l_quantity") >= LOT).select(F.col("l_partkey").alias("group_key"), "l_suppkey")
    s, n = table(spark, sf, "supplier"), table(spark, sf, "nation")
    at = s.join(n, s["s_nationkey"] == n["n_nationkey"]).select("s_suppkey", F.col("n_name").alias("tip"))
    return items.join(at, items["l_suppkey"] == at["s_suppkey"]).select("group_key", "tip", F.col("s_suppkey").alias("entity"))


MEMBERS = f"mem AS (SELECT l_partkey AS group_key, n_name AS tip, s_suppkey AS entity FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey WHERE l_quantity >= {LOT})"


@query("clade_members", sql(MEMBERS, WORLD, "SELECT group_key, node, count(DISTINCT tip) AS tips, count(DISTINCT entity) AS entities FROM mem JOIN paths USING (tip) GROUP BY ALL"))
def clade_members(spark, sf):
    return composition.clade_members(_members(spark, sf), tree(spark, sf)["clades"])


@query("wide_clades", sql(MEMBERS, WORLD, "SELECT group_key, " + ", ".join(f"count(DISTINCT entity) FILTER (node = '{n}') AS \"{n}\"" for n in ["ROOT", *REGIONS]) + " FROM mem JOIN paths USING (tip) GROUP BY group_key"))
def wide_clades(spark, sf):
    return composition.wide_clades(composition.clade_members(_members(spark, sf), tree(spark, sf)["clades"]), ["ROOT", *REGIONS])


@query("member_map", sql(MEMBERS, "SELECT group_key, " + ", ".join(f"array_to_string(list_sort(list(DISTINCT entity) FILTER (tip = '{n}')), ',') AS {n}" for n in ("NATION_0", "NATION_1", "NATION_2")) + " FROM mem WHERE tip IN ('NATION_0', 'NATION_1', 'NATION_2') GROUP BY group_key"))
def member_map(spark, sf):
    tips = ["NATION_0", "NATION_1", "NATION_2"]
    return composition.member_map(_members(spark, sf).where(F.col("tip").isin(tips)), tips)


OCC = "occ AS (SELECT feature, " + ", ".join(f"bool_or(grp = '{g}') AS g{i}" for i, g in enumerate(REGIONS)) + ", bool_or(grp NOT IN ('ASIA', 'EUROPE', 'AFRICA')) AS outside FROM pres JOIN geo USING (tip) GROUP BY feature)"
INNER = ["AFRICA", "ASIA", "EUROPE"]


def _occupied(spark, sf):
    return composition.occupancy(presence(spark, sf).withColumnRenamed("feature", "group_key"), tip_groups(spark, sf), INNER)


@query("composite_clades", sql(PRESENCE, WORLD, OCC, """SELECT composite, feature AS group_key FROM (SELECT feature, unnest(list_filter([CASE WHEN g0 AND NOT g2 AND NOT g3 AND NOT outside THEN 'africa_only' END,
  CASE WHEN NOT g2 AND NOT outside THEN 'no_asia' END, CASE WHEN (g0 OR outside) AND (g2 OR g3) THEN 'urclade' END, CASE WHEN g0::INT + g2::INT >= 2 THEN 'early' END], lambda x: x IS NOT NULL)) AS composite FROM occ)"""))  # fmt: skip
def composite_clades(spark, sf):
    rule = composition.composite_rule
    return composition.composite_table(_occupied(spark, sf), {
        "africa_only": rule("exact", INNER, ["AFRICA"]), "no_asia": rule("absent", INNER, ["ASIA", "outside"]), "urclade": rule("core_urclade", INNER, ["AFRICA"]), "early": rule("core_early_clade", INNER, ["AFRICA", "ASIA"]),
    })


@query("clade_signature", sql(PRESENCE, WORLD, OCC, """s AS (SELECT feature, outside, array_to_string(list_filter([CASE WHEN g0 THEN 'AFRICA' END, CASE WHEN g2 THEN 'ASIA' END, CASE WHEN g3 THEN 'EUROPE' END], lambda x: x IS NOT NULL), '+') AS signature FROM occ)""",
  """SELECT feature AS group_key, signature, CASE WHEN outside THEN base || '_With_Outside' ELSE base END AS named FROM (SELECT *, CASE signature WHEN 'AFRICA' THEN 'South' WHEN 'ASIA+EUROPE' THEN 'Eurasian' WHEN 'AFRICA+ASIA+EUROPE' THEN 'Old_World' END AS base FROM s)"""))  # fmt: skip
def clade_signature(spark, sf):
    return composition.signature(_occupied(spark, sf), INNER, {"AFRICA": "South", "ASIA+EUROPE": "Eurasian", "AFRICA+ASIA+EUROPE": "Old_World"})


@query("composition_class", sql(PRESENCE, WORLD, """SELECT feature AS group_key, a AS inner_tips, b AS outer_tips, CASE WHEN a > 0 AND b > 0 THEN 'mixed' WHEN a > 0 THEN 'inner_only' WHEN b > 0 THEN 'outer_only' ELSE 'none' END AS cls
  FROM (SELECT feature, count(*) FILTER (grp = 'ASIA') AS a, count(*) FILTER (grp IN ('EUROPE', 'AFRICA')) AS b FROM pres JOIN geo USING (tip) GROUP BY feature)"""))  # fmt: skip
def composition_class(spark, sf):
    rows = presence(spark, sf).join(tip_groups(spark, sf), "tip").groupBy(F.col("feature").alias("group_key"))
    count = lambda *g: F.sum(F.col("grp").isin(*g).cast("long"))
    rows = rows.agg(count("ASIA").alias("inner_tips"), count("EUROPE", "AFRICA").alias("outer_tips"))
    return rows.select("group_key", "inner_tips", "outer_tips", composition.class_of(F.col("inner_tips"), F.col("outer_tips")).alias("cls"))


@query("cross_table", """SELECT l_partkey AS group_a, count(DISTINCT l_suppkey) AS n, count(DISTINCT l_suppkey) FILTER (s_acctbal >= 5000) AS rich, count(DISTINCT l_suppkey) FILTER (s_acctbal < 5000) AS poor,
  array_to_string(list_transform(list_sort(list(DISTINCT l_suppkey::VARCHAR)), lambda x: x), ',') AS groups_b FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_quantity >= 45 GROUP BY l_partkey""")  # fmt: skip
def cross_table(spark, sf):
    items = table(spark, sf, "lineitem").where(F.col("l_quantity") >= LOT)
    a = items.select(F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("entity"), F.col("l_partkey").alias("group_a"), "l_suppkey")
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.when(F.col("s_acctbal") >= 5000, "rich").otherwise("poor").alias("cls"))
    b = a.join(s, "l_suppkey").select("entity", F.col("l_suppkey").cast("string").alias("group_b"), "cls").distinct()
    return composition.cross_table(a.select("entity", "group_a"), b, ["rich", "poor"])


@query("qualifying_groups", "SELECT DISTINCT l_partkey AS group_key FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE s_acctbal < 0")
def qualifying_groups(spark, sf):
    members = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("group_key"), F.col("l_suppkey").alias("entity"))
    classes = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("entity"), F.when(F.col("s_acctbal") < 0, "debtor").otherwise("other").alias("cls"))
    return composition.qualifying(members, classes, "debtor")
