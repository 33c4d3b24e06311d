"""The driver's tables as the operators' inputs: nations are tips, regions clades, parts features."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arbora.operators import trees as T

Query = Callable[[SparkSession, str], DataFrame]

#: Features are parts sold in large lots: presence of a part in a nation.
LOT = 45


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def world_tree(spark: SparkSession, sf_dir: str) -> T.Node:
    """ROOT over regions over nations, by name."""
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    rows = n.join(r, n["n_regionkey"] == r["r_regionkey"]).select("r_name", "n_name").limit(T.MOST_NODES + 1).collect()
    if len(rows) > T.MOST_NODES:
        raise T.TreeError("too many nodes for a tree")
    by: dict[str, list[str]] = {}
    for region, nation in rows:
        by.setdefault(region, []).append(nation)
    return T.Node("ROOT", [T.Node(x, [T.Node(y) for y in sorted(ys)]) for x, ys in sorted(by.items())])


def tree(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return T.tables(spark, [("001", world_tree(spark, sf_dir))])


def topologies(spark: SparkSession, sf_dir: str, most: int | None = None) -> list[tuple[str, T.Node]]:
    """All rooted binary arrangements of the regions, the nations grafted under each."""
    root = world_tree(spark, sf_dir)
    regions = {c.name: c for c in root.children}
    comb = T.Node(sorted(regions)[0])
    for name in sorted(regions)[1:]:
        comb = T.Node("", [comb, T.Node(name)])
    found = T.numbered_topologies(comb)[:most]
    T.name_inner(found)
    return [(t, T.graft(n, regions)) for t, n in found]


def presence(spark: SparkSession, sf_dir: str, lot: int = LOT) -> DataFrame:
    """(feature, tip), distinct."""
    items = table(spark, sf_dir, "lineitem").where(F.col("l_quantity") >= lot).select("l_partkey", "l_suppkey")
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    at = s.join(n, s["s_nationkey"] == n["n_nationkey"]).select("s_suppkey", "n_name")
    rows = items.join(at, items["l_suppkey"] == at["s_suppkey"])
    return rows.select(F.col("l_partkey").alias("feature"), F.col("n_name").alias("tip")).distinct()


def tip_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tip, grp): nations and their regions."""
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return n.join(r, n["n_regionkey"] == r["r_regionkey"]).select(F.col("n_name").alias("tip"), F.col("r_name").alias("grp"))


REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]

#: Oracle: the same inputs as common table expressions.
PRESENCE = f"""pres AS (SELECT DISTINCT l_partkey AS feature, n_name AS tip FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey WHERE l_quantity >= {LOT})"""
WORLD = """geo AS (SELECT n_name AS tip, r_name AS grp FROM nation JOIN region ON n_regionkey = r_regionkey),
paths AS (SELECT tip, 0 AS depth, 'ROOT' AS node FROM geo UNION ALL SELECT tip, 1, grp FROM geo UNION ALL SELECT tip, 2, tip FROM geo),
edges AS (SELECT 'OOL' AS parent, 'ROOT' AS child UNION ALL SELECT DISTINCT 'ROOT', grp FROM geo UNION ALL SELECT grp, tip FROM geo)"""
ORIGIN = """shared AS (SELECT feature, node, depth, count(*) AS k FROM pres JOIN paths USING (tip) GROUP BY ALL),
sizes AS (SELECT feature, count(*) AS n FROM pres GROUP BY feature),
origin AS (SELECT feature, max(n) AS n_tips, arg_max(node, depth) AS origin, max(depth) AS depth FROM shared JOIN sizes USING (feature) WHERE k = n GROUP BY feature)"""
HELD = """held AS (SELECT DISTINCT feature, node, p.depth FROM pres JOIN paths p USING (tip) JOIN origin o USING (feature) WHERE p.depth >= o.depth),
under AS (SELECT DISTINCT a.node AS ancestor, e.parent, e.child FROM paths a JOIN paths b ON a.tip = b.tip AND a.depth <= b.depth JOIN edges e ON e.parent = b.node),
states AS (SELECT o.feature, u.parent, u.child, CASE WHEN h.node IS NOT NULL AND c.node IS NOT NULL THEN 'P' WHEN h.node IS NOT NULL THEN 'L' ELSE 'X' END AS state
  FROM origin o JOIN under u ON u.ancestor = o.origin LEFT JOIN held h ON h.feature = o.feature AND h.node = u.parent LEFT JOIN held c ON c.feature = o.feature AND c.node = u.child
  UNION ALL SELECT feature, parent, child, 'O' FROM origin JOIN edges ON child = origin),
counts AS (SELECT e.parent, e.child, count(h.feature) AS inherited, count(c.feature) AS conserved FROM edges e LEFT JOIN held h ON h.node = e.parent
  LEFT JOIN held c ON c.node = e.child AND c.feature = h.feature GROUP BY ALL)"""


def sql(*parts: str) -> str:
    """WITH all but the last part, then the last."""
    return "WITH " + ",\n".join(parts[:-1]) + "\n" + parts[-1]
