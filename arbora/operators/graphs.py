"""Connected components of undirected graphs by hooking and shortcutting, staged each round, and transitive closure."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from arbora.operators.skew import discard, lookup, stage, stage_root

__all__ = ["closure_sql", "components", "stage", "stage_root"]


def components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 100) -> DataFrame:
    """(node, comp): each node of an edge and the smallest node of its component.

    Every node points to a node not larger than itself.  In a round a node's least neighbouring grandparent becomes
    its own parent and that of its parent (hooking), and grandparents become parents (shortcutting), so that chains of
    any order take logarithmically many rounds.
    """
    one = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x is not null and y is not null")
    both = stage(one.unionByName(one.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "edges")
    seen = Observation()
    labels = both.groupBy(F.col("x").alias("node")).agg(F.least(F.min("x"), F.min("y")).alias("comp"))
    labels = stage(labels.observe(seen, F.count(F.lit(1)).alias("n")), "labels")
    n, before = seen.get.get("n", 0), labels
    for _ in range(most_rounds if n else 0):
        up = labels.select(F.col("node").alias("comp"), F.col("comp").alias("grand"))
        known = stage(lookup(labels, up, "comp", n).select("node", "comp", "grand"), "grandparents")
        near = both.join(known.select(F.col("node").alias("y"), "grand"), "y").groupBy(F.col("x").alias("node")).agg(F.min("grand").alias("near"))
        best = known.join(near, "node").select("node", "comp", F.least("comp", "grand", "near").alias("best"))
        hints = F.explode(F.array(F.struct("node", "best", F.col("comp").alias("was")), F.struct(F.col("comp").alias("node"), "best", F.lit(None).cast(labels.schema["comp"].dataType).alias("was"))))
        labels = best.select(hints.alias("h")).groupBy(F.col("h.node").alias("node")).agg(F.max("h.was").alias("was"), F.min("h.best").alias("comp"))
        seen = Observation()  # counted while the round is written
        old, labels = before, stage(labels.observe(seen, F.count(F.when(F.col("was") != F.col("comp"), 1)).alias("changed")), "labels")
        before = labels
        discard(known, old)
        if not seen.get.get("changed"):
            discard(both)
            return labels.select("node", "comp")
        labels = labels.select("node", "comp")
    if n:
        raise RuntimeError("components did not settle")
    return labels


def closure_sql(edges_view: str) -> str:
    """SQL of the transitive closure (ancestor, descendant, distance), distance 0 included, of view (parent, child)."""
    return f"""
    WITH RECURSIVE c(ancestor, descendant, distance) AS (
      SELECT n, n, 0 FROM (SELECT parent AS n FROM {edges_view} UNION SELECT child FROM {edges_view})
      UNION ALL
      SELECT c.ancestor, e.child, c.distance + 1 FROM c JOIN {edges_view} e ON e.parent = c.descendant)
    SELECT * FROM c"""
