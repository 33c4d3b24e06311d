"""Questions to many topologies at once, as joins on their edge tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arbora.functions.keys import bare_name


def select_topologies(edges: DataFrame, direct_child: list[tuple[str, str]] = (), sister: list[tuple[str, str]] = ()) -> DataFrame:
    """Topologies where every (parent, child) is an edge and every pair of sisters shares a parent; bare names count."""
    e = edges.select("topology", bare_name(F.col("parent")).alias("parent"), bare_name(F.col("child")).alias("child"))
    parts = [e.where((F.col("parent") == p) & (F.col("child") == c)).select("topology").distinct() for p, c in direct_child]
    for a, b in sister:
        x, y = e.where(F.col("child") == a), e.where(F.col("child") == b)
        parts.append(x.join(y.select("topology", "parent"), ["topology", "parent"]).select("topology").distinct())
    every = e.select("topology").distinct()
    return reduce(lambda a, b: a.join(b, "topology", "left_semi"), parts, every)


def representative(edges: DataFrame, candidates: DataFrame, reference: str) -> DataFrame:
    """(topology, shared): the candidate with most bare-name edges in common with the reference; ties go to the lowest id."""
    e = edges.select("topology", bare_name(F.col("parent")).alias("parent"), bare_name(F.col("child")).alias("child"))
    wanted = e.where(F.col("topology") == reference).select("parent", "child")
    shared = e.join(candidates, "topology", "left_semi").join(wanted.withColumn("_in", F.lit(1)), ["parent", "child"], "left").groupBy("topology").agg(F.count("_in").alias("shared"))
    rank = F.row_number().over(Window.orderBy(F.desc("shared"), "topology"))
    return shared.withColumn("_k", rank).where("_k = 1").drop("_k")


def path_sums(edge_values: DataFrame, paths: DataFrame, columns: list[str]) -> DataFrame:
    """Per tip: sums over the edges of its path; edge_values: (topology, child, columns...)."""
    on = paths.join(edge_values.withColumnRenamed("child", "node"), ["topology", "node"])
    return on.groupBy("topology", "tip").agg(*[F.sum(c).alias(c) for c in columns])


def path_sums_between(edge_values: DataFrame, paths: DataFrame, top: str, columns: list[str], depth: int | None = None) -> DataFrame:
    """Per tip below ``top``: sums over the first ``depth`` edges (all if None) of the way down from it."""
    start = paths.where(F.col("node") == top).select("topology", "tip", F.col("depth").alias("_d"))
    on = paths.join(start, ["topology", "tip"]).where("depth > _d")
    if depth is not None:
        on = on.where(F.col("depth") <= F.col("_d") + depth)
    on = on.join(edge_values.withColumnRenamed("child", "node"), ["topology", "node"])
    return on.groupBy("topology", "tip").agg(F.count(F.lit(1)).alias("edges"), *[F.sum(c).alias(c) for c in columns])


def clade_table(tree: dict[str, DataFrame]) -> DataFrame:
    """Per node: strict descendants (tips list none): how many tips, and which."""
    below = tree["clades"].where("node <> tip").groupBy("topology", "node").agg(F.count(F.lit(1)).alias("tips"), F.array_join(F.array_sort(F.collect_list("tip")), ",").alias("tip_list"))
    out = tree["nodes"].select("topology", "parent", "node").join(below, ["topology", "node"], "left")
    return out.select("topology", "parent", "node", F.coalesce("tips", F.lit(0)).alias("tips"), F.coalesce("tip_list", F.lit("")).alias("tip_list"))


def root_paths(tree: dict[str, DataFrame]) -> DataFrame:
    """(topology, tip, path): the nodes from the root, joined by >."""
    return tree["paths"].groupBy("topology", "tip").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("depth", "node"))), lambda x: x["node"]), ">").alias("path"))
