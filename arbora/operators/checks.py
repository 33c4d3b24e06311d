"""Relational assertions: each gives (check, violations); ``require`` raises if any has one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arbora.operators import history


class CheckFailed(AssertionError):
    pass


def violations(name: str, bad: DataFrame) -> DataFrame:
    return bad.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check"), "violations")


def report(*parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def require(checks: DataFrame) -> None:
    bad = [f"{r['check']}: {r['violations']}" for r in checks.where("violations > 0").collect()]
    if bad:
        raise CheckFailed("; ".join(bad))


def history_checks(presence: DataFrame, tree: dict[str, DataFrame]) -> DataFrame:
    """The invariants of origins, states and counts."""
    found = history.origins(presence, tree)
    edges = history.edge_counts(presence, tree)
    states = history.edge_states(presence, tree)
    strings = history.path_states(presence, tree)
    tip_depth = tree["paths"].groupBy("topology", "tip").agg(F.count(F.lit(1)).alias("nodes"))
    on_path = presence.join(tree["paths"], "tip").select("topology", "feature", "tip", F.col("node").alias("origin")).join(found.select("topology", "feature", "origin"), ["topology", "feature", "origin"])
    expected = presence.join(tree["nodes"].where("is_tip").select("topology", F.col("node").alias("tip")), "tip")
    by_state = states.groupBy("topology").agg(*[F.sum((F.col("state") == s).cast("long")).alias(s) for s in "PL"])
    sums = edges.groupBy("topology").agg(F.sum("conserved").alias("kept"), F.sum("lost").alias("gone"))
    member = presence.select("feature", "tip", F.lit(True).alias("_in"))
    ends = strings.join(member, ["feature", "tip"], "left").withColumn("_last", F.right("path_state", F.lit(1)))
    per = states.where("state <> 'O'").groupBy("topology", "feature").agg(F.count(F.lit(1)).alias("n"))
    eligible = found.select("topology", "feature", F.col("origin").alias("ancestor")).join(history.descendant_edges(tree), ["topology", "ancestor"]).groupBy("topology", "feature").agg(F.count(F.lit(1)).alias("m"))
    return report(
        violations("inherited is conserved and lost", edges.where("inherited <> conserved + lost or conserved > inherited")),
        violations("edge sums equal state sums", by_state.join(sums, "topology").where("P <> kept or L <> gone")),
        violations("each feature in the tree has one origin", expected.select("topology", "feature").distinct().join(found, ["topology", "feature"], "left_anti")),
        violations("the origin is on every member's path", expected.join(on_path, ["topology", "feature", "tip"], "left_anti")),
        violations("P, L and X cover the origin's clade", eligible.join(per, ["topology", "feature"], "left").where("coalesce(n, 0) <> m")),
        violations("path states follow A*(O P* (L X*)?)?", strings.where("not path_state rlike '^A*(OP*(LX*)?)?$'")),
        violations("path states are as long as paths", strings.join(tip_depth, ["topology", "tip"]).where("length(path_state) <> nodes")),
        violations("a path ends in P or O where the tip is a member", ends.where("coalesce(_in, false) <> (_last in ('P', 'O'))")),
    )


def unique_key(df: DataFrame, *key: str) -> DataFrame:
    return violations(f"unique {', '.join(key)}", df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"))


def references(df: DataFrame, other: DataFrame, *key: str) -> DataFrame:
    return violations(f"{', '.join(key)} resolves", df.join(other.select(*key).distinct(), list(key), "left_anti"))


def partition(whole: DataFrame, key: str, parts: dict[str, DataFrame]) -> DataFrame:
    """The parts are disjoint and cover the whole."""
    rows = reduce(lambda a, b: a.unionByName(b), [p.select(key).distinct() for p in parts.values()])
    twice = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return report(violations("parts are disjoint", twice), violations("parts cover the whole", whole.select(key).distinct().join(rows, key, "left_anti")), violations("parts lie in the whole", rows.join(whole.select(key), key, "left_anti")))
