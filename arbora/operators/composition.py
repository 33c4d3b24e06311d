"""Which clades a group occupies: member counts by clade, composite-clade rules, classes and signatures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NON_ANIMAL, MIXED, OUTER, NONE = "non_target", "mixed", "outer_only", "inner_only"


def clade_members(members: DataFrame, clades: DataFrame) -> DataFrame:
    """(group_key, node, tips, entities): distinct tips and member entities of each group below each node.

    members: (group_key, tip, entity).  clades: (node, tip), each node once however many topologies share it.
    """
    once = clades.select("node", "tip").distinct()
    by_tip = members.groupBy("group_key", "tip").agg(F.count_distinct("entity").alias("n"))
    return by_tip.join(once, "tip").groupBy("group_key", "node").agg(F.count(F.lit(1)).alias("tips"), F.sum("n").alias("entities"))


def wide_clades(counts: DataFrame, nodes: list[str], value: str = "entities") -> DataFrame:
    """A column a node, in the given order; nodes without members are 0."""
    return counts.groupBy("group_key").pivot("node", nodes).agg(F.first(value)).fillna(0, nodes)


def member_map(members: DataFrame, tips: list[str]) -> DataFrame:
    """A column a tip with the group's entities there, sorted and comma-joined."""
    cell = members.groupBy("group_key", "tip").agg(F.array_join(F.array_sort(F.collect_set("entity")), ",").alias("ids"))
    return cell.groupBy("group_key").pivot("tip", tips).agg(F.first("ids"))


def occupancy(members: DataFrame, tip_groups: DataFrame, groups: list[str]) -> DataFrame:
    """(group_key, outside, has): which of ``groups`` (a map by name) the group is in, and if it is elsewhere."""
    rows = members.select("group_key", "tip").distinct().join(tip_groups, "tip", "left")
    flags = F.map_from_arrays(F.array(*map(F.lit, groups)), F.array(*[F.max(F.coalesce(F.col("grp") == g, F.lit(False))) for g in groups]))
    outside = F.max(~F.coalesce(F.col("grp").isin(groups), F.lit(False)))
    return rows.groupBy("group_key").agg(outside.alias("outside"), flags.alias("has"))


def composite_rule(algorithm: str, groups: list[str], chosen: list[str], target: str | None = None, ingroup: list[str] | None = None) -> Column:
    """Predicate over occupancy() columns.

    exact: in all chosen groups and no other.  absent: in none of the chosen (nor outside, where "outside" is chosen).
    core_urclade: in a chosen early group or outside the target, and in some other ingroup.  core_early_clade: in two
    ingroups or more.
    """
    has = lambda g: F.coalesce(F.element_at("has", g), F.lit(False))
    any_of = lambda gs: reduce(lambda a, b: a | b, [has(g) for g in gs], F.lit(False))
    inner = ingroup if ingroup is not None else [g for g in groups if g not in chosen]
    if algorithm == "exact":
        wanted = reduce(lambda a, b: a & b, [has(g) if g in chosen else ~has(g) for g in groups])
        return wanted & (F.col("outside") if "outside" in chosen else ~F.col("outside"))
    if algorithm == "absent":
        out = ~any_of([g for g in chosen if g != "outside"])
        return out & ~F.col("outside") if "outside" in chosen else out
    if algorithm == "core_urclade":
        return (any_of(chosen) | F.col("outside")) & any_of(inner)
    if algorithm == "core_early_clade":
        return reduce(lambda a, b: a + b, [has(g).cast("int") for g in groups if g in chosen]) >= 2
    raise ValueError(f"no algorithm {algorithm}")


def composite_table(occupied: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(composite, group_key) of all rules, in one pass over the groups."""
    hit = F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()])
    return occupied.select("group_key", F.explode(F.array_compact(hit)).alias("composite")).select("composite", "group_key")


def class_of(inner: Column, outer: Column, names: tuple[str, str, str, str] = ("inner_only", "mixed", "outer_only", "none")) -> Column:
    """Four classes from the counts of members inside the inner clade, and inside the outer one only; else none."""
    return F.when((inner > 0) & (outer > 0), names[1]).when(inner > 0, names[0]).when(outer > 0, names[2]).otherwise(names[3])


def signature(occupied: DataFrame, order: list[str], names: dict[str, str] | None = None, suffix: str = "_With_Outside") -> DataFrame:
    """(group_key, signature, named): occupied groups in a fixed order, joined by +, and the class so named, if any."""
    sig = F.array_join(F.filter(F.array(*map(F.lit, order)), lambda g: F.coalesce(F.element_at("has", g), F.lit(False))), "+")
    out = occupied.select("group_key", "outside", sig.alias("signature"))
    if names is None:
        return out.select("group_key", "signature", F.when(F.col("outside"), F.concat("signature", F.lit(suffix))).otherwise(F.col("signature")).alias("named"))
    table = F.create_map(*[x for k, v in names.items() for x in (F.lit(k), F.lit(v))])
    base = F.try_element_at(table, "signature")
    return out.select("group_key", "signature", F.when(F.col("outside"), F.concat(base, F.lit(suffix))).otherwise(base).alias("named"))


def qualifying(members: DataFrame, classes: DataFrame, wanted: str) -> DataFrame:
    """Groups with a member of the wanted class; members: (group_key, entity), classes: (entity, cls)."""
    return members.join(classes.where(F.col("cls") == wanted), "entity", "left_semi").select("group_key").distinct()


def cross_table(a: DataFrame, b: DataFrame, classes: list[str]) -> DataFrame:
    """(group_a, n, <class>..., groups_b): per group of ``a`` its groups of ``b`` counted by class, and listed.

    a: (entity, group_a).  b: (entity, group_b, cls)."""
    pairs = a.join(b, "entity").select("group_a", "group_b", "cls").distinct()
    each = [F.sum((F.col("cls") == c).cast("long")).alias(c) for c in classes]
    return pairs.groupBy("group_a").agg(F.count_distinct("group_b").alias("n"), *each, F.array_join(F.array_sort(F.collect_set("group_b")), ",").alias("groups_b"))
