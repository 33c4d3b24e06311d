"""Row filters from JSON manifests, compiled to one Column so that Catalyst can push them down.

A manifest has filters, all of which must hold; a filter combines clauses by all, any or at_least_k.  A missing value
(null, "", "None", "NA", "-") fails a numeric comparison, contains and in_set, but holds for not_contains and, as
texts are compared, for not_equals; equals to the text "None" matches a missing value.  A clause on a column that does
not exist is false.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPERATORS = (
    "equals", "not_equals", "less_than", "less_or_equal", "greater_than", "greater_or_equal",
    "contains", "not_contains", "in_set", "contains_any", "contains_all", "between",
)
MISSING = ("", "None", "NA", "-")


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def clause(column: str, operator: str, columns: list[str], value=None, values: list | None = None, value_upper=None) -> Column:
    if operator not in OPERATORS:
        raise ValueError(f"no operator {operator}")
    if column not in columns:
        return F.lit(False)
    text = _text(f"`{column}`")
    gone = text.isNull() | text.isin(*MISSING)
    sure = lambda c: F.coalesce(c, F.lit(False))
    if operator in ("equals", "not_equals"):
        same = sure(F.coalesce(text, F.lit("None")) == F.lit(str(value)))
        return same if operator == "equals" else ~same
    if operator == "in_set":
        return ~gone & sure(text.isin(*[str(v) for v in values or []]))
    if operator in ("contains", "not_contains"):
        has = ~gone & sure(F.contains(text, F.lit(str(value))))
        return has if operator == "contains" else ~has
    if operator in ("contains_any", "contains_all"):
        each = [sure(F.contains(text, F.lit(str(v)))) for v in values or []]
        start = F.lit(operator == "contains_all")
        return ~gone & reduce((lambda a, b: a | b) if operator == "contains_any" else (lambda a, b: a & b), each, start)
    number = F.when(~gone, text.try_cast("double"))
    if operator == "between":
        return sure((number >= float(value)) & (number <= float(value_upper)))
    compare = {"less_than": number < float(value), "less_or_equal": number <= float(value), "greater_than": number > float(value), "greater_or_equal": number >= float(value)}
    return sure(compare[operator])


def combine(clauses: list[Column], how: str, k: int | None = None) -> Column:
    if not clauses:
        raise ValueError("a filter needs a clause")
    if how == "all":
        return reduce(lambda a, b: a & b, clauses)
    if how == "any":
        return reduce(lambda a, b: a | b, clauses)
    if how == "at_least_k":
        if not k or k < 1:
            raise ValueError("at_least_k needs k")
        return reduce(lambda a, b: a + b, [c.cast("int") for c in clauses]) >= k
    raise ValueError(f"no way to combine: {how}")


def compile_manifest(manifest: str | dict, columns: list[str]) -> dict[str, Column]:
    """A predicate a filter, by feature name, in order."""
    spec = json.loads(manifest) if isinstance(manifest, str) else manifest
    out: dict[str, Column] = {}
    for i, f in enumerate(spec["filters"]):
        parts = [clause(c["column"], c["operator"], columns, c.get("value"), c.get("values"), c.get("value_upper")) for c in f["clauses"]]
        out[f.get("feature", f"filter_{i + 1}")] = combine(parts, f.get("combine_clauses", "all"), f.get("k"))
    return out


def apply_manifest(df: DataFrame, manifest: str | dict) -> DataFrame:
    return df.where(reduce(lambda a, b: a & b, compile_manifest(manifest, df.columns).values()))


def pass_counts(df: DataFrame, manifest: str | dict) -> DataFrame:
    """(filter, passed, of): rows that pass each filter and all of them, in one scan."""
    parts = compile_manifest(manifest, df.columns)
    every = parts | {"all": reduce(lambda a, b: a & b, parts.values())}
    sums = df.agg(*[F.coalesce(F.sum(c.cast("long")), F.lit(0)).alias(n) for n, c in every.items()], F.count(F.lit(1)).alias("_of"))
    return sums.select(F.explode(F.array(*[F.struct(F.lit(n).alias("filter"), F.col(f"`{n}`").alias("passed"), F.col("_of").alias("of")) for n in every])).alias("x")).select("x.*")
