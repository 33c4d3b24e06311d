"""Groups of entities that share annotation: by one code, by their set of codes, by their sequence, or by having none.

annotations: (entity, code, start, stop, ordinal, positional).  Codes without coordinates (positional false) take no
part in sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arbora.operators.skew import numbered_rows

POSITIONAL = ("entity", "code", "start", "stop", "ordinal", "positional", "definition", "category")
Adapter = Callable[..., DataFrame]
_ADAPTERS: dict[str, tuple[Adapter, bool]] = {}


def adapter(name: str, positional: bool) -> Callable[[Adapter], Adapter]:
    """Registers a reader that returns the annotations of one source."""

    def register(fn: Adapter) -> Adapter:
        if name in _ADAPTERS:
            raise ValueError(f"adapter {name} is registered")
        _ADAPTERS[name] = (fn, positional)
        return fn

    return register


def adapters() -> dict[str, bool]:
    """Registered sources, and whether their codes have coordinates."""
    return {k: p for k, (_, p) in sorted(_ADAPTERS.items())}


def annotations_of(name: str, *args, **kwargs) -> DataFrame:
    fn, positional = _ADAPTERS[name]
    got = fn(*args, **kwargs)
    for column, value in (("positional", F.lit(positional)), ("ordinal", F.lit(0)), ("start", F.lit(None).cast("long")), ("stop", F.lit(None).cast("long")), ("definition", F.lit(None).cast("string")), ("category", F.lit(None).cast("string"))):
        if column not in got.columns:
            got = got.withColumn(column, value)
    return got.select(*POSITIONAL)


def domain_adapter(name: str) -> Adapter:
    """A source of the long annotation table whose rows are domain hits."""

    @adapter(name, True)
    def read(facts: DataFrame, database: str = name) -> DataFrame:
        rows = facts.where(F.lower("database") == database)
        return rows.select("entity", F.col("accession").alias("code"), "start", "stop", F.col("details").alias("definition"))

    return read


def _intervals_cell(rows: DataFrame, cell: str) -> DataFrame:
    """A row an interval of a ``s-e,s-e`` cell."""
    parts = F.filter(F.split(F.col(cell), ","), lambda x: x.rlike(r"^\s*\d+\s*-\s*\d+\s*$"))
    rows = rows.withColumn("_part", F.explode(parts))
    return rows.withColumns({"start": F.trim(F.split_part("_part", F.lit("-"), F.lit(1))).cast("long"), "stop": F.trim(F.split_part("_part", F.lit("-"), F.lit(2))).cast("long")}).drop("_part")


@adapter("tmbed", True)
def _membrane(rows: DataFrame, code: str = "tm_helix", cell: str = "helices") -> DataFrame:
    return _intervals_cell(rows, cell).select("entity", F.lit(code).alias("code"), "start", "stop")


@adapter("metapredict", True)
def _disorder(rows: DataFrame, code: str = "disordered_region", cell: str = "regions") -> DataFrame:
    return _intervals_cell(rows, cell).select("entity", F.lit(code).alias("code"), "start", "stop")


@adapter("deeploc", False)
def _localisation(rows: DataFrame, cell: str = "localizations") -> DataFrame:
    """Multi-label cells split at bars; spaces become underscores."""
    code = F.explode(F.filter(F.transform(F.split(F.col(cell), r"\|"), lambda x: F.translate(F.trim(x), " ", "_")), lambda x: x != ""))
    return rows.select("entity", code.alias("code"))


@adapter("signalp", False)
def _signal(rows: DataFrame, cell: str = "prediction", absent: str = "OTHER") -> DataFrame:
    return rows.where(F.col(cell).isNotNull() & (F.col(cell) != absent)).select("entity", F.concat(F.lit("signal_"), F.col(cell)).alias("code"))


@adapter("go", False)
def _ontology(rows: DataFrame, cell: str = "terms", allowed: tuple[str, ...] | None = None, terms: DataFrame | None = None) -> DataFrame:
    """Terms ``GO:1(ORIGIN)|GO:2``: the origin is stripped, and filters if ``allowed``; names and namespaces from ``terms``."""
    rows = rows.select("entity", F.explode(F.split(F.col(cell), r"\|")).alias("t"))
    rows = rows.select("entity", F.regexp_extract("t", r"^\s*([^(\s]+)", 1).alias("code"), F.regexp_extract("t", r"\(([^)]*)\)", 1).alias("origin")).where("code != ''")
    if allowed is not None:
        rows = rows.where(F.col("origin").isin(list(allowed)))
    rows = rows.select("entity", "code").distinct()
    if terms is None:
        return rows
    return rows.join(terms.select(F.col("go_id").alias("code"), F.col("go_name").alias("definition"), F.col("go_namespace").alias("category")), "code", "left")


for _name in ("cdd", "funfam", "gene3d", "panther", "pfam", "smart", "superfamily"):
    domain_adapter(_name)


def universe(*sources: DataFrame) -> DataFrame:
    """Distinct entities of all sources."""
    out = sources[0].select("entity")
    for s in sources[1:]:
        out = out.union(s.select("entity"))
    return out.where("entity is not null").distinct()


def by_code(annotations: DataFrame) -> DataFrame:
    """(group_key, entity): one group a code; an entity may be in several."""
    return annotations.select(F.col("code").alias("group_key"), "entity").distinct()


def by_set(annotations: DataFrame) -> DataFrame:
    """(group_key, entity): the sorted distinct codes, comma-joined, as key; each annotated entity is in one group."""
    return annotations.groupBy("entity").agg(F.array_join(F.array_sort(F.collect_set("code")), ",").alias("group_key")).select("group_key", "entity")


def by_sequence(annotations: DataFrame, *order: str) -> DataFrame:
    """(group_key, entity): positional codes in order, repeats kept."""
    order = order or ("start", "stop", "ordinal", "code")
    rows = annotations.where("positional") if "positional" in annotations.columns else annotations
    seq = F.transform(F.array_sort(F.collect_list(F.struct(*order, F.col("code").alias("_code")))), lambda x: x["_code"])
    return rows.groupBy("entity").agg(F.array_join(seq, ",").alias("group_key")).select("group_key", "entity")


def by_absence(entities: DataFrame, annotations: DataFrame) -> DataFrame:
    """(group_key "absent", entity): entities of the universe without annotation."""
    return entities.join(annotations.select("entity").distinct(), "entity", "left_anti").select(F.lit("absent").alias("group_key"), "entity")


def orphans(annotations: DataFrame, entities: DataFrame) -> DataFrame:
    """Annotated entities that the universe lacks, with their rows."""
    return annotations.join(entities.select("entity").distinct(), "entity", "left_anti").groupBy("entity").agg(F.count(F.lit(1)).alias("rows"))


def numbered(groups: DataFrame, prefix: str, width: int = 5) -> DataFrame:
    """(group_id, group_key, n): the distinct keys numbered in order."""
    keys = numbered_rows(groups.groupBy("group_key").agg(F.count(F.lit(1)).alias("n")), "k", "group_key")
    return keys.select(F.concat(F.lit(prefix), F.lpad((F.col("k") + 1).cast("string"), width, "0")).alias("group_id"), "group_key", "n")


def definitions() -> Column:
    """Aggregate: ``definition ==code; ...`` of a group's rows, each once, sorted."""
    text = F.concat(F.coalesce("definition", F.lit("")), F.lit(" =="), F.col("code"))
    return F.array_join(F.array_distinct(F.array_sort(F.collect_list(F.when(F.col("definition").isNotNull(), text)))), "; ")


def tagged_sequence(annotations: DataFrame) -> DataFrame:
    """(entity, sequence) with coordinates: code_start1_stop9,..."""
    tag = F.concat(F.col("code"), F.lit("_start"), F.col("start"), F.lit("_stop"), F.col("stop"))
    return annotations.where("positional").groupBy("entity").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "stop", "ordinal", tag.alias("t")))), lambda x: x["t"]), ",").alias("sequence"))


def memberships(annotations: DataFrame, entities: DataFrame) -> DataFrame:
    """(kind, group_key, entity) of all four kinds."""
    parts = {"code": by_code(annotations), "set": by_set(annotations), "sequence": by_sequence(annotations), "absent": by_absence(entities, annotations)}
    out = None
    for kind, part in parts.items():
        part = part.select(F.lit(kind).alias("kind"), "group_key", "entity")
        out = part if out is None else out.unionByName(part)
    return out


def partition_violations(groups: DataFrame, annotations: DataFrame, entities: DataFrame) -> DataFrame:
    """(check, violations): sets partition annotated entities, sequences positional ones, and absent ones are the rest."""
    once = groups.where("kind in ('set', 'sequence', 'absent')").groupBy("kind", "entity").agg(F.count(F.lit(1)).alias("n")).where("n > 1").agg(F.count(F.lit(1)).alias("violations"))
    annotated = annotations.select("entity").distinct()
    missing = annotated.join(groups.where("kind = 'set'"), "entity", "left_anti").agg(F.count(F.lit(1)).alias("violations"))
    both = groups.where("kind = 'absent'").join(annotated, "entity", "left_semi").agg(F.count(F.lit(1)).alias("violations"))
    uncovered = entities.join(groups.where("kind in ('set', 'absent')").select("entity"), "entity", "left_anti").agg(F.count(F.lit(1)).alias("violations"))
    out = None
    for name, part in (("one group a kind", once), ("annotated entities have a set", missing), ("absent ones have no annotation", both), ("universe is covered", uncovered)):
        part = part.select(F.lit(name).alias("check"), "violations")
        out = part if out is None else out.unionByName(part)
    return out


def from_rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, "entity string, code string, start long, stop long, ordinal int, positional boolean")
