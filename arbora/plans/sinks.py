"""Writers: self-documenting TSV, FASTA, one table a group, wide matrices, catalogue views, run summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from arbora.operators import trees as T


def header_cells(df: DataFrame, prose: dict[str, str] | None = None) -> list[str]:
    """``Id (prose)``, the prose given or kept as a column's comment."""
    said = {f.name: (prose or {}).get(f.name) or f.metadata.get("comment", "") for f in df.schema.fields}
    return [f"{n} ({p})" if p else n for n, p in said.items()]


def write_tsv(df: DataFrame, path: str, order: list[str], prose: dict[str, str] | None = None, single: bool = False) -> None:
    """Rows in order; nulls as empty cells.  ``single`` writes one file, for reports; facts keep their partitions, one after the other."""
    named = df.select(*[F.col(f"`{c}`").cast("string").alias(h) for c, h in zip(df.columns, header_cells(df, prose), strict=True)])
    out = df.orderBy(*order)
    out = out.select(*[F.col(f"`{c}`").cast("string").alias(h) for c, h in zip(df.columns, named.columns, strict=True)])
    (out.coalesce(1) if single else out).write.mode("overwrite").option("sep", "\t").option("header", True).option("quote", "").csv(path)


def write_quoted(df: DataFrame, path: str) -> None:
    """CSV with quotes where needed, so that cells may hold line feeds."""
    df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def fasta_lines(df: DataFrame, header: Column, sequence: Column) -> DataFrame:
    return df.select(F.concat(F.lit(">"), header, F.lit("\n"), sequence).alias("value"))


def write_fasta(df: DataFrame, path: str, header: Column, sequence: Column) -> None:
    fasta_lines(df, header, sequence).write.mode("overwrite").text(path)


def write_by_group(df: DataFrame, path: str, group: str) -> None:
    """A folder a value of ``group``."""
    df.repartition(group).write.mode("overwrite").partitionBy(group).parquet(path)


def wide(df: DataFrame, row: str, column: str, values: list[str], value: Column) -> DataFrame:
    """A pivot over a given list of columns, so that no job has to find them."""
    return df.groupBy(row).pivot(column, values).agg(value)


def write_newick(root: T.Node, style: str = "full") -> str:
    return T.to_newick(root, style)


def publish(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def observed(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """``df`` with metrics gathered while it is written, for run summaries."""
    seen = Observation(name)
    return df.observe(seen, *[c.alias(k) for k, c in metrics.items()]), seen


def markdown(df: DataFrame, title: str, most: int = 200) -> str:
    """A small report table; a table of over ``most`` rows raises, as a report would not be whole."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"over {most} rows; write a table instead")
    lines = [f"# {title}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    return "\n".join(lines + ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows])
