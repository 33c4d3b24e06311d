"""Readers, folds and the shared-folder helpers of the llm operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arbora.operators.skew import discard, lookup, new_path
from arbora.operators.skew import stage as materialize

__all__ = ["Buckets", "chosen_rows", "discard", "fold", "fresh", "lookup", "materialize", "new_path", "quote", "quoted", "read", "write_buckets"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until ``df`` has no such column."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name = "_" + name
    return name


def quoted(columns: list[str]) -> list[Column]:
    """The columns by name, whatever dots the names hold."""
    return [F.col(quote(c)) for c in columns]


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def chosen_rows(docs: DataFrame, doc_id: str, key: Column, kept: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of ``docs`` with an id and a ``key`` (of the text) of ``kept`` (id, th): one row each, all columns.

    ``rows`` (id, th) are those of all of ``docs``.  Of rows with one id and one text the least by the other columns stays.
    """
    kept = materialize(kept.select(F.col("id").alias("_kept_id"), F.col("th").alias("_kept_th")), "kept")
    many = rows.groupBy("id", "th").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    again = many.join(kept, (F.col("th") == F.col("_kept_th")) & F.col("id").eqNullSafe(F.col("_kept_id")), "left_semi")
    again = materialize(again.select(F.col("id").alias("_kept_id"), F.col("th").alias("_kept_th")), "repeated")
    same = (key == F.col("_kept_th")) & F.col(quote(doc_id)).eqNullSafe(F.col("_kept_id"))
    chosen = docs.join(kept, same, "left_semi")
    if again.isEmpty():  # no row is repeated
        return chosen.select(*quoted(docs.columns))
    rest = [c for c in docs.columns if c != doc_id]
    least = chosen.join(again, same, "left_semi").groupBy(quote(doc_id), key.alias("_th_")).agg(F.min(F.struct(*quoted(rest))).alias("_least"))
    back = [F.col(quote(doc_id)) if c == doc_id else F.col(f"_least.{quote(c)}") for c in docs.columns]
    return chosen.join(again, same, "left_anti").select(*quoted(docs.columns)).unionByName(least.select(*back))


def fold(doc_id: str | Column = "doc_id", n: int = 5) -> Column:
    """crc32 of the id as text modulo ``n``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % n


#: Rows of a bucket, about.
BUCKET_ROWS = 500_000


def write_buckets(df: DataFrame, by: str, total: int, name: str) -> Buckets:
    """Writes ``df`` (``total`` rows) to the shared folder in buckets by an integer column, for tasks that look values up."""
    n, path = max(1, -(-total // BUCKET_ROWS)), new_path(df.sparkSession, name)
    rows = df.withColumn("bucket", F.pmod(F.col(by), F.lit(n)))
    rows.repartition(n, "bucket").sortWithinPartitions("bucket", by).write.partitionBy("bucket").parquet(path)
    return Buckets(path, n, by)


class Buckets:
    """Read by tasks, through pyarrow's file systems: the rows of one value, or all rows, file by file."""

    def __init__(self, path: str, n: int, by: str):
        self.path, self.n, self.by = path, n, by

    def of(self, value: int, columns: list[str]) -> Iterator[pa.Table]:
        return self._tables(f"/bucket={value % self.n}", columns, [(self.by, "==", value)])

    def all(self, columns: list[str]) -> Iterator[pa.Table]:
        return self._tables("", columns, None)

    def _tables(self, folder: str, columns: list[str], only: list | None) -> Iterator[pa.Table]:
        import pyarrow.parquet as pq
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(self.path)
        found = store.get_file_info(fs.FileSelector(root + folder, recursive=True, allow_not_found=True))
        for path in sorted(f.path for f in found if f.path.endswith(".parquet")):
            yield pq.read_table(path, filesystem=store, columns=columns, filters=only, partitioning=None)
