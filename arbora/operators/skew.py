"""Shared-folder staging, and lookups that no hot key can overload."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A key is hot if it holds more than this share of the rows (so at most 1 / HOT_SHARE keys are hot).
HOT_SHARE = 1 / 200
HOT_LEAST = 5_000


def stage_root(spark: SparkSession) -> str:
    """spark.checkpoint.dir, which driver and executors share; a folder of our own in local mode only, where it is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="arbora-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{stage_root(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: cuts lineage and survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def discard(*staged: DataFrame) -> None:
    """Deletes the folders of tables that ``stage`` returned, once nothing will read them any more."""
    for df in staged:
        spark, path = df.sparkSession, df._staged_at
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def lookup(left: DataFrame, right: DataFrame, key: str, total: int) -> DataFrame:
    """Left join of ``left`` (``total`` rows, any skew) with ``right`` (one row a key, key not null).

    Keys with over HOT_SHARE of the rows, at most 200 of them, are looked up in a broadcast of their rows of ``right``,
    all others by a join that Spark plans by size, so that no task gets a hot key whole.
    """
    least = max(HOT_LEAST, int(total * HOT_SHARE))
    if total <= least:  # no key can have more rows
        return left.join(right, key, "left")
    counts = left.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where((F.col("_n") > least) & F.col(key).isNotNull())
    hot = [r[0] for r in counts.select(key).limit(int(1 / HOT_SHARE) + 1).collect()]
    if not hot:
        return left.join(right, key, "left")
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    cold = left.where(~is_hot).join(right, key, "left")
    return cold.unionByName(left.where(is_hot).join(F.broadcast(right.where(is_hot)), key, "left"))


#: Rows that a numbering task takes.
NUMBER_ROWS = 1_000_000


def numbered_rows(df: DataFrame, name: str, *order: str | Column) -> DataFrame:
    """``df`` with a number from 0 in order, without gathering the rows in one task.

    Rows are range-partitioned by the order and staged with their range; each range counts for itself and starts where
    the ranges before it end.  Only the counts, a row a range, meet.
    """
    rows = df.withColumns({f"_o{i}": F.col(c) if isinstance(c, str) else c for i, c in enumerate(order)})
    keys = [f"_o{i}" for i in range(len(order))]
    total = rows.count()
    rows = rows.repartitionByRange(max(1, -(-total // NUMBER_ROWS)), *keys)
    rows = stage(rows.withColumn("_range", F.spark_partition_id()), "ranges")
    counts = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    first = F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*keys)) - 1
    out = rows.withColumn("_k", within).join(counts.select("_range", first.alias("_first")), "_range")
    return out.withColumn(name, F.col("_k") + F.col("_first")).drop("_range", "_k", "_first", *keys)
