"""Streaming upkeep of the presence table and windowed counts: extensions beyond the batch operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def new_memberships(stream: DataFrame, feature: str, tip: str, time: str, delay: str = "1 hour") -> DataFrame:
    """First sight of each (feature, tip) within the watermark."""
    rows = stream.select(F.col(feature).alias("feature"), F.col(tip).alias("tip"), F.col(time).alias("time")).withWatermark("time", delay)
    return rows.dropDuplicatesWithinWatermark(["feature", "tip"])


def window_counts(stream: DataFrame, time: str, key: str, value: str, width: str = "1 hour", delay: str = "2 hours") -> DataFrame:
    rows = stream.withWatermark(time, delay).groupBy(F.window(time, width).alias("w"), key)
    out = rows.agg(F.count(F.lit(1)).alias("n"), F.bround(F.sum(value).cast("double"), 2).alias("total"))
    return out.select(F.unix_timestamp("w.start").alias("window_start"), key, "n", "total")


def sink_presence(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends presence rows to a Parquet table, exactly once, until what is there is read."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def upsert_presence(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Merges each batch into the table by an anti-join with what is there."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark: SparkSession = batch.sparkSession
        fresh = batch.select("feature", "tip").distinct()
        try:
            known = spark.read.parquet(path).where(F.col("batch_id") != batch_id)
            fresh = fresh.join(known.select("feature", "tip"), ["feature", "tip"], "left_anti")
        except Exception as e:  # the first batch finds no table
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        fresh.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").partitionBy("batch_id").parquet(path)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
