"""Closed integer intervals, as array cells ``s-e,s-e`` or as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def parse(cell: Column) -> Column:
    """array<struct<start, stop>>; malformed parts are left out, null gives an empty array."""
    part = lambda x: F.struct(F.regexp_extract(x, r"^\s*(\d+)", 1).cast("long").alias("start"), F.regexp_extract(x, r"-\s*(\d+)\s*$", 1).cast("long").alias("stop"))
    good = F.filter(F.split(F.coalesce(cell, F.lit("")), ","), lambda x: x.rlike(r"^\s*\d{1,18}\s*-\s*\d{1,18}\s*$"))
    return F.transform(good, part)


def render(intervals: Column) -> Column:
    return F.array_join(F.transform(intervals, lambda x: F.concat(x["start"].cast("string"), F.lit("-"), x["stop"].cast("string"))), ",")


def merge(intervals: Column) -> Column:
    """Overlapping or adjacent intervals (next start at most stop + 1) become one; sorted."""

    def step(acc: Column, x: Column) -> Column:
        last = F.element_at(acc, -1)
        joined = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["stop"], x["stop"]).alias("stop"))))
        return F.when((F.size(acc) > 0) & (x["start"] <= F.try_element_at(acc, F.lit(-1))["stop"] + 1), joined).otherwise(F.concat(acc, F.array(x)))

    empty = F.array().cast("array<struct<start:bigint,stop:bigint>>")
    return F.aggregate(F.array_sort(intervals), empty, step)


def total(intervals: Column) -> Column:
    """Sum of inclusive lengths."""
    return F.aggregate(intervals, F.lit(0).cast("long"), lambda acc, x: acc + x["stop"] - x["start"] + 1)


def sizes(intervals: Column) -> Column:
    return F.transform(intervals, lambda x: x["stop"] - x["start"] + 1)


def gaps(intervals: Column) -> Column:
    """Sizes between consecutive intervals of a sorted array."""
    n = F.size(intervals)
    between = F.transform(F.slice(intervals, 2, F.greatest(n - 1, F.lit(0))), lambda x, i: x["start"] - F.get(intervals, i)["stop"] - 1)
    return F.when(n > 1, between).otherwise(F.array().cast("array<bigint>"))


def oriented(values: Column, strand: Column) -> Column:
    return F.when(strand == "-", F.reverse(values)).otherwise(values)


def gene_metrics(genes: DataFrame) -> DataFrame:
    """Sizes of genes: (…, gene_start, gene_stop, strand, exons, cds cells) gain gene, transcript, cds, protein, intron
    and UTR sizes, clamped at zero, and exon and intron sizes in the direction of the strand."""
    rows = genes.withColumns({"_exons": merge(parse(F.col("exons"))), "_cds": merge(parse(F.col("cds")))})
    rows = rows.withColumns({"gene_size": F.col("gene_stop") - F.col("gene_start") + 1, "transcript_size": total(F.col("_exons")), "cds_size": total(F.col("_cds")), "_gaps": gaps(F.col("_exons"))})
    zero = lambda c: F.greatest(c, F.lit(0).cast("long"))
    text = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    rows = rows.withColumns({
        "protein_size": F.expr("cds_size div 3"), "intron_size": zero(F.col("gene_size") - F.col("transcript_size")), "utr_size": zero(F.col("transcript_size") - F.col("cds_size")),
        "exon_count": F.size("_exons"), "exon_sizes": text(oriented(sizes(F.col("_exons")), F.col("strand"))), "intron_sizes": text(oriented(F.col("_gaps"), F.col("strand"))),
    })
    return rows.drop("_exons", "_cds", "_gaps")


def coding_metrics(genes: DataFrame) -> DataFrame:
    """The smaller set of sizes for sources that give coding intervals only."""
    cds = merge(parse(F.col("cds")))
    rows = genes.withColumns({"gene_size": F.col("gene_stop") - F.col("gene_start") + 1, "cds_size": total(cds)})
    return rows.withColumn("protein_size", F.expr("cds_size div 3"))


def merge_rows(rows: DataFrame, key: str, start: str, stop: str, slack: int = 1) -> DataFrame:
    """(key, start, stop, n): merged intervals of each key by gaps and islands; scales to keys with many intervals."""
    order = Window.partitionBy(key).orderBy(start, stop)
    reach = F.max(stop).over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(reach.isNull() | (F.col(start) > reach + slack), 1).otherwise(0)
    island = F.sum("_fresh").over(order.rowsBetween(Window.unboundedPreceding, 0))
    out = rows.withColumn("_fresh", fresh).withColumn("_island", island)
    return out.groupBy(key, "_island").agg(F.min(start).alias(start), F.max(stop).alias(stop), F.count(F.lit(1)).alias("n")).drop("_island")


def row_gaps(merged: DataFrame, key: str, start: str, stop: str) -> DataFrame:
    """(key, start, stop, gap): space between each interval and the one before."""
    before = F.lag(stop).over(Window.partitionBy(key).orderBy(start, stop))
    return merged.select(key, start, stop, (F.col(start) - before).alias("gap")).where("gap is not null")


def compile_status(results: DataFrame, manifest: DataFrame, key: str) -> DataFrame:
    """The manifest with rows processed and a status, PROCESSED or SKIPPED."""
    n = results.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    out = manifest.join(n, key, "left").fillna(0, ["rows"])
    return out.withColumn("status", F.when(F.col("rows") > 0, "PROCESSED").otherwise("SKIPPED"))
