"""FASTA as a data source of its own: ``spark.read.format("fasta").load(path)``, or in parallel by record separators."""

from __future__ import annotations

import gzip
import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "file string, ordinal long, header string, sequence string"


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self):
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(self.path) if "://" in self.path else (fs.LocalFileSystem(), self.path)
        info = store.get_file_info(root)
        if info.type == fs.FileType.Directory:
            found = [f.path for f in store.get_file_info(fs.FileSelector(root)) if f.is_file and not f.base_name.startswith((".", "_"))]
            return [_File(p) for p in sorted(found)]
        return [_File(root)]

    def read(self, partition):
        from pyarrow import fs

        store = fs.FileSystem.from_uri(self.path)[0] if "://" in self.path else fs.LocalFileSystem()
        with store.open_input_stream(partition.path, compression=None) as raw:
            stream = gzip.open(raw, "rt") if partition.path.endswith(".gz") else _lines(raw)
            header, parts, k = None, [], 0
            for line in stream:
                line = line.rstrip("\r\n")
                if line.startswith(">"):
                    if header is not None:
                        yield partition.path.rsplit("/", 1)[-1], k, header, "".join(parts)
                        k += 1
                    header, parts = line[1:], []
                elif header is not None and line:
                    parts.append(line.strip())
            if header is not None:
                yield partition.path.rsplit("/", 1)[-1], k, header, "".join(parts)


def _lines(raw):
    import io

    return io.TextIOWrapper(raw, encoding="utf-8")


class FastaSource(DataSource):
    """A partition a file."""

    @classmethod
    def name(cls) -> str:
        return "fasta"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema):
        return _Reader(self.options["path"])


def register(spark: SparkSession) -> None:
    """Makes the format "fasta" known; the class travels by value, so that workers need no copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(FastaSource)


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(header, sequence), split at record starts so that one large file is read by many tasks."""
    rows = spark.read.option("lineSep", "\n>").text(path)
    text = F.regexp_replace("value", "^>", "")
    header = F.rtrim(F.substring_index(text, "\n", 1), F.lit("\r"))
    body = F.regexp_replace(F.substring(text, F.length(F.substring_index(text, "\n", 1)) + 2, 1 << 30), r"\s", "")
    return rows.where("trim(value) <> ''").select(header.alias("header"), body.alias("sequence"))


def sequence_table(fasta: DataFrame) -> DataFrame:
    """(taxon, entity, length, sequence)."""
    return fasta.select(F.substring_index("header", "-n_", -1).alias("taxon"), F.col("header").alias("entity"), F.length("sequence").cast("long").alias("length"), "sequence")


def long_headers(fasta: DataFrame, most: int) -> DataFrame:
    return fasta.where(F.length("header") <= most)


def keep_taxa(fasta: DataFrame, keepers: DataFrame, taxon: Column) -> DataFrame:
    """Sequences of the listed species; keepers: (taxon)."""
    return fasta.withColumn("taxon", taxon).join(keepers.select("taxon").distinct(), "taxon", "left_semi").drop("taxon")


def of_locus_types(rows: DataFrame, column: str, allowed: tuple[str, ...]) -> DataFrame:
    """Rows of the allowed locus types, whatever case and blanks around; other and empty types drop out."""
    return rows.where(F.lower(F.trim(column)).isin([a.lower() for a in allowed]))


def longest_isoform(rows: DataFrame, gene: str, sequence: str, ordinal: str) -> DataFrame:
    """The longest sequence a gene, first listed on ties; genes without sequence drop out."""
    rows = rows.where(F.coalesce(F.length(sequence), F.lit(0)) > 0)
    rest = [c for c in rows.columns if c != gene]
    best = rows.groupBy(gene).agg(F.max_by(F.struct(*rest), F.struct(F.length(sequence), -F.col(ordinal))).alias("_r"))
    return best.select(gene, *[F.col(f"_r.{c}").alias(c) for c in rest])


def drop_alternate_loci(rows: DataFrame, gene_id: str, name: str) -> DataFrame:
    """Of the rows of a gene id, that without -N suffix, else with the lowest N."""
    suffix = F.regexp_extract(name, r"-(\d+)$", 1)
    order = F.when(suffix == "", F.lit(-1)).otherwise(suffix.try_cast("long"))
    rest = [c for c in rows.columns if c != gene_id]
    best = rows.groupBy(gene_id).agg(F.min_by(F.struct(*rest), F.struct(order, F.col(name))).alias("_r"))
    return best.select(gene_id, *[F.col(f"_r.{c}").alias(c) for c in rest])
