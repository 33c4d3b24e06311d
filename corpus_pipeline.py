"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), reads all that its predecessor kept, and is written as Parquet before the
next one starts.  All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from arbora.llm import cotraining, language_id, mixing, near_copies, packing
from arbora.llm.queries import tokenizer_path
from arbora.llm.shared import materialize, read


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the co-trained quality classifier does not reject."""
    return cotraining.keep_good(docs, read(spark, sf_dir, "labels"))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language compression tells by a margin that is not narrow."""
    return language_id.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class that five-word Jaccard similarities of at least 0.8 link: that with the smallest id."""
    return near_copies.drop_near_copies(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows drawn by probabilities that rake sources, languages and topics to their target weights."""
    return mixing.sample(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row a piece: its place in a sequence of at most 1024 tokens."""
    return packing.pack(docs, tokenizer_path(), added=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", good_quality),
    ("language_id", known_language),
    ("near_duplicates", near_duplicates),
    ("mixing", mixed),
    ("packing", packed),
]

#: SQL cannot express the classifiers; tests hold the run against its stages' brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
