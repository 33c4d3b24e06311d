"""The opN queries: each applies its operator, with production parameters, to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from arbora.llm import cotraining, flac, html_text, language_id, mixing, packing, quality_rules, simhash, toxicity, warc
from arbora.llm.shared import read


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read(spark, sf_dir, "pages"))


def op3_flac(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flac.media_digests(read(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer_path(), added=True)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(read(spark, sf_dir, "pages"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_verdicts(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(read(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicate_classes(read(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(read(spark, sf_dir, "documents"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotraining.quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_html_text": op2_html_text,
    "op3_flac": op3_flac,
    "op4_packing": op4_packing,
    "op5_warc": op5_warc,
    "op6_quality_rules": op6_quality_rules,
    "op7_mixing": op7_mixing,
    "op8_simhash": op8_simhash,
    "op9_language_id": op9_language_id,
    "op10_quality_classifier": op10_quality_classifier,
}

#: Bits of a hexadecimal digest, dealt five by five to the base32 alphabet.
_BASE32 = (
    "array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + "
    "list_sum(list_transform(range(0, 5), lambda b: (1 << (4 - b)) * substr(bits, 1 + 5 * i + b, 1)::INTEGER))::INTEGER, 1)), '')"
)
_WARC = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, min(page_id) AS first_id FROM p GROUP BY h),
b AS (SELECT h, first_id, array_to_string(list_transform(range(1, 41), lambda i:
  ['0000', '0001', '0010', '0011', '0100', '0101', '0110', '0111', '1000', '1001', '1010', '1011', '1100', '1101', '1110', '1111']
  [strpos('0123456789abcdef', substr(h, i, 1))]), '') AS bits FROM f),
d AS (SELECT h, first_id, {_BASE32} AS payload_digest FROM b)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes, payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM p JOIN d USING (h)
"""

ORACLE_SQL: dict[str, str] = {
    "op5_warc": _WARC,
    "op6_quality_rules": quality_rules.oracle_sql(),
    "op7_mixing": mixing.oracle_sql(),
}
