"""The whole run over the smallest tables against driver-side versions of every stage's rule."""

import sys
from collections import defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline as C  # noqa: E402

from arbora.llm import cotraining, language_id, mixing, packing  # noqa: E402

SF = "/root/testdata/sf0.001"


def classes(texts):
    """Place of the first text of each one's class, by the sets of five-word shingles of all pairs."""
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    own = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if own[i] != own[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                low, high = min(own[i], own[j]), max(own[i], own[j])
                own = [low if x == high else x for x in own]
    return own


@pytest.mark.skipif(not Path(SF).exists(), reason="needs the test tables")
def test_stages_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    columns = docs.columns
    now = {r.doc_id: r for r in docs.collect()}

    got = C.good_quality(spark, docs, SF)
    assert got.columns == columns
    model = cotraining.train(cotraining.training_sample(docs, labels))
    rows = [now[i] for i in sorted(now)]
    _, score = model([r.text for r in rows], [r.source for r in rows], [r.lang for r in rows], [r.n_chars for r in rows])
    want = {r.doc_id for r, s in zip(rows, score, strict=True) if s >= cotraining.LEAST}
    assert {r.doc_id for r in got.collect()} == want and len(want) > 100

    kept = docs.where(docs.doc_id.isin(list(want)))
    got = C.known_language(spark, kept, SF)
    classify = language_id.Classifier(language_id.dictionaries(language_id.training_sample(kept)))
    want = {i for i in want if classify(now[i].text)[1] >= language_id.MIN_MARGIN}
    assert {r.doc_id for r in got.collect()} == want and got.columns == columns

    kept = docs.where(docs.doc_id.isin(list(want)))
    own = dict(zip(sorted(want), [sorted(want)[k] for k in classes([now[i].text for i in sorted(want)])], strict=True))
    want = {i for i in want if own[i] == i}
    got = C.near_duplicates(spark, kept, SF)
    assert {r.doc_id for r in got.collect()} == want and got.columns == columns

    kept = docs.where(docs.doc_id.isin(list(want)))
    drawn = {r.doc_id for r in mixing.mixture(kept).collect() if r.selected}
    got = C.mixed(spark, kept, SF)
    assert {r.doc_id for r in got.collect()} == drawn and got.columns == columns and 0.3 < len(drawn) / len(want) < 1

    final = C.run(spark, SF).collect()
    assert {r.doc_id for r in final} == drawn
    encoder, seats = packing.Encoder(public_tokenizers.path("byte_bpe_50k.json"), added=True), defaultdict(list)
    for i in drawn:
        ids, _ = encoder([now[i].text])
        assert sum(r.length for r in final if r.doc_id == i) == len(np.asarray(ids))
    for r in final:
        seats[r.sequence_id].append((r.offset, r.length))
    for items in seats.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= 1024


def test_stages_keep_clashing_columns_nulls_and_empty_tables(spark):
    """Extra columns may have any name, those of intermediate columns too; null ids, texts and metadata do no harm."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(120)
    extra = {"_quality": "q", "_language": "x", "_source": "s", "_tokens": "t", "_selected": "y", "_fp": "f", "a.b": "d", "_row": "r", "_n": "n", "fp": "p"}
    for name, value in extra.items():
        docs = docs.withColumn(name, mixing.F.lit(value))
    none = docs.limit(3).withColumns({"doc_id": mixing.F.lit(None).cast("long"), "source": mixing.F.lit(None).cast("string"), "lang": mixing.F.lit(None).cast("string")})
    blank = docs.limit(2).withColumns({"doc_id": mixing.F.lit(9_000_001).cast("long"), "text": mixing.F.lit(None).cast("string"), "n_chars": mixing.F.lit(None).cast("long")})
    rows = docs.unionByName(none).unionByName(blank)
    for name, stage in C.STAGES[:-1]:
        got = stage(spark, rows, SF)
        assert got.columns == rows.columns, name
        kept = got.collect()
        assert kept and all(r["_quality"] == "q" and r["_source"] == "s" and r["a.b"] == "d" and r["_row"] == "r" for r in kept), name
        assert stage(spark, rows.limit(0), SF).collect() == [], name
    assert C.packed(spark, rows, SF).where("doc_id is null").count() >= 3


def test_stages_take_very_long_texts(spark):
    """One text of a megabyte goes through all stages."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    long = docs.orderBy("doc_id").limit(1).withColumns({"doc_id": mixing.F.lit(9_000_002).cast("long"), "text": mixing.F.expr("left(repeat(concat(text, ' '), 3000), 1000000)")})
    rows = docs.unionByName(long)
    for name, stage in C.STAGES[:-1]:
        assert stage(spark, rows, SF).columns == rows.columns, name
    assert C.packed(spark, rows, SF).where("doc_id = 9000002").count() > 100


def test_names_and_order():
    assert [n for n, _ in C.STAGES] == ["quality_classifier", "language_id", "near_duplicates", "mixing", "packing"]
