import random

import numpy as np

from arbora.llm import cotraining as C

SCHEMA = "doc_id long, text string, source string, lang string, n_chars long, quality string, score int"


def corpus(seed=10, n=900):
    rng = random.Random(seed)
    vocabulary = [a + b for a in "ka lo mi ten ru sol".split() for b in "ba de fo gu hi".split()]
    docs, labels = [], []
    for i in range(n):
        words, bad = rng.choices(vocabulary, k=rng.randint(10, 60)), i % 5 == 0
        if bad:
            words = [w + "&&&" for w in words] if i % 2 else [w.upper() + "!!" for w in words]
        text = " ".join(words)
        docs.append((i, text, "spam" if bad and rng.random() < 0.7 else "site", "en", len(text), "clash", 3))
        if i % 3:
            labels.append((i, int(not bad)))
    return docs, labels


def test_scores_unlabelled_documents_and_edges(spark):
    docs, labels = corpus()
    extra = [(5000, None, None, None, None, "", 0), (5001, "", "site", "en", 0, "", 0), (5002, "kaba lode " * 60_000, "site", "en", 600_000, "", 0), (None, "kaba&&& lode&&& mifo&&&", "spam", "en", 20, "", 0)]
    lab = spark.createDataFrame(labels + [(None, 0), (3, None), labels[0]], "doc_id long, quality int")
    df = spark.createDataFrame(docs + extra + docs[:2], SCHEMA)
    got = C.quality_scores(df, lab).collect()
    assert len(got) == len(docs) + 6
    by = {r.doc_id: r for r in got}
    held = [i for i in range(900) if i % 3 == 0]
    assert sum(by[i].predicted == int(i % 5 != 0) for i in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in got) and by[None].rejected
    kept = C.keep_good(df, lab)
    assert kept.columns == df.columns
    ids = {r.doc_id for r in kept.collect()}
    assert sum(i in ids for i in range(900) if i % 5) >= 0.98 * 720 and sum(i in ids for i in range(0, 900, 5)) <= 4


def test_views_exchange_pseudo_labels(spark):
    docs, labels = corpus(11)
    model = C.train(C.training_sample(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels[:60], "doc_id long, quality int")))
    assert len(model.log) == C.ROUNDS and all(a > 0 for a, _, _ in model.log) and sum(b for _, b, _ in model.log) > 0


def test_without_labels_or_documents(spark):
    docs, _ = corpus(12, 20)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert C.quality_scores(spark.createDataFrame(docs, SCHEMA), none).count() == 20
    assert C.quality_scores(spark.createDataFrame([], SCHEMA), none).collect() == []


def test_views_are_calibrated(spark):
    docs, labels = corpus(13)
    model = C.train(C.training_sample(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int")))
    assert not np.allclose(model.scale, [[1, 0], [1, 0]])
    assert np.allclose(C.train(C.training_sample(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame([(1, 1), (5, 0)], "doc_id long, quality int"))).combine, [0.5, 0.5, 0])


def test_query_matches_brute_force(spark):
    """The registered query against both views computed token by token."""
    from pathlib import Path

    from arbora.llm import queries

    sf = "/root/testdata/sf0.001"
    if not Path(sf).exists():
        return
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = C.train(C.training_sample(docs, labels))
    got = {r.doc_id: r for r in queries.op10_quality_classifier(spark, sf).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    for r in rows:
        tokens = (r.text or "").split()
        n, w = max(1, len(tokens)), model.content.w
        dense = [np.log1p(len(tokens)) / 8, len(set(tokens)) / n, sum(a == b for a, b in zip(tokens, tokens[1:], strict=False)) / n]
        dense += [sum(any(c.isalpha() for c in t) for t in tokens) / n, sum(t.isupper() and len(t) > 1 for t in tokens) / n, sum(not t[-1].isalnum() and t[-1] not in ".,;:?!)\"'" for t in tokens) / n]
        content = np.dot(dense, model.content.d) + model.content.b + sum(float(w[C.hashed("w", t.lower(), C.SIZE)]) + float(w[C.hashed("s", C.shape(t), C.SIZE)]) for t in tokens) / n
        size = int(np.log2(1 + r.n_chars) * 2)
        meta = model.metadata.b + sum(model.metadata.w[C.hashed(k, v, C.META_SIZE)] for k, v in (("s", str(r.source)), ("l", str(r.lang)), ("p", f"{r.source}|{r.lang}"), ("n", str(size))))
        views = [float(np.clip(v, -8, 8) * a + b) for v, (a, b) in zip((content, meta), model.scale, strict=True)]
        score = sigmoid(np.dot(views, model.combine[:2]) + model.combine[2])
        g = got[r.doc_id]
        assert abs(g.score - score) < 1e-3 and abs(g.score_content - sigmoid(views[0])) < 1e-3 and abs(g.score_metadata - sigmoid(views[1])) < 1e-3
        assert g.predicted == int(g.score >= 0.5) and g.rejected == (g.score < C.LEAST)
