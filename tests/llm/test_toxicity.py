import itertools
import random
import zlib

import numpy as np

from arbora.llm import toxicity as T

SCHEMA = "doc_id long, text string, score string, toxic int"


def plain(e, start, t):
    """Log odds of one chain, word after word in logarithms."""
    n = len(e)
    f, b = np.zeros((n, 2)), np.zeros((n, 2))
    for i in range(n):
        own = np.array([0.0, e[i]])
        f[i] = own + (np.array([0.0, start]) if i == 0 else np.logaddexp(f[i - 1, 0] + t[0], f[i - 1, 1] + t[1]))
    for i in range(n - 2, -1, -1):
        x = b[i + 1] + np.array([0.0, e[i + 1]])
        b[i] = np.logaddexp(t[:, 0] + x[0], t[:, 1] + x[1])
    return (f + b)[:, 1] - (f + b)[:, 0]


def test_forward_backward_matches_enumeration():
    rng = np.random.default_rng(8)
    sizes, t, start = [6, 4, 1, 5], rng.normal(size=(2, 2)), 0.7
    e = rng.normal(size=sum(sizes))
    starts = np.concatenate([[0], np.cumsum(sizes)])
    odds, _, _ = T.forward_backward(e, T.firsts(starts), start, t)
    for first, k in zip(starts, sizes, strict=False):
        weight = {}
        for path in itertools.product((0, 1), repeat=k):
            s = start * path[0] + sum(e[first + i] * path[i] for i in range(k)) + sum(t[a, b] for a, b in itertools.pairwise(path))
            weight[path] = np.exp(s)
        for i in range(k):
            yes = sum(w for p, w in weight.items() if p[i])
            no = sum(w for p, w in weight.items() if not p[i])
            assert abs(odds[first + i] - np.log(yes / no)) < 1e-9


def test_long_texts_are_one_chain():
    rng = np.random.default_rng(9)
    sizes = [10_000, 1, 127, 128, 129, 3_000]
    t, start = np.array([[2.0, -3.0], [-1.0, 2.5]]), -1.0
    e = rng.normal(size=sum(sizes)) * 4
    starts = np.concatenate([[0], np.cumsum(sizes)])
    odds, _, _ = T.forward_backward(e, T.firsts(starts), start, t)
    for a, b in itertools.pairwise(starts):
        assert np.abs(odds[a:b] - plain(e[a:b], start, t)).max() < 1e-7


def test_query_matches_brute_force(spark):
    """The registered query against scores computed document by document, word by word."""
    from pathlib import Path

    from arbora.llm import queries

    sf = "/root/testdata/sf0.001"
    if not Path(sf).exists():
        return
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    texts, toxic = T.training_sample(docs, labels)
    field = T.train(texts, toxic)
    got = {r.doc_id: r for r in queries.op1_toxicity(spark, sf).collect()}
    assert len(got) == docs.count()
    for r in docs.collect():
        words = T.WORD.findall((r.text or "").lower())
        own = [T.word_features(w) for w in words]
        e = np.array([field.bias + field.w[0][x].sum() for x in own], dtype=float)
        for i in range(len(own)):
            e[i] += (field.w[1][own[i - 1]].sum() if i else 0.0) + (field.w[2][own[i + 1]].sum() if i + 1 < len(own) else 0.0)
        odds = plain(e, field.start, field.t)
        x = [np.clip(odds.max(), -10, 10), np.clip(np.log((1 / (1 + np.exp(-odds))).sum() + 1e-9), -10, 10)] if words else [-10.0, -10.0]
        score = 1 / (1 + np.exp(-(np.dot(x, field.doc[:2]) + field.doc[2])))
        assert abs(got[r.doc_id].score - score) < 1e-3, r.doc_id
        assert got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_held_out_documents_spans_and_edges(spark):
    rng = random.Random(9)
    vocabulary = [a + b for a in "ka lo mi ten ru sol".split() for b in "ba de fo gu hi".split()]
    docs, labels = [], []
    for i in range(500):
        words, bad = rng.choices(vocabulary, k=rng.randint(5, 60)), i % 4 == 0
        if bad:
            words[rng.randrange(len(words))] = rng.choice(["Vileish", "nastyone", "vileous"])
        docs.append((i, " ".join(words) + ".", "clash", 9))
        labels.append((i, int(bad)))
    docs += [(900, None, "", 0), (901, "", "", 0), (902, "kaba " * 50_000 + "nastyone", "", 0), (None, "İstanbul nastyone", "", 0)]
    labels += [(None, 1), (1, None), (4, 1)]
    df, lab = spark.createDataFrame(docs + docs[:1], SCHEMA), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = T.toxicity(df, lab).collect()
    assert len(got) == len(docs) + 1
    by = {r.doc_id: r for r in got}
    for i in range(500):
        assert by[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert by[i].predicted == int(i % 4 == 0) == int(by[i].score >= 0.5)
        if i % 4 == 0:
            assert any(docs[i][1][s.start : s.end].lower() in ("vileish", "nastyone", "vileous") for s in by[i].spans)
    assert by[900].predicted == by[901].predicted == 0 and by[900].score == by[901].score and by[900].spans == []
    assert by[902].predicted == 1 and [(s.start, s.end) for s in by[902].spans] == [(250_000, 250_008)]
    assert by[None].predicted == 1 and by[None].held_out is False


def test_without_labels_or_documents(spark):
    docs = spark.createDataFrame([(1, "a b", "", 0)], SCHEMA)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert len(T.toxicity(docs, none).collect()) == 1
    assert T.toxicity(docs.limit(0), none).collect() == []
