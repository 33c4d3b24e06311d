import math
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest

from arbora.llm import packing as P

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, piece string"


def ids_of(text):
    from tokenizers import Tokenizer

    return [*Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids, 2]


def texts():
    rng = random.Random(13)
    words = ["alpha", "Ünïcode", "x", "it's", "12345", "!!", "\n", "日本", "end.\nNext", "<|endoftext|>"]
    fixed = [None, "", " ", "  two  spaces ", "tab\t x", "a \n b", " lead", "trail ", " nb  sp", "word " * 30_000, "z" * 50_000, "same", "same", "\x1c x"]
    return fixed + [" ".join(rng.choices(words, k=rng.randint(1, 700))) for _ in range(60)]


def test_pieces_are_exact_and_sequences_whole(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows] + [(None, "no id", ""), (3, rows[3][1], "")], SCHEMA)
    got = P.pack(df, PATH, added=True).collect()
    by_doc = defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
    for i, t in rows:
        want = ids_of(t)
        pieces = sorted(by_doc[i], key=lambda r: (r.piece, r.sequence_id))
        if i == 3:
            assert len(pieces) == 2 and pieces[0].ids_crc32 == pieces[1].ids_crc32
            pieces = pieces[:1]
        assert [p.piece for p in pieces] == list(range(math.ceil(len(want) / 1024)))
        at = 0
        for p in pieces:
            assert p.start == at and (p.piece == 0 or p.length == 1024) and p.length <= 1024
            assert p.ids_crc32 == zlib.crc32(np.array(want[at : at + p.length], dtype="<u4").tobytes())
            at += p.length
        assert at == len(want)
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= 1024
    least = math.ceil(sum(r.length for r in got) / 1024)
    assert len(bins) <= least + 2
    assert P.pack(df.limit(0), PATH, added=True).collect() == []


@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize("caps", [P.Capacities(), P.Capacities(1024, 4, 600_000), P.Capacities(1024, 1024, 1024 * 1024 // 3 * 4)])
def test_every_capacity_holds(rule, caps):
    rng = random.Random(14)
    histogram = defaultdict(int)
    for _ in range(3000):
        histogram[min(700, 1 + int(rng.expovariate(1 / 200)))] += 1
    slots = P.plan(dict(histogram), caps, rule=rule)
    bins, seen = defaultdict(list), defaultdict(list)
    for length, first, n, sequence, offset in zip(*slots, strict=True):
        for k in range(n):
            bins[sequence + k].append((offset, length))
            seen[length].append(first + k)
    assert all(sorted(seen[k]) == list(range(n)) for k, n in histogram.items())
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= caps.tokens and len(items) <= caps.documents and sum(x * x for _, x in items) <= caps.attention
    total = sum(k * n for k, n in histogram.items())
    bound = max(total / caps.tokens, 3000 / caps.documents, sum(k * k * n for k, n in histogram.items()) / caps.attention)
    assert len(bins) <= 1.2 * bound + 3
    if caps == P.Capacities() and rule == "norm":
        assert len(bins) <= 1.01 * bound + 2
    with pytest.raises(ValueError):
        P.plan({1025: 1})
