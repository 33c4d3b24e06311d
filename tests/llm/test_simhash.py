import random

import numpy as np

from arbora.llm import simhash as S

SCHEMA = "doc_id long, text string, fp string, n long"


def brute(rows):
    """Component of each row by comparing all pairs."""
    import xxhash

    def fingerprint(text):
        words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
        grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
        hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))

    fps = [fingerprint(t) for _, t in rows]
    ids = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(len(rows)):
                if ids[i] != ids[j] and bin(fps[i] ^ fps[j]).count("1") <= 2:
                    ids[i] = ids[j] = min(ids[i], ids[j])
                    changed = True
    return [(f"{f:016x}", ids[i]) for i, f in enumerate(fps)]


def test_matches_brute_force(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(60)]
    base = [" ".join(rng.choices(words, k=300)) for _ in range(12)]
    rows = []
    for b in base:
        for _ in range(6):
            w = b.split()
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = rng.choice(words)
            rows.append((len(rows), " ".join(w)))
    rows += [(len(rows) + i, t) for i, t in enumerate(["", None, "  \n", "One", "one", "A b", "Été\tX y z", rows[0][1], rows[0][1].upper()])]
    want = {i: (fp, rows[c][0]) for (i, _), (fp, c) in zip(rows, brute(rows), strict=True)}
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], SCHEMA)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in S.near_duplicate_classes(df).collect()}
    assert got == want
    kept = S.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in want.values()})


def test_large_buckets_and_long_chains(spark):
    rng = random.Random(2)
    fps = {0}
    x = rng.getrandbits(64)
    for _ in range(300):  # a chain of two-bit steps, and a ball of neighbours
        x ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64))
        fps.add(x)
    y = rng.getrandbits(64)
    fps |= {y ^ (1 << a) ^ (1 << b) for a in range(12) for b in range(12)}
    fps |= {rng.getrandbits(64) for _ in range(200)}
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    rows = spark.createDataFrame([(i, f) for i, f in enumerate(signed)] + [(None, signed[3]), (7, signed[7])], "doc_id long, fp long")
    for limit in (2, 24):
        edges = S.links(rows.select("fp").distinct(), len(fps), pair_limit=limit)
        got = {r.node: r.comp for r in S.components(edges).collect()}
        parent = list(range(len(fps)))

        def find(i):
            while parent[i] != i:
                i = parent[i]
            return i

        for i in range(len(fps)):
            for j in range(i):
                if bin(fps[i] ^ fps[j]).count("1") <= 2:
                    parent[max(find(i), find(j))] = min(find(i), find(j))
        groups = {}
        for i in range(len(fps)):
            groups.setdefault(find(i), []).append(signed[i])
        want = {f: min(g) for g in groups.values() if len(g) > 1 for f in g}
        assert got == want
    classes = S.classes_of(rows).collect()
    assert len(classes) == len(fps) + 2


def test_masks_cover_two_bits():
    rng = np.random.default_rng(3)
    sample = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    sample[:, ] &= np.uint64(0xFFFFFFFFFFFF00FF)
    for total in (10, 3000, 10**6, 10**11):
        masks = S.plan_masks(sample, total)
        for a in range(64):
            for b in range(a):
                diff = (1 << a) | (1 << b)
                assert any(m & diff == 0 for m in masks)


def test_empty_and_repeated(spark):
    assert S.near_duplicate_classes(spark.createDataFrame([], SCHEMA)).collect() == []
    assert S.drop_near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(5, "a b c d", "x", 1)] * 3 + [(None, "zz", "y", 2), (None, "zz", "y", 2), (9, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted((str(r.doc_id), str(r.component_id)) for r in S.near_duplicate_classes(df).collect())
    assert got == [("5", "5")] * 3 + [("9", "9")] + [("None", "None")] * 2
    assert sorted(str(r.doc_id) for r in S.drop_near_duplicates(df).collect()) == ["5", "9", "None"]


def test_repeated_ids_lose_no_class(spark):
    rows = [(3, "one text of its own", "a", 1), (7, "one text of its own", "b", 1), (7, "quite another text here", "c", 1), (5, "a third one that stands alone", "d", 1), (5, "and a fourth which is not like it", "e", 1)]
    kept = S.drop_near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted({(3, rows[0][1]), (7, rows[2][1]), (5, rows[3][1]), (5, rows[4][1])})


def test_any_number_of_bits(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(6)]
    fps = set(base)
    for b in base:
        for k in (1, 2, 3, 4, 5):
            for _ in range(3):
                x = b
                for bit in rng.sample(range(64), k):
                    x ^= 1 << bit
                fps.add(x)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    rows = spark.createDataFrame([(f,) for f in signed], "fp long")
    for tau, limit in ((0, 24), (1, 2), (3, 2), (5, 2)):
        own = list(range(len(fps)))
        for i in range(len(fps)):
            for j in range(i):
                if bin(fps[i] ^ fps[j]).count("1") <= tau and own[i] != own[j]:
                    low, high = min(own[i], own[j]), max(own[i], own[j])
                    own = [low if x == high else x for x in own]
        want = {signed[i]: min(signed[j] for j in range(len(fps)) if own[j] == own[i]) for i in range(len(fps)) if own.count(own[i]) > 1}
        assert {r.node: r.comp for r in S.components(S.links(rows, len(fps), tau, pair_limit=limit)).collect()} == want, tau


def test_very_long_text():
    long = "word " * 400_000
    assert S.simhash(long) == S.simhash("word word word")
