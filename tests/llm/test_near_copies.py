import random

from arbora.llm import near_copies as N

SCHEMA = "doc_id long, text string, `a.b` string, _sid long"


def classes(texts):
    """Rows of each class, by comparing all pairs of word shingles."""

    def grams(text):
        w = (text or "").lower().split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())

    sets = [grams(t) for t in texts]
    own = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            same = 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])
            if same and own[i] != own[j]:
                old, new = max(own[i], own[j]), min(own[i], own[j])
                own = [new if x == old else x for x in own]
    return own


def texts():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    out = []
    for _ in range(12):
        base = rng.choices(words, k=rng.choice([20, 80, 300, 1500]))
        for edits in (0, 1, 2, 3, 5, 8, 12, 20):
            w = list(base)
            for _ in range(edits):
                w[rng.randrange(len(w))] = rng.choice(words)
            out.append(" ".join(w))
    base = rng.choices(words, k=150)
    for _ in range(90):  # all share shingles, some are similar
        w = list(base)
        for _ in range(rng.randint(2, 6)):
            w[rng.randrange(len(w))] = rng.choice(words)
        out.append(" ".join(w))
    chain = rng.choices(words, k=200)
    for _ in range(20):  # each like the one before, the ends not alike
        chain = chain[8:] + rng.choices(words, k=8)
        out.append(" ".join(chain))
    rng.shuffle(out)
    return out + ["", None, " \n", "One two", "one TWO", "one two three", out[0].upper()]


def test_stage_matches_brute_force_jaccard(spark):
    """The pipeline's stage: five words, 0.8; most of these pairs differ in more than two bits of their fingerprints."""
    import corpus_pipeline

    rows = list(enumerate(texts()))
    own = classes([t for _, t in rows])
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)
    got = corpus_pipeline.near_duplicates(spark, df, "")
    assert got.columns == df.columns
    assert sorted(r.doc_id for r in got.collect()) == sorted(set(own))


def test_pairs_whose_hubs_are_others(spark):
    """x and y are alike, but each shares more buckets with other sets that it is not alike to."""
    rng = random.Random(6)
    words = [f"v{i}" for i in range(3000)]
    rows = []
    for _ in range(25):
        base = rng.choices(words, k=200)
        for k in range(5):  # a row of texts, each like its neighbours only
            w = list(base)
            for j in range(k):
                w[40 * j : 40 * j + 4] = rng.choices(words, k=4)
            rows += [" ".join(w)] + [" ".join(w[: 150 + 5 * x] + rng.choices(words, k=50 - 5 * x)) for x in range(3)]
    rng.shuffle(rows)
    own = classes(rows)
    got = N.drop_near_copies(spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(rows)], SCHEMA))
    assert sorted(r.doc_id for r in got.collect()) == sorted(set(own)) and len(set(own)) < len(rows) - 50


def test_exactly_four_fifths():
    a = list(range(9))
    assert N.similar(*[N.np.array(x, dtype=N.np.uint64) for x in (a, a[:-1] + [99])]) is (5 * 8 >= 4 * 10)
    assert not N.similar(*[N.np.array(x, dtype=N.np.uint64) for x in (a[:8], a[:7] + [99])])


def test_empty(spark):
    assert N.drop_near_copies(spark.createDataFrame([], SCHEMA)).collect() == []
