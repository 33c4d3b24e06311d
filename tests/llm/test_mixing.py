import random
from collections import defaultdict

import pytest

from arbora.llm import mixing as M

SCHEMA = "doc_id long, text string, source string, lang string, weight string, topic int"


def rows(n=3000):
    rng = random.Random(18)
    out = []
    for i in range(n):
        text = " ".join(["word"] * rng.choice([10, 200, 1500])) + rng.choice(["", " | x", " License", "&&&"])
        out.append((i, text, "s0" if rng.random() < 0.6 else f"s{rng.randint(1, 6)}", rng.choice(["en", "en", "de", None]), "clash", 1))
    return out + [(n, None, None, None, "", 0), (n + 1, "", "s9", "en", "", 0), (None, "no id", "s0", "en", "", 0), (5, "again", "s0", "de", "", 0)]


def test_weights_meet_all_margins_and_probabilities_the_budget(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    got = M.mixture(df).collect()
    assert len(got) == len(rows())
    cells = {(r.source, r.lang, r.topic): r for r in got}
    tokens = defaultdict(int)
    for r in got:
        tokens[r.source, r.lang, r.topic] += r.tokens
    for k, margin in enumerate(M.MARGINS):
        mass, have = defaultdict(int), defaultdict(float)
        for c, t in tokens.items():
            mass[c[k]] += t
            have[c[k]] += cells[c].weight
        total = sum(v ** M.TEMPER[margin] for v in mass.values())
        for v in mass:
            assert have[v] == pytest.approx(mass[v] ** M.TEMPER[margin] / total, rel=1e-6, abs=1e-6)
    everything = sum(tokens.values())
    assert sum(t * cells[c].probability for c, t in tokens.items()) == pytest.approx(M.KEEP * everything, rel=1e-6)
    kept = sum(r.tokens for r in got if r.selected)
    assert kept == pytest.approx(M.KEEP * everything, rel=0.08)
    chosen = M.sample(df)
    assert chosen.columns == df.columns and chosen.count() == sum(r.selected for r in got)


def test_explicit_targets_and_edges(spark):
    df = spark.createDataFrame(rows(400), SCHEMA)
    cells = M.probabilities(df, {"lang": {"en": 3.0, "de": 1.0}}).collect()
    share = defaultdict(float)
    for c in cells:
        share[c.lang] += c.weight
    assert share["(none)"] == 0 and share["en"] == pytest.approx(0.75, abs=1e-8) and all(c.probability == 0 for c in cells if c.lang == "(none)")
    assert M.mixture(df.limit(0)).collect() == []
    one = M.mixture(spark.createDataFrame([(1, "x", "s", "en", "", 0)], SCHEMA), keep=1.0).collect()
    assert one[0].probability == 1.0 and one[0].selected


def test_topics_are_a_parameter(spark):
    df = spark.createDataFrame(rows(400), SCHEMA)
    topics = [("licensed", "contains(text, 'License')"), ("blank", "length(text) = 0")]
    got = {r.doc_id: r.topic for r in M.mixture(df, topics=topics).collect()}
    assert set(got.values()) == {"licensed", "blank", M.OTHER} and got[401] == "blank"
    assert M.sample(df, topics=topics).columns == df.columns
    long = M.mixture(spark.createDataFrame([(1, "x y " * 500_000, "s", "en", "", 0)], SCHEMA), topics=[("never", "text is null")]).collect()
    assert long[0].tokens == 500_000 and long[0].topic == M.OTHER
