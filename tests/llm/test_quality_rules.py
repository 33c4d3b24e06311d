import math
import random
import re

from arbora.llm import quality_rules as Q

SCHEMA = "doc_id long, text string, lang string, quality string"


def brute(text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(i, i + 8)}
    n, rep = len(words), len(covered)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), rep, n < 20 or 100 * rep > 30 * n)


def test_counts_match_brute_force(spark):
    rng = random.Random(4)
    texts = [None, "", " \n\t", "a", "é ü x # $", "x\n\nx\n \nx y\nx y", "w " * 500, "a b c d e f g h " * 2 + "z", "a b c d e f g h a b c d e f g h a b"]
    texts += [" ".join(rng.choices("abc", k=rng.randint(1, 90))) for _ in range(60)]
    texts += ["\n".join(" ".join(rng.choices(["p#", "q", "R!"], k=4)) for _ in range(30)), "one\x0btwo\x0cthree\r\nfour" * 3]
    df = spark.createDataFrame([(i, t, "en", None) for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: r for r in Q.measured(df).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(t), t


def test_binomial_tail(spark):
    cases = [(50, 0), (200, 3), (1000, 5), (5000, 40), (100000, 800), (10, 9)]
    df = spark.createDataFrame(cases, "n long, k long")
    for r in df.select("n", "k", Q.binomial_tail(Q.F.col("n"), Q.F.col("k"), 0.01).alias("p")).collect():
        terms = [math.lgamma(r.n + 1) - math.lgamma(i + 1) - math.lgamma(r.n - i + 1) + i * math.log(0.01) + (r.n - i) * math.log(0.99) for i in range(r.k + 1)]
        want = max(terms) + math.log(sum(math.exp(t - max(terms)) for t in terms))
        assert r.p == 0.0 if r.k > r.n * 0.01 else abs(r.p - want) < 1e-6 * abs(want)


def test_certified_cutoffs_reject_junk_only(spark):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(6000):
        bad = i % 10 == 0
        words = ["w%d" % rng.randrange(10**6) + ("###" if bad else "") for _ in range(25)]
        rows.append((i, " ".join(words), "xx" if i % 50 == 1 else "en" if i % 3 else None, "clash"))
        labels.append((i, 0 if bad else 1))
    labels += [(0, 0), (None, 1), (3, None)]
    docs, labels = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int")
    got = {r.doc_id: r for r in Q.quality_verdicts(docs, labels).collect()}
    assert len(got) == 6000
    for i, _, lang, _ in rows:
        assert got[i].kept == (i % 10 != 0 or lang == "xx"), got[i]
    assert all("symbols" in r.rejected_by for r in got.values() if not r.kept)
    # the same verdicts from SQL, here with cutoffs that are certified
    import duckdb

    c = duckdb.connect()
    for name, df in (("documents", docs), ("labels", labels)):
        c.register(name, df.toPandas())
    want = {r[0]: (r[1], r[2], r[3]) for r in c.sql(f"SELECT doc_id, base_failed, kept, rejected_by FROM ({Q.oracle_sql()})").fetchall()}
    assert want == {i: (r.base_failed, r.kept, r.rejected_by) for i, r in got.items()}
    assert sum(not r.kept and not r.base_failed for r in got.values()) > 400
    # too few labels certify nothing
    few = Q.quality_verdicts(docs, labels.limit(20))
    assert few.where("not kept").isEmpty()
    assert Q.quality_verdicts(docs.limit(0), labels).isEmpty()
    assert Q.quality_verdicts(docs, labels.limit(0)).where("not kept").isEmpty()
    twice = docs.limit(3).unionByName(docs.limit(3)).unionByName(spark.createDataFrame([(None, None, None, None)], SCHEMA))
    assert Q.quality_verdicts(twice, labels).count() == 7


def test_very_long_text(spark):
    text = "many words of a long text " * 60_000
    r = Q.measured(spark.createDataFrame([(1, text, "en", None)], SCHEMA)).first()
    assert (r.n_words, r.n_repeat_words, r.word_chars) == (360_000, 360_000, len(text.replace(" ", "")))
