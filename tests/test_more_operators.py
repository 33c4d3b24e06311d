import difflib
import itertools
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from arbora.operators import integrate, similarity, statistics
from arbora.operators import trees as T
from arbora.plans import queries, sinks
from arbora.sources import sequences, tables


def test_search_on_a_grid_of_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(similarity, "GRID_ROWS", 7)
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(60)] + [(60, [0.0] * 6)]
    df = spark.createDataFrame(rows, "k long, v array<double>")
    got = {(r.query, r.subject): r.cosine for r in similarity.similar_to(df.where("k % 5 = 0"), df, "k", "v", 0.3).collect()}
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=True))
    want = {}
    for (i, a), (j, b) in itertools.product(rows[:60:5], rows[:60]):
        c = dot(a, b) / (dot(a, a) * dot(b, b)) ** 0.5
        if i != j and c >= 0.3:
            want[i, j] = c
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in want)
    assert similarity.similar_to(df.limit(0), df, "k", "v", 0.3).collect() == []


def test_search_holds_its_least_against_rounded_cosines(spark):
    rows = [(0, [1.0, 0.0])] + [(i, [c, (1 - c * c) ** 0.5]) for i, c in enumerate([0.0999994, 0.0999997, 0.1000004], start=1)]
    df = spark.createDataFrame(rows, "k long, v array<double>")
    got = similarity.similar_to(df.where("k = 0"), df, "k", "v", 0.1).collect()
    assert sorted((r.subject, r.cosine) for r in got) == [(2, 0.1), (3, 0.1)]


def test_suggestions_are_those_of_difflib(spark):
    rng = random.Random(2)
    known = sorted({"".join(rng.choices("ABCD12", k=rng.randint(2, 7))) for _ in range(150)})
    missing = ["ABC1", "D2", "A1B2C", "zzz"]
    got = integrate.suggestions(spark.createDataFrame([(n,) for n in [*missing, None, "D2"]], "name string"), spark.createDataFrame([(n,) for n in known], "name string"))
    by = {}
    for r in got.orderBy("name", "rank").collect():
        by.setdefault(r.name, []).append(r.suggestion)
    for name in missing:
        scored = []
        for s in known:
            inside = name.lower() in s.lower()
            ratio = 1.0 if inside else difflib.SequenceMatcher(None, name.lower(), s.lower(), autojunk=False).ratio()
            if inside or ratio >= 0.6:
                scored.append((not inside, -ratio, s))
        assert by.get(name, []) == [s for *_, s in sorted(scored)[:5]]


def test_composite_keys_make_no_pairs(spark, tmp_path):
    keys = [100 * i for i in range(400)]
    parts = [(k, f"b{k}") for k in keys] + [(0, "again"), (0, "b0"), (0, None), (None, "none"), (-7, "minus"), (7, "plus")]
    suppliers = [(k, f"s{k}") for k in keys] + [(100, "again"), (100, "s100"), (None, "none"), (-107, "minus")]
    lines = [(i, 1, p, q) for i, (p, q) in enumerate([(0, 100), (0, 100), (500, 300), (-7, -107), (7, -107), (None, 0), (0, None), (None, None), (100, 5), (1, 101)])]
    spark.createDataFrame(parts, "p_partkey long, p_brand string").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame(suppliers, "s_suppkey long, s_name string").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    duck = duckdb.connect()
    for t in ("part", "supplier", "lineitem"):
        duck.sql(f"create view {t} as select * from '{tmp_path}/{t}.parquet/*.parquet'")
    got = queries.QUERIES["composite_key_join"](spark, str(tmp_path))
    want = duck.sql(queries.SQL["composite_key_join"])
    order = sorted(want.columns)
    at = lambda names, rows: sorted(repr([r[list(names).index(c)] for c in order]) for r in rows)
    assert at(got.columns, got.collect()) == at(want.columns, want.fetchall())

    def most(node):
        """Rows of the plan's largest step."""
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec" or kind.endswith("QueryStageExec"):
            return most(node.executedPlan() if kind == "AdaptiveSparkPlanExec" else node.plan())
        rows = node.metrics().get("numOutputRows")
        below = node.children()
        return max([rows.get().value() if rows.isDefined() else 0, *(most(below.apply(i)) for i in range(below.size()))])

    assert 0 < most(got._jdf.queryExecution().executedPlan()) <= len(parts)


def test_wide_base_wants_one_row_a_key(spark):
    base = spark.createDataFrame([(1,), (2,)], "k long")
    got = integrate.wide_base(base, "k", {"a": spark.createDataFrame([(1, "x")], "k long, v string")})
    assert sorted(map(tuple, got.collect())) == [(1, "x", True), (2, None, False)]
    with pytest.raises(Exception, match="repeats a key"):
        integrate.wide_base(base, "k", {"a": spark.createDataFrame([(1, "x"), (1, "y")], "k long, v string")}).collect()


def test_seeds_are_assigned_by_components(spark):
    rng = random.Random(3)
    hits, want = [], {}
    for b in range(6):
        n = 3
        score = [[rng.randint(1, 99) for _ in range(n)] for _ in range(n)]
        hits += [(f"s{b}{i}", f"t{b}{j}", 99.0, 100.0, 100.0, 1, 1, score[i][j]) for i in range(n) for j in range(n)]
        want[b] = max(sum(score[i][p[i]] for i in range(n)) for p in itertools.permutations(range(n)))
    seeds = spark.createDataFrame([(f"s{b}{i}", None) for b in range(6) for i in range(3)] + [("lost", None)], "seed string, accession int")
    hits = spark.createDataFrame(hits, "seed string, target string, identity double, qcov double, scov double, seed_length int, target_length int, score int")
    got = similarity.seed_mapping(seeds, spark.createDataFrame([], "accession int, target string"), hits)
    assert got.where("seed = 'lost'").first().status == "NOT_FOUND"
    sums = got.join(hits, ["seed", "target"]).groupBy(F.substring("seed", 2, 1).cast("int").alias("b")).agg(F.sum("score").alias("s"), F.count(F.lit(1)).alias("n")).collect()
    assert {r.b: (r.s, r.n) for r in sums} == {b: (s, 3) for b, s in want.items()}


def test_clustering_metrics_by_hand(spark):
    rows = [("g1", "a", 1), ("g1", "b", 2), ("g1", "c", 3), ("g2", "a", 4), ("g2", "a", 5), ("g2", "b", 6), ("g3", "c", 7), ("g4", "a", 8), ("g4", "b", 9)]
    tips = spark.createDataFrame([("a", "P"), ("b", "P"), ("c", "Q")], "tip string, phylum string")
    got = {r.metric: r.value for r in statistics.clustering_metrics(spark.createDataFrame(rows, "cluster string, tip string, entity long"), tips).collect()}
    assert len(got) == 33
    expect = {"tips": 3, "clusters": 4, "members": 9, "singletons": 1, "singleton_percent": 25.0, "multi_member": 3, "one_copy_one_tip": 1, "one_copy_several_tips": 2, "one_copy_all_tips": 1, "one_copy_in_50_percent": 3, "one_copy_in_75_percent": 2}
    expect |= {"complete_all": 1, "complete_half_plus": 3, "size_greatest": 3, "size_mean": 2.25, "size_median": 2.5, "size_2_to_10": 3, "phyla_mean": 1.33, "phyla_median": 1, "phyla_greatest": 2, "phyla_one": 2, "tip_mean_copies_1": 2, "tip_mean_copies_2": 0}
    assert {k: got[k] for k in expect} == expect
    none = statistics.clustering_metrics(spark.createDataFrame([], "cluster string, tip string, entity long"), tips)
    assert none.where("metric <> 'tips' and value <> 0").isEmpty() and none.count() == 33


def test_assembly_and_membranes(spark):
    rows = spark.createDataFrame([("x", "ACGTNNGG"), ("x", "nnnA"), ("y", "")], "a string, s string")
    got = {r.a: r for r in statistics.assembly(rows, "a", "s").collect()}
    assert (got["x"].n, got["x"].total, got["x"].n50, got["x"].gc_percent, got["x"].n_percent, got["x"].gaps) == (2, 12, 8, 57.14, 41.67, 2)
    assert got["y"].gc_percent is None and got["y"].gaps == 0
    chains = spark.createDataFrame([("p", "SSSiiHHHoohhhi"), ("q", "iiii"), ("r", "ooBBo")], "e string, t string")
    assert sorted(tuple(r) for r in statistics.membrane_counts(chains, "e", "t").collect()) == [("p", 2, True, "multi_signal"), ("q", 0, False, "none"), ("r", 1, False, "single")]


def test_polytomies_and_names():
    taxa = {f"s{i}": ["k", "p"] for i in range(9)}
    plain, one, two = T.taxonomy_tree(taxa), T.taxonomy_tree(taxa, 1), T.taxonomy_tree(taxa, 2)
    assert T.canonical(one) == T.canonical(T.taxonomy_tree(taxa, 1)) and len({T.canonical(t) for t in (plain, one, two)}) == 3
    assert all(len(n.children) in (0, 2) for t in (plain, one, two) for n in t.walk()) and sorted(n.name for n in two.leaves()) == sorted(taxa)
    assert T.name_map(["a b", "c.d"]) == {"a b": "a_b", "c.d": "c_d"}
    with pytest.raises(T.TreeError):
        T.name_map(["a b", "a.b"])
    tree = T.parse_newick("(('a b','it''s')x,c)r;")
    assert T.canonical(T.parse_newick(T.to_newick(tree))) == T.canonical(tree)


def test_files_that_are_not_what_they_should_be(spark, tmp_path):
    (tmp_path / "c").write_text("files: a b\nG: 1 2\n")
    (tmp_path / "n").write_text("nothing here\n")
    assert tables.clustering_format(spark, str(tmp_path / "c")) == "counts"
    with pytest.raises(ValueError, match="counts"):
        tables.read_clustering(spark, str(tmp_path / "c"))
    with pytest.raises(ValueError, match="no clustering"):
        tables.clustering_format(spark, str(tmp_path / "n"))
    with pytest.raises(ValueError, match="over 2 rows"):
        sinks.markdown(spark.range(3), "T", most=2)
    rows = spark.createDataFrame([("a", "Gene With Protein Product "), ("b", "pseudogene"), ("c", None)], "g string, t string")
    assert [r.g for r in sequences.of_locus_types(rows, "t", ("gene with protein product",)).collect()] == ["a"]
