import itertools
import random

import pytest
from pyspark.sql import functions as F

from arbora.functions import keys, predicate
from arbora.operators import graphs, groups, integrate, intervals, similarity, statistics
from arbora.streaming import ingest


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_intervals(spark):
    cell = intervals.merge(intervals.parse(F.lit("20-30,1-5,6-9,25-40,x,7-")))
    got = one(spark, intervals.render(cell), intervals.total(cell), intervals.gaps(cell), intervals.sizes(cell), intervals.merge(intervals.parse(F.lit(None).cast("string"))))
    assert got == ("1-9,20-40", 30, [10], [9, 21], [])


@pytest.mark.parametrize("seed", range(3))
def test_merge_forms_agree_with_brute_force(spark, seed):
    rng = random.Random(seed)
    data = [(k, a, a + rng.randrange(8)) for k in range(4) for a in rng.sample(range(60), 9)]
    want = []
    for k in range(4):
        points = sorted(set(itertools.chain.from_iterable(range(a, b + 1) for kk, a, b in data if kk == k)))
        for p in points:
            if want and want[-1][0] == k and want[-1][2] == p - 1:
                want[-1][2] = p
            else:
                want.append([k, p, p])
    df = spark.createDataFrame(data, "k int, a long, b long")
    rows = sorted([r.k, r.a, r.b] for r in intervals.merge_rows(df, "k", "a", "b").collect())
    assert rows == sorted(want)
    cells = df.groupBy("k").agg(intervals.render(intervals.merge(F.collect_list(F.struct(F.col("a").alias("start"), F.col("b").alias("stop"))))).alias("c"))
    assert {r.k: r.c for r in cells.collect()} == {k: ",".join(f"{a}-{b}" for kk, a, b in want if kk == k) for k in range(4)}


def test_ranks_and_summaries(spark):
    df = spark.createDataFrame([("x", v) for v in (10, 20, 20, 30)] + [("y", 7)], "g string, v long")
    assert [r.q for r in statistics.quantile_ranks(df, "v", "q", "g").orderBy("g", "v").collect()] == [0.0, 0.5, 0.5, 1.0, 0.5]
    r = statistics.summary(spark.createDataFrame([("x", v) for v in range(1, 9)] + [("x", None)], "g string, v long"), "v", "g").first()
    assert (r.n, r.p25, r.p75, r["median"]) == (8, 2, 7, 4.5)
    c = statistics.cluster_statistics(spark.createDataFrame([(v,) for v in range(1, 9)], "size long"), total=100).first()
    assert (c.clusters, c.members, c.upper_median, c.singletons, c.coverage) == (8, 36, 5, 1, 36.0)
    z = spark.createDataFrame([("x", 1.0), ("y", 5.0), ("y", 5.0)], "g string, v double").select(statistics.zscore("v", "g").alias("z"))
    assert {r.z for r in z.collect()} == {0.0}


def test_co_clustering_is_exact(spark):
    rng = random.Random(3)
    a, b = [(i, rng.randrange(5)) for i in range(60)], [(i, rng.randrange(4)) for i in range(60)]
    both = sum(a[i][1] == a[j][1] and b[i][1] == b[j][1] for i in range(60) for j in range(i))
    either = sum(a[i][1] == a[j][1] or b[i][1] == b[j][1] for i in range(60) for j in range(i))
    r = statistics.co_clustering(spark.createDataFrame(a, "entity int, cluster int"), spark.createDataFrame(b, "entity int, cluster int")).first()
    assert r.both == both and abs(r.agreement - both / either) < 1e-6


def test_keys(spark):
    ids = [keys.build_id(F.lit(x), F.lit("K_P_C_O_F_G_s_t")) for x in ("G", "G|P", "G/1|T|P", "a|b|T|P-2")]
    assert one(spark, *ids) == ("g_G-t_G-p_G-n_K_P_C_O_F_G_s_t", "g_G-t_P-p_P-n_K_P_C_O_F_G_s_t", "g_G_1-t_T-p_P-n_K_P_C_O_F_G_s_t", "g_a|b-t_T-p_P-2-n_K_P_C_O_F_G_s_t")
    e = F.lit("g_X-y-t_1-p_2-n_K_P_C_O_F_G_s-n_Q")
    assert one(spark, keys.gene_of(e), keys.taxon_of(e), keys.taxon_of(e, last=False)) == ("X", "Q", "K_P_C_O_F_G_s")
    t = F.lit("K_P1_C_O_F_G_s_t")
    assert one(spark, keys.rank_of(t, "phylum"), keys.genus_of(t), keys.species_of(t), keys.short_label(t)) == ("P1", "G", "G_s_t", "C G s t")
    assert one(spark, keys.bare_name(F.lit("C082_Meta_zoa")), keys.bare_name(F.lit("Cx_Y")), keys.after_first_underscore(F.lit("Cx_Y_z"))) == ("Meta_zoa", "Cx_Y", "Y_z")
    assert one(spark, keys.probability_of(F.lit("none")), keys.version_dot(F.lit("NP_006133_1")), keys.residue_percent(F.lit("CCAA"), "C")) == (None, "NP_006133.1", 50.0)
    assert one(spark, keys.mark_unofficial(F.lit("A_B_CUNOFFICIAL_D_E_G_s"), F.lit("A_X_Y_D_E_G_q")), keys.mark_unofficial(F.lit("A_B"), F.lit("X"))) == ("A_BUNOFFICIAL_CUNOFFICIAL_D_E_G_s", "A_B")


def test_predicates_on_missing_values(spark):
    rows = [("5", "abc"), (None, None), ("NA", "-"), ("None", ""), ("x", "b")]
    df = spark.createDataFrame(rows, "n string, t string")

    def passed(column, operator, **k):
        return [bool(r[0]) for r in df.select(predicate.clause(column, operator, df.columns, **k)).collect()]

    assert passed("n", "less_than", value=9) == [True, False, False, False, False]
    assert passed("n", "greater_or_equal", value=5) == [True, False, False, False, False]
    assert passed("n", "between", value=1, value_upper=5) == [True, False, False, False, False]
    assert passed("n", "equals", value="None") == [False, True, False, True, False]
    assert passed("n", "not_equals", value="5") == [False, True, True, True, True]
    assert passed("t", "contains", value="b") == [True, False, False, False, True]
    assert passed("t", "not_contains", value="b") == [False, True, True, True, False]
    assert passed("t", "in_set", values=["b", ""]) == [False, False, False, False, True]
    assert passed("t", "contains_all", values=["a", "c"]) == [True, False, False, False, False]
    assert passed("t", "contains_any", values=["z", "c"]) == [True, False, False, False, False]
    assert passed("nowhere", "not_equals", value="1") == [False] * 5
    for bad in ({"filters": [{"clauses": []}]}, {"filters": [{"combine_clauses": "at_least_k", "clauses": [{"column": "n", "operator": "equals", "value": 1}]}]}, {"filters": [{"clauses": [{"column": "n", "operator": "like"}]}]}):
        with pytest.raises(ValueError):
            predicate.compile_manifest(bad, df.columns)


def test_optimal_assignment_matches_brute_force(spark):
    rng = random.Random(5)
    data = [(blk, f"a{i}", f"b{j}", float(rng.randrange(100))) for blk in range(4) for i in range(4) for j in range(5) if rng.random() < 0.8]
    got = {}
    for r in similarity.optimal_assignment(spark.createDataFrame(data, "block int, a string, b string, score double"), "block", "a", "b", "score").collect():
        got[r.block] = got.get(r.block, 0) + r.score
    for blk in range(4):
        s = {(a, b): v for k, a, b, v in data if k == blk}
        best = max(sum(s.get((f"a{i}", f"b{p[i]}"), 0) for i in range(4)) for p in itertools.permutations(range(5), 4))
        assert got[blk] == best


def test_seed_mapping_cascade(spark):
    seeds = spark.createDataFrame([("s1", "x1"), ("s2", None), ("s3", None), ("s4", None), ("s5", None)], "seed string, accession string")
    accessions = spark.createDataFrame([("x1", "t1")], "accession string, target string")
    hits = [("s2", "t2", 99.0, 5.0), ("s3", "t3", 99.0, 9.0), ("s3", "t4", 99.0, 1.0), ("s4", "t3", 99.0, 8.0), ("s4", "t4", 99.0, 7.0), ("s5", "t9", 50.0, 1.0), ("s5", "t1", 99.0, 1.0)]
    df = spark.createDataFrame([(a, b, i, 99.0, 99.0, 10, 10, s) for a, b, i, s in hits], "seed string, target string, identity double, qcov double, scov double, seed_length int, target_length int, score double")
    got = {r.seed: (r.target, r.status) for r in similarity.seed_mapping(seeds, accessions, df).collect()}
    assert got == {"s1": ("t1", "ACCESSION"), "s2": ("t2", "UNIQUE"), "s3": ("t3", "ASSIGNED"), "s4": ("t4", "ASSIGNED"), "s5": (None, "NOT_FOUND")}


def test_components_of_long_chains(spark):
    ids = list(range(200))
    random.Random(6).shuffle(ids)
    edges = [(ids[i], ids[i + 1]) for i in range(149)] + [(ids[i], ids[i + 1]) for i in range(150, 199)] + [(ids[0], ids[0]), (None, 3)]
    got = {r.node: r.comp for r in graphs.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in ids[:150]} == {min(ids[:150])} and {got[i] for i in ids[150:]} == {min(ids[150:])}
    assert graphs.components(spark.createDataFrame([], "a long, b long")).isEmpty()


def test_hotspots_chain_and_duplicates(spark):
    genes = [("sp", f"g{i}", "c1", 10 * i, 10 * i + 5) for i in range(40)] + [("sp", "g1", "c2", 1, 2), ("sp", "lone", "c3", 1, 2)]
    df = spark.createDataFrame(genes, "species string, gene string, chromosome string, start long, stop long")
    hits = spark.createDataFrame([("sp", "g1", "g11"), ("sp", "g11", "g21"), ("sp", "g30", "g39"), ("sp", "g5", "g30"), ("sp", "g2", "nowhere")], "species string, query string, subject string")
    got = similarity.hotspots(hits, df, window=20).orderBy("hotspot_id").collect()
    # g1 is kept where it starts first, on the second chromosome, so the chain loses it
    assert [(r.hotspot_id, r.gene_ids) for r in got] == [("sp_w20_00001", "g11,g21"), ("sp_w20_00002", "g30,g39")]
    with pytest.raises(ValueError):
        similarity.hotspots(hits, df, least=1)


def test_adapters_and_sequences(spark):
    rows = spark.createDataFrame([("p1", "3-9,12-20"), ("p2", "")], "entity string, helices string")
    assert sorted((r.entity, r.start, r.stop, r.positional) for r in groups.annotations_of("tmbed", rows).collect()) == [("p1", 3, 9, True), ("p1", 12, 20, True)]
    terms = spark.createDataFrame([("GO:1", "one", "process")], "go_id string, go_name string, go_namespace string")
    go = groups.annotations_of("go", spark.createDataFrame([("p1", "GO:1(A)|GO:2(B)")], "entity string, terms string"), allowed=("A",), terms=terms)
    assert [(r.code, r.definition, r.category) for r in go.collect()] == [("GO:1", "one", "process")]
    ann = groups.from_rows(spark, [("e", "B", 5, 9, 0, True), ("e", "A", 1, 3, 0, True), ("e", "B", 1, 3, 1, True), ("e", "Z", None, None, 0, False)])
    assert groups.by_sequence(ann).first().group_key == "A,B,B" and groups.by_set(ann).first().group_key == "A,B,Z"
    with pytest.raises(ValueError):
        groups.adapter("go", False)(lambda: None)


def test_numbering_over_ranges(spark, monkeypatch):
    from arbora.operators import skew

    monkeypatch.setattr(skew, "NUMBER_ROWS", 7)
    data = random.Random(8).sample(range(1000), 60)
    got = {r.v: r.k for r in skew.numbered_rows(spark.createDataFrame([(v,) for v in data], "v long"), "k", "v").collect()}
    assert got == {v: k for k, v in enumerate(sorted(data))}
    split = similarity.deal(spark.createDataFrame([(v,) for v in data], "v long"), 7, "v")
    assert [r.n for r in split.groupBy("part").agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()] == [9] * 4 + [8] * 3
    assert skew.numbered_rows(spark.createDataFrame([], "v long"), "k", "v").isEmpty()


def test_lookup_with_hot_missing_and_null_keys(spark, monkeypatch):
    from arbora.operators import skew

    left = [("hot", i) for i in range(50)] + [("lacking", i) for i in range(40)] + [("cold", 1), ("none", 2), (None, 3)]
    df, right = spark.createDataFrame(left, "k string, v int"), spark.createDataFrame([("hot", "h"), ("cold", "c")], "k string, w string")
    want = sorted(((k, v, {"hot": "h", "cold": "c"}.get(k)) for k, v in left), key=str)
    for least in (1, 10, 10**6):
        monkeypatch.setattr(skew, "HOT_LEAST", least)
        assert sorted((tuple(r) for r in skew.lookup(df, right, "k", 100).collect()), key=str) == want


def test_strict_joins(spark):
    left = spark.createDataFrame([(1,), (2,)], "k long")
    right = spark.createDataFrame([(1, "a")], "k long, v string")
    with pytest.raises(Exception, match="unresolved key"):
        integrate.require_all(left, right, ["k"], "key").collect()
    assert integrate.resolved_or_null(left, right, ["k"])[1].first().unresolved == 1


def test_streams(spark, tmp_path):
    path, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    schema = "feature string, tip string"
    for batch in ([("a", "x"), ("a", "x"), ("b", "y")], [("a", "x"), ("c", "z")]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(path)
        ingest.upsert_presence(spark.readStream.schema(schema).parquet(path), out, state).awaitTermination()
    assert sorted((r.feature, r.tip) for r in spark.read.parquet(out).collect()) == [("a", "x"), ("b", "y"), ("c", "z")]
    timed = spark.createDataFrame([("a", "x", "2024-01-01 00:00:00"), ("a", "x", "2024-01-01 00:10:00")], "f string, t string, at string").withColumn("at", F.col("at").cast("timestamp"))
    timed.coalesce(1).write.parquet(str(tmp_path / "timed"))
    stream = spark.readStream.schema(timed.schema).parquet(str(tmp_path / "timed"))
    ingest.sink_presence(ingest.new_memberships(stream, "f", "t", "at"), str(tmp_path / "p"), str(tmp_path / "ps")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "p")).count() == 1
