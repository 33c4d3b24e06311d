import gzip
import json

import pytest
from pyspark.sql import functions as F

from arbora.operators import trees as T
from arbora.plans import sinks
from arbora.sources import sequences, tables
from arbora.sources import trees as tree_source


@pytest.fixture
def write(tmp_path):
    def put(name, text):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        if name.endswith(".gz"):
            path.write_bytes(gzip.compress(text.encode()))
        else:
            path.write_text(text)
        return str(path)

    return put


def tuples(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_self_documenting_tsv_round_trip(spark, write, tmp_path):
    path = write("a.tsv", "Id (the key)\tSize (how large)\tNote\nx\t3\tNA\ny\t\tok, fine\n")
    df = tables.read_tsv(spark, path, {"Size": "long"}, nulls=("NA",), required=("Id",))
    assert tuples(df, "Id") == [("x", 3, None), ("y", None, "ok, fine")]
    assert df.schema["Size"].metadata["comment"] == "how large"
    out = str(tmp_path / "out")
    sinks.write_tsv(df, out, ["Id"])
    again = tables.read_tsv(spark, out, {"Size": "long"})
    assert tuples(again, "Id") == [("x", 3, None), ("y", None, "ok, fine")] and again.schema["Size"].metadata["comment"] == "how large"
    with pytest.raises(ValueError, match="Lacking"):
        tables.read_tsv(spark, path, required=("Lacking",))
    assert tables.read_tsv(spark, write("b.tsv.gz", "K\tV\n1\t2\n")).collect()[0].K == "1"


def test_memberships_and_matrices(spark, write):
    got = tables.read_memberships(spark, write("m", "# note\nG1\ta\tb\n\nG2\tc\t\n"))
    assert tuples(got, "grp", "ordinal") == [("G1", "a", 0), ("G1", "b", 1), ("G2", "c", 0)]
    got = tables.read_count_matrix(spark, write("c", "files: a.pep b.pep\nG0: 1 0\nG1:  3   4\n"))
    assert tuples(got, "grp", "column") == [("G0", "a.pep", 1), ("G0", "b.pep", 0), ("G1", "a.pep", 3), ("G1", "b.pep", 4)]
    with pytest.raises(ValueError):
        tables.read_count_matrix(spark, write("d", "G0: 1\n"))
    got = tables.read_species_matrix(spark, write("s", "G\tsp1\tsp2\nG1\ta, b\t\nG2\t\tc\n"), write("u", "G\tsp1\tsp2\nG9\td\t\n"))
    assert tuples(got, "grp", "member") == [("G1", "sp1", "a"), ("G1", "sp1", "b"), ("G2", "sp2", "c"), ("G9", "sp1", "d")]


def test_hits_and_domains(spark, write):
    row = "g1\tg2\t99.5\t300\t0\t0\t1\t300\t1\t300\t1e-200\t650"
    r = tables.read_hits(spark, write("h", row + "\n")).first()
    assert r.evalue == 1e-200 and r.evalue_text == "1e-200" and r.length == 300
    path = write("bad", row + "\nshort\trow\n")
    assert tables.read_hits(spark, path, strict=False).count() == 1
    with pytest.raises(Exception, match=r"(?i)malformed|MALFORMED"):
        tables.read_hits(spark, path).collect()
    assert tables.read_hits(spark, write("t", row + "\tprotein [X y]\n"), titled=True).first().stitle == "protein [X y]"
    lines = "p1\tm\t100\tPfam\tPF1\tdomain one\t3\t50\t1e-5\tT\td\tIPR1\tx\tGO:1(PANTHER)|GO:2\t-\np2\tm\t90\tSMART\tSM1\t-\t1\t9\t-\tT\td\nshort\n"
    domains = tables.read_domains(spark, write("i", lines))
    assert tuples(tables.databases_of(domains), "database") == [("Pfam",), ("SMART",)]
    facts = tables.long_facts(domains, F.lit("tx"))
    assert tuples(facts.select("entity", "database", "accession", "details"), "database", "accession") == [("p1", "go", "GO:1", None), ("p1", "go", "GO:2", None), ("p1", "pfam", "PF1", "domain one"), ("p2", "smart", "SM1", None)]


GFF = """##gff-version 3
c1\ts\tgene\t10\t100\t.\t+\t.\tID=gene-A;gene=A
c1\ts\tmRNA\t10\t100\t.\t+\t.\tID=A.t1;Parent=gene-A
c1\ts\texon\t10\t40\t.\t+\t.\tParent=A.t1
c1\ts\texon\t60\t100\t.\t+\t.\tParent=A.t1
c1\ts\tCDS\t20\t40\t.\t+\t0\tParent=A.t1
c1\ts\tmRNA\t10\t90\t.\t+\t.\tID=A.t2;Parent=gene-A
c1\ts\tCDS\t20\t30\t.\t+\t0\tParent=A.t2
c1\ts\tgene\t200\t300\t.\t-\t.\tID=gene-B
bad line
"""


def test_gff(spark, write):
    features = tables.read_gff(spark, write("x.gff", GFF))
    assert tuples(tables.genes_of(features), "gene") == [("A", "c1", 10, 100, "+"), ("B", "c1", 200, 300, "-")]
    model = tables.gene_models(features).collect()
    assert [(m.gene, m.exons, m.cds) for m in model] == [("A", "10-40,60-100", "20-40")]
    other = "c2\ta\ttranscript\t5\t9\t.\t-\t.\tID=g7.t1\nc2\ta\ttranscript\t1\t8\t.\t+\t.\tID=g7.t2\n"
    assert tuples(tables.genes_of(tables.read_gff(spark, write("y.gff", other))), "gene") == [("g7", "c2", 1, 9, "-")]


def test_fasta_both_ways(spark, write, tmp_path):
    text = ">g_A-t_1-p_1-n_M_C_x\nMKV\nLL\n>g_B-t_1-p_1-n_M_C_x\nMM\n\n>empty\n"
    path = write("fa/one.fa", text)
    write("fa/two.fa.gz", ">z\nAC\nGT\n")
    got = sequences.read_fasta(spark, path)
    assert tuples(got, "header") == [("empty", ""), ("g_A-t_1-p_1-n_M_C_x", "MKVLL"), ("g_B-t_1-p_1-n_M_C_x", "MM")]
    sequences.register(spark)
    got = spark.read.format("fasta").load(str(tmp_path / "fa"))
    assert tuples(got, "file", "ordinal") == [("one.fa", 0, "g_A-t_1-p_1-n_M_C_x", "MKVLL"), ("one.fa", 1, "g_B-t_1-p_1-n_M_C_x", "MM"), ("one.fa", 2, "empty", ""), ("two.fa.gz", 0, "z", "ACGT")]
    table = sequences.sequence_table(got.where("file = 'one.fa' and ordinal < 2"))
    assert tuples(table.select("taxon", "length"), "length") == [("M_C_x", 2), ("M_C_x", 5)]
    out = str(tmp_path / "w")
    sinks.write_fasta(got.where("sequence <> ''"), out, F.col("header"), F.col("sequence"))
    assert sequences.read_fasta(spark, out).count() == 3


def test_lookups_and_manifests(spark, write, tmp_path):
    obo = "format-version: 1.2\n\n[Term]\nid: GO:1\nname: one\nnamespace: process\n\n[Term]\nid: GO:2\nname: two\nnamespace: function\nis_obsolete: true\n\n[Typedef]\nid: part_of\n"
    assert tuples(tables.read_obo(spark, write("go.obo", obo)), "go_id") == [("GO:1", "one", "process", False), ("GO:2", "two", "function", True)]
    dump = "1\t|\troot\t|\t\t|\n2\t|\tX y\t|\tP\t|\n"
    assert tuples(tables.read_lineages(spark, write("r.dmp", dump), ("id", "name", "phylum")), "id") == [("1", "root", None), ("2", "X y", "P")]
    assert tables.read_manifest(spark, write("man", "# c\na\tb\n\nc\td\n"), names=("x", "y")).count() == 2
    csv = tables.read_csv_with(spark, write("d.csv", "ACC,Localizations,Nucleus\nq1,Nucleus,0.9\n"), {"entity": ("Protein_ID", "ACC")})
    assert tuples(tables.probabilities(csv, "entity", ["Nucleus"]), "entity") == [("q1", "Nucleus", 0.9)]
    with pytest.raises(ValueError):
        tables.read_csv_with(spark, write("e.csv", "A\n1\n"), {"entity": ("B",)})
    cells = spark.createDataFrame([("p", "a,b", "1,2"), ("q", "", "")], "k string, ids string, es string")
    assert tuples(tables.parallel_cells(cells, "k", {"id": "ids", "e": "es"}), "id") == [("p", "a", "1"), ("p", "b", "2")]
    write("per/Homo_sapiens-x.tsv", "v\n1\n")
    write("per/Mus_mus-x.tsv", "v\n2\n")
    got = tables.read_per_file(spark, str(tmp_path / "per/*.tsv"), r"^(.*)-x\.tsv$", "v long")
    assert tuples(got, "v") == [(1, "Homo_sapiens"), (2, "Mus_mus")]
    write("j/a.json", json.dumps({"step": 1}))
    assert tables.read_json_fragments(spark, str(tmp_path / "j")).first().step == 1


def test_tree_files_and_other_sinks(spark, write, tmp_path):
    trees = tree_source.read_newick(spark, write("t.nwk", "((a,b)x,c)r;\n(a,(b,c)y)r;\n"))
    assert [T.canonical(t) for t in trees] == ["((a,b),c)", "((b,c),a)"]
    edges = T.tables(spark, [("1", trees[0])])["edges"]
    assert T.canonical(tree_source.from_edge_table(edges)[0][1]) == "((a,b),c)"
    df = spark.createDataFrame([("x", "p", 1), ("x", "q", 2), ("y", "p", 3)], "r string, c string, v long")
    assert tuples(sinks.wide(df, "r", "c", ["p", "q", "z"], F.sum("v")), "r") == [("x", 1, 2, None), ("y", 3, None, None)]
    sinks.write_by_group(df, str(tmp_path / "g"), "r")
    assert spark.read.parquet(str(tmp_path / "g")).where("r = 'x'").count() == 2
    quoted = spark.createDataFrame([("a", ">h\nSEQ, \"x\"")], "k string, cell string")
    sinks.write_quoted(quoted, str(tmp_path / "q"))
    assert spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(tmp_path / "q")).first().cell == ">h\nSEQ, \"x\""
    seen_df, seen = sinks.observed(df, "run", rows=F.count(F.lit(1)), top=F.max("v"))
    seen_df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 3, "top": 3}
    assert sinks.markdown(df.limit(1), "T").splitlines()[0] == "# T"
    sinks.publish(df, "arbora_published")
    assert spark.table("arbora_published").count() == 3
    assert sinks.write_newick(trees[0], "structure") == "((a,b),c);"
