"""Queries that write tables in each file format and read them back: sources and sinks against SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arbora.operators import trees as T
from arbora.operators.skew import new_path
from arbora.plans import sinks
from arbora.plans.q_history import ALL
from arbora.plans.world import REGIONS, Query, sql, table, topologies
from arbora.sources import sequences, tables
from arbora.sources import trees as tree_source

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, oracle: str):
    def register(fn: Query) -> Query:
        QUERIES[name], SQL[name] = fn, oracle
        return fn

    return register


def lines(df: DataFrame, *cells: str, sep: str = "\t", compression: str = "none") -> str:
    """Writes a line of text a row; returns the folder."""
    path = new_path(df.sparkSession, "lines")
    values = [F.coalesce(F.expr(c).cast("string"), F.lit("")) for c in cells]
    df.select(F.concat_ws(sep, *values).alias("value")).write.option("compression", compression).text(path)
    return path


@query("tsv_file", "SELECT p_partkey, p_name, CASE WHEN p_size > 10 THEN p_size::BIGINT END AS p_size FROM part")
def tsv_file(spark, sf):
    """Self-documenting TSV: headers with prose, types, nulls."""
    path, size = new_path(spark, "tsv"), F.when(F.col("p_size") > 10, F.col("p_size"))
    sinks.write_tsv(table(spark, sf, "part").select("p_partkey", "p_name", size.alias("p_size")), path, ["p_partkey"], {"p_size": "sizes over ten"}, single=False)
    back = tables.read_tsv(spark, path, {"p_partkey": "long", "p_size": "long"}, required=("p_name",))
    if back.schema["p_size"].metadata.get("comment") != "sizes over ten":
        raise ValueError("the prose of a header is lost")
    return back


@query("gzip_file", "SELECT s_suppkey::VARCHAR AS s_suppkey, s_name FROM supplier")
def gzip_file(spark, sf):
    """A gzipped TSV, its header in the first line of its one file."""
    rows = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("s_suppkey"), "s_name")
    path = new_path(spark, "gz")
    rows.coalesce(1).write.option("sep", "\t").option("header", True).option("quote", "").option("compression", "gzip").csv(path)
    return tables.read_tsv(spark, path)


@query("quoted_file", "SELECT doc_id, md5(text) AS digest, length(text) AS n FROM documents")
def quoted_file(spark, sf):
    """Quoted cells with line feeds, quotes and delimiters."""
    path = new_path(spark, "quoted")
    sinks.write_quoted(table(spark, sf, "documents").select("doc_id", "text"), path)
    back = spark.read.schema("doc_id long, text string").option("header", True).option("multiLine", True).option("escape", '"').option("lineSep", "\n").csv(path)
    return back.select("doc_id", F.md5("text").alias("digest"), F.length("text").cast("long").alias("n"))


@query("membership_file", "SELECT n_name AS grp, s_suppkey::VARCHAR AS member, (row_number() OVER (PARTITION BY n_name ORDER BY s_suppkey) - 1)::INTEGER AS ordinal FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def membership_file(spark, sf):
    """Ragged lines of a group and its members."""
    s, n = table(spark, sf, "supplier"), table(spark, sf, "nation")
    rows = s.join(n, s["s_nationkey"] == n["n_nationkey"]).groupBy("n_name").agg(F.array_sort(F.collect_list("s_suppkey")).alias("m"))
    return tables.read_memberships(spark, lines(rows, "n_name", "array_join(m, '\t')"))


@query("count_matrix_file", "SELECT n_name AS grp, c AS \"column\", count(*) FILTER (c_mktsegment = c) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey, (SELECT DISTINCT c_mktsegment AS c FROM customer) GROUP BY ALL")
def count_matrix_file(spark, sf):
    """A blank-separated matrix under a line of file names."""
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    names = sorted(r[0] for r in c.select("c_mktsegment").distinct().limit(100).collect())
    rows = c.join(n, c["c_nationkey"] == n["n_nationkey"]).groupBy("n_name").pivot("c_mktsegment", names).agg(F.count(F.lit(1))).fillna(0)
    body = rows.select(F.concat_ws(" ", F.concat("n_name", F.lit(":")), *[F.col(f"`{x}`").cast("string") for x in names]).alias("value"))
    head = spark.createDataFrame([("files: " + " ".join(names),)], "value string")
    return tables.read_count_matrix(spark, lines(head.unionByName(body), "value"))


@query("species_matrix_file", "SELECT c_mktsegment AS grp, r_name AS \"column\", c_custkey::VARCHAR AS member FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE c_custkey % 7 = 0")
def species_matrix_file(spark, sf):
    """A column a species, cells of comma-separated members; one segment comes from the file of the unassigned."""
    c, n, r = (table(spark, sf, t) for t in ("customer", "nation", "region"))
    rows = c.where("c_custkey % 7 = 0").join(n, c["c_nationkey"] == n["n_nationkey"]).join(r, n["n_regionkey"] == r["r_regionkey"])
    cell = F.array_join(F.transform(F.array_sort(F.collect_list("c_custkey")), lambda x: x.cast("string")), ", ")
    wide, paths = sinks.wide(rows, "c_mktsegment", "r_name", REGIONS, cell), []
    for part in (wide.where("c_mktsegment <> 'BUILDING'"), wide.where("c_mktsegment = 'BUILDING'")):
        paths.append(new_path(spark, "matrix"))
        part.write.option("sep", "\t").option("header", True).option("quote", "").option("emptyValue", "").csv(paths[-1])
    return tables.read_species_matrix(spark, *paths)


@query("hits_file", "SELECT l_orderkey::VARCHAR AS qseqid, l_partkey::VARCHAR AS sseqid, l_quantity::DOUBLE AS pident, l_linenumber::BIGINT AS length, '1e-' || l_linenumber AS evalue_text, ('1e-' || l_linenumber)::DOUBLE AS evalue, 'part [' || l_suppkey || ']' AS stitle FROM lineitem")
def hits_file(spark, sf):
    """Tabular hits with titles; the e-value as number and as text."""
    cells = ["l_orderkey", "l_partkey", "l_quantity", "l_linenumber", "0", "0", "1", "2", "3", "4", "concat('1e-', l_linenumber)", "50.5", "concat('part [', l_suppkey, ']')"]
    hits = tables.read_hits(spark, lines(table(spark, sf, "lineitem"), *cells), titled=True)
    return hits.select("qseqid", "sseqid", "pident", "length", "evalue_text", "evalue", "stitle")


@query("domains_file", "SELECT o_orderkey::VARCHAR AS protein, 100 + o_orderkey % 50 AS length, o_orderstatus AS database, CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority END AS description, o_orderkey % 10 AS start, 10 + o_orderkey % 10 AS stop, CASE WHEN o_orderkey % 2 = 0 THEN 'GO:' || o_custkey END AS go FROM orders")
def domains_file(spark, sf):
    """Lines of 11 or 15 columns; dashes are nulls."""
    cells = ["o_orderkey", "'m'", "100 + o_orderkey % 50", "o_orderstatus", "'A1'", "if(o_orderkey % 3 > 0, o_orderpriority, '-')", "o_orderkey % 10", "10 + o_orderkey % 10", "'-'", "'T'", "'d'"]
    o = table(spark, sf, "orders")
    for_even = [*cells, "'-'", "'-'", "concat('GO:', o_custkey)", "'-'"]
    found = [tables.read_domains(spark, lines(o.where(f"o_orderkey % 2 = {k}"), *c)) for k, c in ((0, for_even), (1, cells))]
    return found[0].unionByName(found[1]).select("protein", "length", "database", "description", "start", "stop", "go")


@query("csv_file", "SELECT c_custkey::VARCHAR AS entity, label, CASE label WHEN 'high' THEN c_acctbal ELSE c_custkey / 2.0::DOUBLE END AS probability FROM customer, (SELECT unnest(['high', 'low']) AS label) WHERE label = 'low' OR c_acctbal > 0")
def csv_file(spark, sf):
    """A CSV whose key goes by another name, unpivoted; cells that are no numbers drop out."""
    path = new_path(spark, "csv")
    high = F.when(F.col("c_acctbal") > 0, F.col("c_acctbal").cast("string")).otherwise("none")
    table(spark, sf, "customer").select(F.col("c_custkey").alias("ACC"), F.concat_ws(", ", "c_name", "c_mktsegment").alias("note"), high.alias("high"), (F.col("c_custkey") / 2).alias("low")).write.option("header", True).csv(path)
    return tables.probabilities(tables.read_csv_with(spark, path, {"entity": ("Protein_ID", "ACC")}), "entity", ["high", "low"])


@query("parallel_cells_file", "SELECT l_orderkey::VARCHAR AS grp, l_partkey::VARCHAR AS part, l_suppkey::VARCHAR AS supplier FROM lineitem")
def parallel_cells_file(spark, sf):
    """Two list cells of one length, item by item."""
    items = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey")))
    rows = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(items.alias("x"))
    path = lines(rows, "l_orderkey", "array_join(transform(x, v -> string(v.l_partkey)), ',')", "array_join(transform(x, v -> string(v.l_suppkey)), ',')")
    back = spark.read.schema("grp string, parts string, suppliers string").option("sep", "\t").csv(path)
    return tables.parallel_cells(back, "grp", {"part": "parts", "supplier": "suppliers"})


GROUPED = "SELECT r_name AS grp, s_suppkey::VARCHAR AS member FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"


@query("clustering_files", f"SELECT kind, grp, member FROM ({GROUPED}), (SELECT unnest(['members', 'species', 'colon']) AS kind)")
def clustering_files(spark, sf):
    """One clustering in three formats, each told by its first line."""
    s, n, r = (table(spark, sf, t) for t in ("supplier", "nation", "region"))
    rows = s.join(n, s["s_nationkey"] == n["n_nationkey"]).join(r, n["n_regionkey"] == r["r_regionkey"]).groupBy("r_name").agg(F.array_sort(F.collect_list("s_suppkey")).alias("m"))
    text = lambda sep: f"array_join(transform(m, x -> string(x)), '{sep}')"
    matrix = new_path(spark, "species")
    rows.select(F.col("r_name").alias("Orthogroup"), F.expr(text(", ")).alias("one")).coalesce(1).write.option("sep", "\t").option("header", True).option("quote", "").csv(matrix)
    paths = {"members": lines(rows, "r_name", text("\t")), "species": matrix, "colon": lines(rows, "concat(r_name, ':')", text(" "), sep=" ")}
    made = [tables.read_clustering(spark, p).select(F.lit(tables.clustering_format(spark, p)).alias("kind"), "grp", "member") for p in paths.values()]
    return made[0].unionByName(made[1]).unionByName(made[2])


@query("phyloname_file", "SELECT n_name AS species, r_name || '_X_' || n_name AS phyloname, n_name AS taxon FROM nation JOIN region ON n_regionkey = r_regionkey")
def phyloname_file(spark, sf):
    """The map from species to taxon paths."""
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    rows = n.join(r, n["n_regionkey"] == r["r_regionkey"]).select(F.col("n_name").alias("genus_species"), F.concat_ws("_", "r_name", F.lit("X"), "n_name").alias("phyloname"))
    path = new_path(spark, "phylonames")
    sinks.write_tsv(rows, path, ["genus_species"], {"genus_species": "a species", "phyloname": "its path"})
    return tables.read_phylonames(spark, path)


@query("registry_file", "SELECT p_partkey::VARCHAR AS id, p_name || ', \"' || p_type || '\"' || chr(10) || p_brand AS name FROM part WHERE p_type IN (SELECT p_type FROM part GROUP BY 1 ORDER BY 1 LIMIT 2)")
def registry_file(spark, sf):
    """A registry whose quoted cells hold commas, quotes and line feeds, kept by locus type."""
    p = table(spark, sf, "part")
    types = [r[0] for r in p.select("p_type").distinct().orderBy("p_type").limit(2).collect()]
    note = F.concat("p_name", F.lit(', "'), "p_type", F.lit('"\n'), "p_brand")
    path = new_path(spark, "registry")
    sinks.write_quoted(p.select(F.col("p_partkey").alias("HGNC ID"), note.alias("Approved name"), F.concat(F.lit(" "), F.upper("p_type"), F.lit(" ")).alias("Locus type")), path)
    back = tables.read_registry(spark, path, {"id": "HGNC ID", "name": "Approved name", "type": "Locus type"})
    return sequences.of_locus_types(back, "type", tuple(types)).select("id", "name")


@query("kept_taxa", "SELECT 'p_' || s_suppkey || '-n_' || n_name AS header, s_name AS sequence FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey < 2")
def kept_taxa(spark, sf):
    """Sequences of the species on a keeper list."""
    s, n = table(spark, sf, "supplier"), table(spark, sf, "nation")
    fasta = s.join(n, s["s_nationkey"] == n["n_nationkey"]).select(F.concat(F.lit("p_"), F.col("s_suppkey").cast("string"), F.lit("-n_"), "n_name").alias("header"), F.col("s_name").alias("sequence"))
    keepers = n.where("n_regionkey < 2").select(F.col("n_name").alias("taxon"))
    return sequences.keep_taxa(fasta, keepers.unionAll(keepers), F.substring_index("header", "-n_", -1))


@query("lineage_file", "SELECT n_nationkey::VARCHAR AS id, n_name AS name, CASE WHEN n_regionkey > 0 THEN r_name END AS phylum FROM nation JOIN region ON n_regionkey = r_regionkey")
def lineage_file(spark, sf):
    """Dump lines between bars; empty cells are null."""
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    rows = n.join(r, n["n_regionkey"] == r["r_regionkey"]).withColumn("p", F.when(F.col("n_regionkey") > 0, F.col("r_name")))
    return tables.read_lineages(spark, lines(rows, "n_nationkey", "n_name", "p", "''", sep="\t|\t"), ("id", "name", "phylum"))


@query("gff_file", "SELECT 'g' || event_id AS gene, 'u' || user_id AS seqid, event_id + 1 AS start, event_id + 100 AS stop, CASE WHEN event_id % 2 = 0 THEN '+' ELSE '-' END AS strand FROM events")
def gff_file(spark, sf):
    """Genes of nine-column features, by three spellings of their names; transcripts beside them do not count."""
    e = table(spark, sf, "events")
    name = "concat(element_at(array('ID=x;gene=g', 'ID=gene-g', 'Name=g'), int(event_id % 3) + 1), event_id)"
    cells = ["concat('u', user_id)", "'s'", "{}", "event_id + 1", "event_id + 100", "'.'", "if(event_id % 2 = 0, '+', '-')", "'.'"]
    genes = lines(e, *[c.replace("{}", "'gene'") for c in cells], name)
    scripts = lines(e, *[c.replace("{}", "'mRNA'") for c in cells], "concat('ID=t', event_id)")
    return tables.genes_of(tables.read_gff(spark, genes).unionByName(tables.read_gff(spark, scripts)))


@query("obo_file", "SELECT 'GO:' || p_partkey AS go_id, p_name AS go_name, CASE WHEN p_size > 5 THEN p_type END AS go_namespace, p_size = 7 AS is_obsolete FROM part")
def obo_file(spark, sf):
    """Term stanzas among others."""
    p = table(spark, sf, "part")
    body = F.concat_ws("\n", F.lit("[Term]"), F.concat(F.lit("id: GO:"), F.col("p_partkey").cast("string")), F.concat(F.lit("name: "), "p_name"), F.when(F.col("p_size") > 5, F.concat(F.lit("namespace: "), "p_type")), F.when(F.col("p_size") == 7, F.lit("is_obsolete: true")), F.lit("\n[Typedef]\nid: part_of\n"))
    path = new_path(spark, "obo")
    p.select(F.concat(F.lit("format-version: 1.2\n\n"), body).alias("value")).write.text(path)
    return tables.read_obo(spark, path)


@query("manifest_file", "SELECT n_name AS name, n_regionkey::VARCHAR AS region FROM nation")
def manifest_file(spark, sf):
    """Tab-separated lines among comments and blank lines."""
    rows = table(spark, sf, "nation").select(F.explode(F.array(F.lit("# comment"), F.concat_ws("\t", "n_name", F.col("n_regionkey").cast("string")), F.lit(""))).alias("value"))
    return tables.read_manifest(spark, lines(rows, "value"), names=("name", "region"))


@query("json_file", "SELECT r_regionkey::BIGINT AS id, r_name AS name FROM region")
def json_file(spark, sf):
    """Documents of JSON over several lines."""
    rows = table(spark, sf, "region").select(F.concat(F.lit("[{\n\"id\": "), F.col("r_regionkey").cast("string"), F.lit(",\n\"name\": \""), "r_name", F.lit("\"\n}]")).alias("value"), "r_regionkey")
    path = new_path(spark, "json")
    rows.write.partitionBy("r_regionkey").text(path)
    return tables.read_json_fragments(spark, f"{path}/*").select("id", "name")


@query("file_per_key", "SELECT n_name AS name, r_name AS file_key FROM nation JOIN region ON n_regionkey = r_regionkey")
def file_per_key(spark, sf):
    """A file a key, the key read from its place."""
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    path = new_path(spark, "keys")
    n.join(r, n["n_regionkey"] == r["r_regionkey"]).select("r_name", F.col("n_name").alias("name")).write.partitionBy("r_name").option("header", True).option("sep", "\t").csv(path)
    back = tables.read_per_file(spark, f"{path}/*/*.csv", r"r_name=([^/]*)/", "name string")
    return back.withColumn("file_key", F.replace("file_key", F.lit("%20"), F.lit(" ")))


@query("group_folders", "SELECT o_orderstatus AS status, count(*) AS n, sum(o_orderkey)::BIGINT AS total FROM orders GROUP BY 1")
def group_folders(spark, sf):
    """A folder a value, read back one by one."""
    path = new_path(spark, "groups")
    sinks.write_by_group(table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status")), path, "status")
    return spark.read.parquet(path).groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("total"))


@query("fasta_file", "SELECT 'p_' || p_partkey || '-n_x' AS header, replace(p_name, ' ', '') AS sequence, 2::BIGINT AS ways FROM part")
def fasta_file(spark, sf):
    """FASTA written once and read both ways, by record separators and as a data source."""
    p = table(spark, sf, "part")
    path = new_path(spark, "fasta")
    sinks.write_fasta(p, path, F.concat(F.lit("p_"), F.col("p_partkey").cast("string"), F.lit("-n_x")), F.replace("p_name", F.lit(" "), F.lit("")))
    sequences.register(spark)
    both = sequences.read_fasta(spark, path).unionByName(spark.read.format("fasta").load(path).select("header", "sequence"))
    return both.groupBy("header", "sequence").agg(F.count(F.lit(1)).alias("ways"))


@query("newick_file", sql(ALL, "SELECT topology, parent, child FROM edges3"))
def newick_file(spark, sf):
    """All topologies as lines of Newick, parsed again."""
    made = topologies(spark, sf)
    path = lines(spark.createDataFrame([(t, T.to_newick(root)) for t, root in made], "topology string, newick string").coalesce(1), "newick")
    back = {T.to_newick(root): root for root in tree_source.read_newick(spark, path)}
    rows = [(t, p, c) for t, root in made for p, c in T.edges_of(back[T.to_newick(root)])]
    return spark.createDataFrame(rows, "topology string, parent string, child string")


@query("pruned_topologies", sql(ALL, """cover AS (SELECT a.topology, a.tip AS x, b.tip AS y, max(a.depth) AS d FROM paths3 a JOIN paths3 b USING (topology, node) WHERE a.tip IN ('NATION_0', 'NATION_1', 'NATION_2') AND b.tip IN ('NATION_0', 'NATION_1', 'NATION_2') AND a.tip < b.tip GROUP BY ALL)""",
  """SELECT topology, CASE WHEN count(*) FILTER (d = m) > 1 THEN '(NATION_0,NATION_1,NATION_2)' ELSE max(CASE WHEN d = m THEN '((' || x || ',' || y || '),' || (CASE WHEN x || y = 'NATION_0NATION_1' THEN 'NATION_2' WHEN x || y = 'NATION_0NATION_2' THEN 'NATION_1' ELSE 'NATION_0' END) || ')' END) END AS canonical
  FROM (SELECT *, max(d) OVER (PARTITION BY topology) AS m FROM cover) GROUP BY topology"""))  # fmt: skip
def pruned_topologies(spark, sf):
    """The trees that three nations induce, labels of two of them swapped twice."""
    tips = ["NATION_0", "NATION_1", "NATION_2"]
    rows = [(t, T.induced(T.swap(T.swap(root, tips[0], tips[1]), tips[0], tips[1]), tips)) for t, root in topologies(spark, sf)]
    return spark.createDataFrame(rows, "topology string, canonical string")


@query("numbered_clades", """WITH r AS (SELECT r_name, row_number() OVER (ORDER BY r_name) AS k, count(*) OVER () AS regions FROM region), n AS (SELECT n_name, r_name, row_number() OVER (ORDER BY r_name, n_name) AS k, count(*) OVER () AS tips FROM nation JOIN region ON n_regionkey = r_regionkey)
  SELECT n_name AS clade, 'C' || lpad(k::VARCHAR, 3, '0') || '_' || n_name AS id FROM n UNION ALL SELECT 'ROOT', 'C' || lpad((any_value(tips) + 1)::VARCHAR, 3, '0') || '_ROOT' FROM n
  UNION ALL SELECT r.r_name, 'C' || lpad((t + 1 + r.k)::VARCHAR, 3, '0') || '_' || r.r_name FROM r, (SELECT any_value(tips) AS t FROM n)""")  # fmt: skip
def numbered_clades(spark, sf):
    """Clade ids: tips in pre-order, then inner nodes breadth first."""
    from arbora.plans.world import world_tree

    root = T.assign_ids(world_tree(spark, sf))
    return spark.createDataFrame([(T.bare_name(n.name), n.name) for n in root.walk()], "clade string, id string")
