"""Queries of annotation groups, intervals, ids and names."""

from __future__ import annotations

from pyspark.sql import functions as F

from arbora.functions import keys
from arbora.operators import groups, intervals
from arbora.plans.world import Query, table

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle:
            SQL[name] = oracle
        return fn

    return register


ORDER = ("l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


def _codes(spark, sf):
    """Orders annotated by the flags of their lines, in line order."""
    items = table(spark, sf, "lineitem")
    return items.select(F.col("l_orderkey").alias("entity"), F.concat("l_returnflag", "l_linestatus").alias("code"), *ORDER, F.lit(True).alias("positional"))


def _orders(spark, sf):
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("entity"))


CODES = "c AS (SELECT l_orderkey AS entity, l_returnflag || l_linestatus AS code, * FROM lineitem)"
SORTED = ", ".join(ORDER)


@query("groups_by_code", f"WITH {CODES} SELECT DISTINCT code AS group_key, entity FROM c")
def groups_by_code(spark, sf):
    return groups.by_code(_codes(spark, sf))


@query("groups_by_set", f"WITH {CODES} SELECT string_agg(DISTINCT code, ',' ORDER BY code) AS group_key, entity FROM c GROUP BY entity")
def groups_by_set(spark, sf):
    return groups.by_set(_codes(spark, sf))


@query("groups_by_sequence", f"WITH {CODES} SELECT string_agg(code, ',' ORDER BY {SORTED}, code) AS group_key, entity FROM c GROUP BY entity")
def groups_by_sequence(spark, sf):
    return groups.by_sequence(_codes(spark, sf), *ORDER)


@query("groups_by_absence", "SELECT 'absent' AS group_key, o_orderkey AS entity FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def groups_by_absence(spark, sf):
    return groups.by_absence(_orders(spark, sf), _codes(spark, sf))


@query("numbered_groups", f"""WITH {CODES}, g AS (SELECT string_agg(DISTINCT code, ',' ORDER BY code) AS group_key FROM c GROUP BY entity)
  SELECT 'combination' || lpad(row_number() OVER (ORDER BY group_key)::VARCHAR, 5, '0') AS group_id, group_key, n FROM (SELECT group_key, count(*) AS n FROM g GROUP BY group_key)""")  # fmt: skip
def numbered_groups(spark, sf):
    return groups.numbered(groups.by_set(_codes(spark, sf)), "combination")


@query("group_orphans", "SELECT l_orderkey AS entity, count(*) AS rows FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY l_orderkey")
def group_orphans(spark, sf):
    return groups.orphans(_codes(spark, sf), table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("entity")))


@query("group_universe", "SELECT l_orderkey AS entity FROM lineitem UNION SELECT o_orderkey FROM orders")
def group_universe(spark, sf):
    return groups.universe(_codes(spark, sf), _orders(spark, sf))


@query("tagged_sequences", f"""WITH {CODES} SELECT entity, string_agg(code || '_start' || l_linenumber || '_stop' || (l_linenumber + l_quantity::BIGINT), ',' ORDER BY l_linenumber, l_linenumber + l_quantity::BIGINT, code) AS sequence FROM c GROUP BY entity""")
def tagged_sequences(spark, sf):
    rows = _codes(spark, sf).select("entity", "code", F.col("l_linenumber").cast("long").alias("start"), (F.col("l_linenumber") + F.col("l_quantity").cast("long")).alias("stop"), F.lit(0).alias("ordinal"), "positional")
    return groups.tagged_sequence(rows)


@query("group_definitions", f"""WITH {CODES}, t AS (SELECT DISTINCT entity, CASE WHEN l_returnflag <> 'N' THEN (CASE l_returnflag WHEN 'A' THEN 'accepted' ELSE 'returned' END) || ' ==' || code END AS t FROM c)
  SELECT entity, coalesce(string_agg(t, '; ' ORDER BY t), '') AS definitions FROM t GROUP BY entity""")  # fmt: skip
def group_definitions(spark, sf):
    text = F.when(F.col("code").startswith("A"), "accepted").when(F.col("code").startswith("R"), "returned")
    return _codes(spark, sf).withColumn("definition", text).groupBy("entity").agg(groups.definitions().alias("definitions"))


@query("group_memberships", f"""WITH {CODES} SELECT kind, count(*) AS rows, count(DISTINCT group_key) AS groups FROM (
  SELECT DISTINCT 'code' AS kind, code AS group_key, entity FROM c UNION ALL SELECT 'set', string_agg(DISTINCT code, ',' ORDER BY code), entity FROM c GROUP BY entity
  UNION ALL SELECT 'sequence', string_agg(code, ',' ORDER BY l_linenumber, l_linenumber, code), entity FROM c GROUP BY entity
  UNION ALL SELECT 'absent', 'absent', o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) GROUP BY kind""")  # fmt: skip
def group_memberships(spark, sf):
    rows = _codes(spark, sf).select("entity", "code", F.col("l_linenumber").cast("long").alias("start"), F.col("l_linenumber").cast("long").alias("stop"), F.lit(0).alias("ordinal"), "positional")
    got = groups.memberships(rows, groups.universe(rows, _orders(spark, sf)))
    return got.groupBy("kind").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("group_key").alias("groups"))


@query("group_checks", "SELECT * FROM (VALUES ('one group a kind', 0::BIGINT), ('annotated entities have a set', 0::BIGINT), ('absent ones have no annotation', 0::BIGINT), ('universe is covered', 0::BIGINT)) v(\"check\", violations)")
def group_checks(spark, sf):
    rows = _codes(spark, sf).select("entity", "code", F.col("l_linenumber").cast("long").alias("start"), F.col("l_linenumber").cast("long").alias("stop"), F.lit(0).alias("ordinal"), "positional")
    every = groups.universe(rows, _orders(spark, sf))
    return groups.partition_violations(groups.memberships(rows, every), rows, every)


# intervals
def _spans(spark, sf):
    """Events as intervals of whole seconds."""
    start = F.expr("timestampdiff(SECOND, timestamp_ntz'1970-01-01', ts)")
    return table(spark, sf, "events").select("user_id", start.alias("start"), (start + F.floor(F.col("value") * 60)).alias("stop"))


SPANS = """s AS (SELECT user_id, floor(epoch(ts))::BIGINT AS start, floor(epoch(ts))::BIGINT + floor(value * 60)::BIGINT AS stop FROM events),
f AS (SELECT *, CASE WHEN start <= max(stop) OVER (PARTITION BY user_id ORDER BY start, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 THEN 0 ELSE 1 END AS fresh FROM s),
i AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY start, stop ROWS UNBOUNDED PRECEDING) AS island FROM f),
m AS (SELECT user_id, min(start) AS start, max(stop) AS stop, count(*) AS n FROM i GROUP BY user_id, island)"""


@query("merged_intervals", f"WITH {SPANS} SELECT user_id, start, stop, n FROM m")
def merged_intervals(spark, sf):
    return intervals.merge_rows(_spans(spark, sf), "user_id", "start", "stop")


@query("interval_gaps", f"WITH {SPANS} SELECT * FROM (SELECT user_id, start, stop, start - lag(stop) OVER (PARTITION BY user_id ORDER BY start, stop) AS gap FROM m) WHERE gap IS NOT NULL")
def interval_gaps(spark, sf):
    return intervals.row_gaps(intervals.merge_rows(_spans(spark, sf), "user_id", "start", "stop"), "user_id", "start", "stop")


def _genes(spark, sf):
    """Orders as genes: lines are exons of 30 * line number on, their returned part is coding."""
    items = table(spark, sf, "lineitem").select("l_orderkey", (F.col("l_linenumber") * 30).cast("long").alias("a"), F.col("l_quantity").cast("long").alias("q"))
    cell = lambda extra: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("a", "q"))), lambda x: F.concat(x["a"].cast("string"), F.lit("-"), (x["a"] + F.greatest(x["q"] + extra, F.lit(0).cast("long"))).cast("string"))), ",")
    rows = items.groupBy("l_orderkey").agg(cell(0).alias("exons"), cell(-10).alias("cds"), (F.min("a") - 5).alias("gene_start"), (F.max(F.col("a") + F.col("q")) + 5).alias("gene_stop"))
    return rows.withColumn("strand", F.when(F.col("l_orderkey") % 2 == 0, "+").otherwise("-"))


GENES = """e AS (SELECT l_orderkey, l_linenumber * 30::BIGINT AS a, l_linenumber * 30 + l_quantity::BIGINT AS b, l_linenumber * 30 + greatest(l_quantity::BIGINT - 10, 0) AS c FROM lineitem),
xf AS (SELECT *, CASE WHEN a <= max(b) OVER (PARTITION BY l_orderkey ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 THEN 0 ELSE 1 END AS fresh FROM e),
xi AS (SELECT *, sum(fresh) OVER (PARTITION BY l_orderkey ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS k FROM xf), x AS (SELECT l_orderkey, k, min(a) AS a, max(b) AS b FROM xi GROUP BY ALL),
cf AS (SELECT *, CASE WHEN a <= max(c) OVER (PARTITION BY l_orderkey ORDER BY a, c ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 THEN 0 ELSE 1 END AS fresh FROM e),
ci AS (SELECT *, sum(fresh) OVER (PARTITION BY l_orderkey ORDER BY a, c ROWS UNBOUNDED PRECEDING) AS k FROM cf), cd AS (SELECT l_orderkey, k, min(a) AS a, max(c) AS b FROM ci GROUP BY ALL),
g AS (SELECT l_orderkey, max(b) - min(a) + 11 AS gene_size FROM e GROUP BY 1), t AS (SELECT l_orderkey, sum(b - a + 1)::BIGINT AS transcript_size, count(*) AS exon_count,
  CASE WHEN l_orderkey % 2 = 0 THEN string_agg((b - a + 1)::VARCHAR, ',' ORDER BY a) ELSE string_agg((b - a + 1)::VARCHAR, ',' ORDER BY a DESC) END AS exon_sizes FROM x GROUP BY 1),
w AS (SELECT l_orderkey, a, a - lag(b) OVER (PARTITION BY l_orderkey ORDER BY a) - 1 AS gap FROM x),
n AS (SELECT l_orderkey, CASE WHEN l_orderkey % 2 = 0 THEN string_agg(gap::VARCHAR, ',' ORDER BY a) ELSE string_agg(gap::VARCHAR, ',' ORDER BY a DESC) END AS intron_sizes FROM w WHERE gap IS NOT NULL GROUP BY 1),
d AS (SELECT l_orderkey, sum(b - a + 1)::BIGINT AS cds_size FROM cd GROUP BY 1)"""


@query("gene_metrics", f"""WITH {GENES} SELECT l_orderkey, gene_size, transcript_size, cds_size, cds_size // 3 AS protein_size, greatest(gene_size - transcript_size, 0) AS intron_size,
  greatest(transcript_size - cds_size, 0) AS utr_size, exon_count::INTEGER AS exon_count, exon_sizes, coalesce(intron_sizes, '') AS intron_sizes FROM g JOIN t USING (l_orderkey) JOIN d USING (l_orderkey) LEFT JOIN n USING (l_orderkey)""")  # fmt: skip
def gene_metrics(spark, sf):
    wanted = ["gene_size", "transcript_size", "cds_size", "protein_size", "intron_size", "utr_size", "exon_count", "exon_sizes", "intron_sizes"]
    return intervals.gene_metrics(_genes(spark, sf)).select("l_orderkey", *wanted)


@query("coding_metrics", f"WITH {GENES} SELECT l_orderkey, gene_size, cds_size, cds_size // 3 AS protein_size FROM g JOIN d USING (l_orderkey)")
def coding_metrics(spark, sf):
    return intervals.coding_metrics(_genes(spark, sf)).select("l_orderkey", "gene_size", "cds_size", "protein_size")


@query("compile_status", "SELECT o_orderkey, coalesce(n, 0) AS rows, CASE WHEN n > 0 THEN 'PROCESSED' ELSE 'SKIPPED' END AS status FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey")
def compile_status(spark, sf):
    results = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return intervals.compile_status(results, table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")


# ids and names
def _ids(spark, sf):
    """Suppliers with composite ids under a taxon path."""
    s, n, r = (table(spark, sf, t) for t in ("supplier", "nation", "region"))
    rows = s.join(n, s["s_nationkey"] == n["n_nationkey"]).join(r, n["n_regionkey"] == r["r_regionkey"])
    word = lambda c: F.regexp_replace(c, "[ _]", "")
    taxon = F.concat_ws("_", F.lit("Meta"), word(F.col("r_name")), F.lit("Cl"), F.lit("Or"), F.lit("Fa"), word(F.col("n_name")), F.concat(F.lit("s"), F.col("s_suppkey").cast("string")))
    raw = F.concat_ws("|", F.concat(F.lit("G/"), F.col("s_suppkey").cast("string")), F.when(F.col("s_suppkey") % 3 == 0, F.lit("part")), F.concat(F.lit("T"), F.col("s_nationkey").cast("string")), F.when(F.col("s_suppkey") % 2 == 0, F.lit("P-1")))
    return rows.select("s_suppkey", raw.alias("raw"), taxon.alias("taxon"))


IDS = """ids AS (SELECT s_suppkey, concat_ws('|', 'G/' || s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'part' END, 'T' || s_nationkey, CASE WHEN s_suppkey % 2 = 0 THEN 'P-1' END) AS raw,
  'Meta_' || regexp_replace(r_name, '[ _]', '', 'g') || '_Cl_Or_Fa_' || regexp_replace(n_name, '[ _]', '', 'g') || '_s' || s_suppkey AS taxon
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
parts AS (SELECT *, string_split(replace(raw, '/', '_'), '|') AS p FROM ids),
built AS (SELECT *, CASE WHEN len(p) > 3 THEN array_to_string(p[1:len(p) - 2], '|') ELSE p[1] END AS gene, CASE WHEN len(p) >= 3 THEN p[len(p) - 1] ELSE coalesce(p[2], p[1]) END AS tx, CASE WHEN len(p) >= 3 THEN p[len(p)] ELSE coalesce(p[2], p[1]) END AS prot FROM parts),
entity AS (SELECT *, 'g_' || gene || '-t_' || tx || '-p_' || prot || '-n_' || taxon AS entity FROM built)"""


@query("composite_ids", f"WITH {IDS} SELECT s_suppkey, entity, taxon AS taxon_back, gene AS gene_back FROM entity")
def composite_ids(spark, sf):
    entity = keys.build_id(F.col("raw"), F.col("taxon"))
    return _ids(spark, sf).select("s_suppkey", entity.alias("entity")).withColumns({"taxon_back": keys.taxon_of(F.col("entity")), "gene_back": keys.gene_of(F.col("entity"))})


@query("taxon_ranks", f"WITH {IDS} SELECT s_suppkey, split_part(taxon, '_', 2) AS phylum, split_part(taxon, '_', 6) AS genus, split_part(taxon, '_', 6) || '_' || split_part(taxon, '_', 7) AS species, split_part(taxon, '_', 2) || ' ' || split_part(taxon, '_', 6) || ' ' || split_part(taxon, '_', 7) AS label FROM ids")
def taxon_ranks(spark, sf):
    t = F.col("taxon")
    return _ids(spark, sf).select("s_suppkey", keys.rank_of(t, "phylum").alias("phylum"), keys.genus_of(t).alias("genus"), keys.species_of(t).alias("species"), keys.short_label(t).alias("label"))


@query("short_id_round_trip", "SELECT 's' || row_number() OVER (ORDER BY c_name) AS short_id, c_name, c_custkey FROM customer")
def short_id_round_trip(spark, sf):
    """Names shortened by a dictionary and decoded again."""
    customers = table(spark, sf, "customer").select("c_name", "c_custkey")
    dictionary = keys.short_ids(customers, "c_name")
    encoded = customers.join(dictionary, "c_name").select("short_id", "c_custkey")
    return keys.decode_ids(encoded.withColumn("sid", F.col("short_id")), dictionary, "short_id", "c_name").withColumnRenamed("sid", "short_id")


@query("clean_names", """SELECT p_partkey, trim(regexp_replace(regexp_replace(lower(p_name || ' / (' || p_type || ')'), '[^a-z0-9]', '_', 'g'), '_+', '_', 'g'), '_') AS group_name,
  trim(regexp_replace(regexp_replace(p_name || ' / (' || p_type || ')', '[ /\\\\()\\[\\]:;,''"-]', '_', 'g'), '_+', '_', 'g'), '_') AS taxon_word, trim(replace(p_name || chr(9) || p_brand || chr(10), chr(9), ' '), ' ' || chr(10)) AS text FROM part""")  # fmt: skip
def clean_names(spark, sf):
    raw = F.concat("p_name", F.lit(" / ("), "p_type", F.lit(")"))
    return table(spark, sf, "part").select("p_partkey", keys.clean_group_name(raw).alias("group_name"), keys.clean_taxon_word(raw).alias("taxon_word"), keys.clean_text(F.concat("p_name", F.lit("\t"), "p_brand", F.lit("\n"))).alias("text"))


@query("bare_names", "SELECT n_nationkey, n_name AS bare, 'x_' || n_name AS rest, 'NP_' || n_nationkey || '.1' AS accession, 0.25::DOUBLE AS probability, n_name AS last FROM nation")
def bare_names(spark, sf):
    n = table(spark, sf, "nation")
    return n.select(
        "n_nationkey", keys.bare_name(F.concat(F.lit("C012_"), "n_name")).alias("bare"), keys.after_first_underscore(F.concat(F.lit("q_x_"), "n_name")).alias("rest"),
        keys.version_dot(F.concat(F.lit("NP_"), F.col("n_nationkey").cast("string"), F.lit("_1"))).alias("accession"), keys.probability_of(F.lit("call probability=0.25;")).alias("probability"), keys.last_bar(F.concat(F.lit("a|b|"), "n_name")).alias("last"),
    )


@query("residues", """SELECT doc_id, length(text) - length(replace(text, 'e', '')) AS n_e, CASE WHEN length(text) > 0 THEN round_even(100.0::DOUBLE * (length(text) - length(replace(text, 'e', ''))) / length(text), 2) ELSE 0.0 END AS percent_e,
  md5(translate(text, '#*$%', 'XXXX')) AS cleaned FROM documents""")  # fmt: skip
def residues(spark, sf):
    t = F.col("text")
    return table(spark, sf, "documents").select("doc_id", keys.residue_count(t, "e").alias("n_e"), keys.residue_percent(t, "e").alias("percent_e"), F.md5(keys.valid_residues(t, "#*$%")).alias("cleaned"))


@query("residue_log", "SELECT p_partkey, i AS position, substr(p_name, i, 1) AS residue FROM part, LATERAL (SELECT unnest(range(1, length(p_name) + 1)) AS i) WHERE NOT regexp_matches(substr(p_name, i, 1), '[A-Za-z*]')")
def residue_log(spark, sf):
    return keys.invalid_residues(table(spark, sf, "part"), "p_partkey", "p_name")


def _ranks(spark, sf):
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    rows = c.join(n, c["c_nationkey"] == n["n_nationkey"])
    blank = lambda cond, v: F.when(cond, F.lit("")).otherwise(v)
    return rows.select("c_custkey", blank(F.col("c_custkey") % 4 == 0, F.col("c_mktsegment")).alias("phylum"), blank(F.col("c_custkey") % 3 == 0, F.col("n_name")).alias("class"), F.concat(F.lit("g"), (F.col("c_custkey") % 7).cast("string")).alias("genus"))


@query("unknown_clades", """WITH r AS (SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE c_mktsegment END AS phylum, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE n_name END AS class, 'g' || (c_custkey % 7) AS genus FROM customer JOIN nation ON c_nationkey = n_nationkey),
  a AS (SELECT *, CASE WHEN class <> '' THEN class ELSE genus END AS below FROM r), pn AS (SELECT below, row_number() OVER (ORDER BY min(c_custkey)) AS k FROM a WHERE phylum = '' GROUP BY below),
  cn AS (SELECT genus, row_number() OVER (ORDER BY min(c_custkey)) AS k FROM r WHERE class = '' GROUP BY genus)
  SELECT a.c_custkey, CASE WHEN phylum = '' THEN 'unknown_phylum_' || pn.k ELSE phylum END AS phylum, CASE WHEN class = '' THEN 'unknown_class_' || cn.k ELSE class END AS class, a.genus
  FROM a LEFT JOIN pn ON pn.below = a.below LEFT JOIN cn ON cn.genus = a.genus""")  # fmt: skip
def unknown_clades(spark, sf):
    return keys.unknown_clades(_ranks(spark, sf), ["phylum", "class", "genus"], "c_custkey").select("c_custkey", "phylum", "class", "genus")


@query("unofficial_ranks", f"WITH {IDS} SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN replace(replace(taxon, '_Cl_', '_NewUNOFFICIAL_'), '_Fa_', '_OtherUNOFFICIAL_') ELSE taxon END AS marked FROM ids")
def unofficial_ranks(spark, sf):
    user = F.when(F.col("s_suppkey") % 2 == 0, F.replace(F.replace("taxon", F.lit("_Cl_"), F.lit("_New_")), F.lit("_Fa_"), F.lit("_OtherUNOFFICIAL_"))).otherwise(F.col("taxon"))
    return _ids(spark, sf).select("s_suppkey", keys.mark_unofficial(user, F.col("taxon")).alias("marked"))
