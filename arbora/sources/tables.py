"""Tabular sources: self-documenting TSV, memberships, matrices, hits, domains, genes, lookups."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULLS = {"NA": "NA", "none": "None", "dash": "-", "empty": ""}

HITS = "qseqid string, sseqid string, pident double, length long, mismatch long, gapopen long, qstart long, qend long, sstart long, send long, evalue_text string, bitscore double"
HITS_TITLED = HITS + ", stitle string"
LONG_FACTS = "taxon string, entity string, start long, stop long, database string, accession string, details string"
DOMAINS = ("protein", "md5", "length", "database", "accession", "description", "start", "stop", "score", "status", "date", "ipr", "ipr_description", "go", "pathway")


def header_id(cell: str) -> str:
    """The id of a header cell ``Id (prose)``."""
    return cell.split(" (", 1)[0].strip()


def null_if(c: Column, *markers: str) -> Column:
    return F.when(~F.coalesce(F.trim(c).isin(*markers), F.lit(True)), c)


def read_tsv(spark: SparkSession, path: str, columns: dict[str, str] | None = None, nulls: tuple[str, ...] = (), required: tuple[str, ...] = ()) -> DataFrame:
    """A TSV whose header cells are ``Id (prose)``: columns are named by id and keep the prose as comment; plain or gz.

    ``columns``: types by id.  A required id that the header lacks raises."""
    raw = spark.read.option("sep", "\t").option("header", True).option("quote", "").option("inferSchema", False).csv(path)
    names = [header_id(c) for c in raw.columns]
    lacking = [r for r in required if r not in names]
    if lacking:
        raise ValueError(f"{path} lacks {', '.join(lacking)}")
    out = []
    for old, new in zip(raw.columns, names, strict=True):
        c = F.col(f"`{old}`")
        c = null_if(c, *nulls) if nulls else c
        if columns and new in columns:
            c = c.cast(columns[new])
        prose = old[len(new) :].strip().removeprefix("(").removesuffix(")")
        out.append(c.alias(new, metadata={"comment": prose}))
    return raw.select(*out)


def read_memberships(spark: SparkSession, path: str) -> DataFrame:
    """(grp, member, ordinal) of ragged lines ``group<TAB>member<TAB>...`` without header."""
    parts = F.split("value", "\t")
    rows = spark.read.text(path).where("trim(value) <> '' and not startswith(value, '#')").select(F.get(parts, F.lit(0)).alias("grp"), F.posexplode(F.slice(parts, 2, 1 << 20)).alias("ordinal", "member"))
    return rows.where("trim(member) <> ''").select("grp", F.trim("member").alias("member"), "ordinal")


def read_count_matrix(spark: SparkSession, path: str) -> DataFrame:
    """(grp, column, n) of a blank-separated matrix whose first line is ``files: a b c`` and whose ids end in a colon."""
    lines = spark.read.text(path).where("trim(value) <> ''")
    head = lines.where("startswith(value, 'files:')").first()
    if head is None:
        raise ValueError(f"{path} has no files line")
    names = head["value"].split()[1:]
    cells = F.split(F.trim("value"), r"\s+")
    rows = lines.where("not startswith(value, 'files:')").select(F.rtrim(F.get(cells, F.lit(0)), F.lit(":")).alias("grp"), F.posexplode(F.slice(cells, 2, 1 << 20)).alias("k", "n"))
    return rows.select("grp", F.get(F.array(*map(F.lit, names)), F.col("k")).alias("column"), F.col("n").cast("long").alias("n"))


def read_species_matrix(spark: SparkSession, path: str, unassigned: str | None = None) -> DataFrame:
    """(grp, column, member) of a TSV with one column a species and cells ``a, b, c``."""

    def melt(p: str) -> DataFrame:
        raw = spark.read.option("sep", "\t").option("header", True).option("quote", "").csv(p)
        first, *rest = raw.columns
        cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("cell")) for c in rest])).alias("x")
        rows = raw.select(F.col(f"`{first}`").alias("grp"), cells).where("x.cell is not null")
        return rows.select("grp", "x.column", F.explode(F.split("x.cell", ", ")).alias("member")).where("member <> ''")

    return melt(path).unionByName(melt(unassigned)) if unassigned else melt(path)


def clustering_format(spark: SparkSession, path: str) -> str:
    """Which clustering file it is, by its first line: counts (``files: ...``), species (a TSV with a header of species),
    colon (``group: a b c``) or members (``group<TAB>a<TAB>b``)."""
    first = spark.read.text(path).where("trim(value) <> '' and not startswith(value, '#')").limit(1).collect()
    line = first[0]["value"] if first else ""
    if line.startswith("files:"):
        return "counts"
    if re.match(r"(orthogroup|hog|og|group|cluster)\t", line, re.I):
        return "species"
    if "\t" in line:
        return "members"
    if re.match(r"[^:]+:(\s|$)", line):
        return "colon"
    raise ValueError(f"{path} is no clustering")


def read_clustering(spark: SparkSession, path: str, unassigned: str | None = None) -> DataFrame:
    """(grp, member) of a clustering file of any format that lists members."""
    kind = clustering_format(spark, path)
    if kind == "members":
        return read_memberships(spark, path).select("grp", "member")
    if kind == "species":
        return read_species_matrix(spark, path, unassigned).select("grp", "member")
    if kind == "colon":
        rows = spark.read.text(path).where("trim(value) <> ''")
        parts = F.split(F.trim(F.substring_index("value", ":", -1)), r"\s+")
        return rows.select(F.substring_index("value", ":", 1).alias("grp"), F.explode(parts).alias("member")).where("member <> ''")
    raise ValueError(f"{path} has counts, no members")


def read_phylonames(spark: SparkSession, path: str) -> DataFrame:
    """(species, phyloname, taxon): the map of species names to taxon paths; the taxon is the path without its rank prefix."""
    rows = read_tsv(spark, path, required=("genus_species", "phyloname"))
    return rows.select(F.col("genus_species").alias("species"), "phyloname", F.substring_index("phyloname", "_", -2).alias("taxon"))


def read_registry(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """A registry CSV with quoted cells, which may hold commas, quotes and line feeds; columns by wanted and given name."""
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    lacking = [c for c in columns.values() if c not in raw.columns]
    if lacking:
        raise ValueError(f"{path} lacks {', '.join(lacking)}")
    return raw.select(*[F.trim(F.col(f"`{c}`")).alias(n) for n, c in columns.items()])


def read_hits(spark: SparkSession, path: str, titled: bool = False, strict: bool = True) -> DataFrame:
    """Tabular similarity hits with the e-value as number and as text.  strict: a malformed row raises, else it drops."""
    mode = "FAILFAST" if strict else "DROPMALFORMED"
    rows = spark.read.schema(HITS_TITLED if titled else HITS).option("sep", "\t").option("quote", "").option("comment", "#").option("mode", mode).csv(path)
    if not strict:  # whatever columns are asked for, a row must have them all
        rows = rows.where(F.col("bitscore").isNotNull() & (F.col("stitle").isNotNull() if titled else F.lit(True)))
    return rows.withColumn("evalue", F.col("evalue_text").cast("double"))


def read_domains(spark: SparkSession, path: str) -> DataFrame:
    """Domain hits of 11 to 15 columns without header; dashes and blanks of optional columns are null."""
    parts = F.split("value", "\t")
    at = lambda i: F.get(parts, F.lit(i))
    rows = spark.read.text(path).where(F.size(parts) >= 11)
    typed = {"length": "long", "start": "long", "stop": "long"}
    return rows.select(*[(null_if(at(i), "-", "") if i >= 5 else at(i)).try_cast(typed.get(n, "string")).alias(n) for i, n in enumerate(DOMAINS)])


def databases_of(domains: DataFrame) -> DataFrame:
    return domains.select("database").distinct()


def long_facts(domains: DataFrame, taxon: Column) -> DataFrame:
    """The seven-column annotation fact, plus a row a GO term of each domain."""
    base = domains.select(taxon.alias("taxon"), F.col("protein").alias("entity"), "start", "stop", F.lower("database").alias("database"), "accession", F.col("description").alias("details"), "go")
    terms = base.where("go is not null").select("taxon", "entity", "start", "stop", F.lit("go").alias("database"), F.explode(F.split("go", r"\|")).alias("accession"), F.lit(None).cast("string").alias("details"))
    return base.drop("go").unionByName(terms.withColumn("accession", F.regexp_extract("accession", r"^([^(]+)", 1)))


def read_csv_with(spark: SparkSession, path: str, fallbacks: dict[str, tuple[str, ...]]) -> DataFrame:
    """A CSV whose columns go by several names: each wanted name takes the first one there; the others are kept as they are."""
    raw = spark.read.option("header", True).csv(path)
    used, out = set(), []
    for want, names in fallbacks.items():
        have = next((n for n in (want, *names) if n in raw.columns), None)
        if have is None:
            raise ValueError(f"{path} has none of {', '.join((want, *names))}")
        used.add(have)
        out.append(F.col(f"`{have}`").alias(want))
    return raw.select(*out, *[F.col(f"`{c}`") for c in raw.columns if c not in used])


def probabilities(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, label, probability) in long form."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("label"), F.col(f"`{c}`").try_cast("double").alias("probability")) for c in columns])).alias("x")
    return rows.select(key, cells).select(key, "x.*").where("probability is not null")


def parallel_cells(rows: DataFrame, key: str, cells: dict[str, str], delimiter: str = ",") -> DataFrame:
    """List cells of one length, item by item: a row an item with its columns."""
    arrays = [F.split(F.col(c), F.lit(re.escape(delimiter))).alias(n) for n, c in cells.items()]
    zipped = F.explode(F.arrays_zip(*arrays)).alias("x")
    return rows.where(F.coalesce(F.col(next(iter(cells.values()))), F.lit("")) != "").select(key, zipped).select(key, *[F.trim(F.col(f"x.{n}")).alias(n) for n in cells])


def read_lineages(spark: SparkSession, path: str, names: tuple[str, ...]) -> DataFrame:
    """Dump lines ``a<TAB>|<TAB>b<TAB>|``."""
    parts = F.transform(F.split("value", r"\|"), lambda x: F.trim(F.translate(x, "\t", " ")))
    return spark.read.text(path).select(parts.alias("p")).select(*[F.nullif(F.get("p", F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(names)])


def read_gff(spark: SparkSession, path: str) -> DataFrame:
    """Nine-column features with attributes as a map, and the line's place in its file."""
    schema = "seqid string, source string, type string, start long, stop long, score string, strand string, phase string, attributes string"
    rows = spark.read.schema(schema).option("sep", "\t").option("quote", "").option("comment", "#").option("mode", "DROPMALFORMED").csv(path)
    rows = rows.where("start is not null and stop is not null").withColumn("ordinal", F.monotonically_increasing_id())
    pairs = F.filter(F.transform(F.split("attributes", ";"), lambda x: F.split(F.trim(x), "=", 2)), lambda x: F.size(x) == 2)
    return rows.withColumn("attributes", F.map_from_entries(F.array_distinct(F.transform(pairs, lambda x: F.struct(x[0], x[1])))))


def genes_of(features: DataFrame) -> DataFrame:
    """(gene, seqid, start, stop, strand): from gene rows (ID by gene=, then ID=gene-..., then Name=); where the source has
    none, transcripts are grouped by their id without the last .tN, spanning all and placed as the first."""
    a = F.col("attributes")
    key = F.coalesce(F.try_element_at(a, F.lit("gene")), F.regexp_replace(F.try_element_at(a, F.lit("ID")), "^gene[-:]", ""), F.try_element_at(a, F.lit("Name")))
    genes = features.where("type = 'gene'").select(key.alias("gene"), "seqid", "start", "stop", "strand")
    stem = F.regexp_replace(F.coalesce(F.try_element_at(a, F.lit("ID")), F.try_element_at(a, F.lit("transcript_id")), F.get(F.map_values(a), F.lit(0))), r"\.t?\d+$", "")
    scripts = features.where("type in ('transcript', 'mRNA')").groupBy(stem.alias("gene"))
    made = scripts.agg(F.min_by("seqid", "ordinal").alias("seqid"), F.min("start").alias("start"), F.max("stop").alias("stop"), F.min_by("strand", "ordinal").alias("strand"))
    none = features.where("type = 'gene'").limit(1).agg(F.count(F.lit(1)).alias("_genes"))
    return genes.unionByName(made.crossJoin(none).where("_genes = 0").drop("_genes")).where("gene is not null")


def gene_models(features: DataFrame) -> DataFrame:
    """(gene, seqid, strand, gene_start, gene_stop, exons, cds) by the gene > transcript > exon/CDS chain, of the transcript with the longest coding sequence, first listed on ties."""
    a = F.col("attributes")
    get = lambda k: F.try_element_at(a, F.lit(k))
    genes = features.where("type = 'gene'").select(get("ID").alias("gene_key"), F.coalesce(get("gene"), F.regexp_replace(get("ID"), "^gene[-:]", "")).alias("gene"), "seqid", "strand", F.col("start").alias("gene_start"), F.col("stop").alias("gene_stop"))
    scripts = features.where("type in ('mRNA', 'transcript')").select(get("ID").alias("script"), get("Parent").alias("gene_key"), "ordinal")
    parts = features.where("type in ('exon', 'CDS')").select(get("Parent").alias("script"), "type", F.concat_ws("-", "start", "stop").alias("cell"), (F.col("stop") - F.col("start") + 1).alias("size"), "start")
    cell = lambda t: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("type") == t, F.struct("start", "cell")))), lambda x: x["cell"]), ",")
    per = parts.groupBy("script").agg(cell("exon").alias("exons"), cell("CDS").alias("cds"), F.coalesce(F.sum(F.when(F.col("type") == "CDS", F.col("size"))), F.lit(0)).alias("cds_size"))
    best = scripts.join(per, "script").groupBy("gene_key").agg(F.max_by(F.struct("exons", "cds"), F.struct("cds_size", -F.col("ordinal"))).alias("m"))
    return genes.join(best, "gene_key").select("gene", "seqid", "strand", "gene_start", "gene_stop", "m.exons", "m.cds")


def read_obo(spark: SparkSession, path: str) -> DataFrame:
    """(go_id, go_name, go_namespace, is_obsolete) of the Term stanzas."""
    rows = spark.read.option("lineSep", "\n[").text(path).where("startswith(value, 'Term]')")
    field = lambda k: F.nullif(F.trim(F.regexp_extract("value", rf"(?m)^{k}:\s*(.*)$", 1)), F.lit(""))
    return rows.select(field("id").alias("go_id"), field("name").alias("go_name"), field("namespace").alias("go_namespace"), (F.coalesce(field("is_obsolete"), F.lit("false")) == "true").alias("is_obsolete"))


def read_manifest(spark: SparkSession, path: str, header: bool = False, names: tuple[str, ...] = ()) -> DataFrame:
    """Tab-separated manifest lines without # comments and blank lines."""
    rows = spark.read.option("sep", "\t").option("comment", "#").option("header", header).option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).csv(path)
    return rows.toDF(*names) if names else rows


def read_per_file(spark: SparkSession, pattern: str, key_pattern: str, schema: str, sep: str = "\t") -> DataFrame:
    """All files of a glob with the part of the file name (of the path, if it has a slash) that ``key_pattern`` captures as file_key."""
    rows = spark.read.schema(schema).option("sep", sep).option("header", True).csv(pattern)
    return rows.withColumn("file_key", F.regexp_extract(F.col("_metadata.file_path" if "/" in key_pattern else "_metadata.file_name"), key_pattern, 1))


def read_json_fragments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).json(path)


def schema_of(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)
