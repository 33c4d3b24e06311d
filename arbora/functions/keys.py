"""Composite entity ids ``g_<gene>-t_<transcript>-p_<protein>-n_<taxon path>``, taxon paths and names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arbora.operators.skew import numbered_rows

RANKS = ("kingdom", "phylum", "class", "order", "family")


def build_id(raw: Column, taxon: Column, separator: str = "|") -> Column:
    """From ``gene|transcript|protein``: slashes become underscores; of more than three parts the last two are transcript
    and protein, and all before them the gene; of fewer, what is missing repeats the gene."""
    parts = F.split(F.translate(raw, "/", "_"), F.lit("\\" + separator))
    n = F.size(parts)
    gene = F.when(n > 3, F.array_join(F.slice(parts, 1, F.greatest(n - 2, F.lit(1))), separator)).otherwise(F.get(parts, F.lit(0)))
    transcript = F.when(n >= 3, F.get(parts, n - 2)).otherwise(F.coalesce(F.get(parts, F.lit(1)), gene))
    protein = F.when(n >= 3, F.get(parts, n - 1)).otherwise(F.coalesce(F.get(parts, F.lit(1)), gene))
    return F.concat(F.lit("g_"), gene, F.lit("-t_"), transcript, F.lit("-p_"), protein, F.lit("-n_"), taxon)


def taxon_of(entity: Column, last: bool = True) -> Column:
    """After ``-n_``: after the last one, or (``last`` false) the part between the first and the second."""
    return F.substring_index(entity, "-n_", -1) if last else F.get(F.split(entity, "-n_"), F.lit(1))


def gene_of(entity: Column) -> Column:
    """The first dash-separated token that starts with g_, without it; so a dash inside a gene id cuts it."""
    token = F.get(F.filter(F.split(entity, "-"), lambda x: x.startswith("g_")), F.lit(0))
    return F.substring(token, 3, 1 << 30)


def rank_of(taxon: Column, rank: str) -> Column:
    return F.get(F.split(taxon, "_"), F.lit(RANKS.index(rank)))


def genus_of(taxon: Column) -> Column:
    return F.get(F.split(taxon, "_"), F.lit(5))


def species_of(taxon: Column) -> Column:
    """Genus_species...: all after the five upper ranks."""
    return F.array_join(F.slice(F.split(taxon, "_"), 6, 1 << 20), "_")


def bare_name(node: Column) -> Column:
    """Without its C<digits>_ prefix."""
    return F.regexp_replace(node, r"^C\d+_", "")


def after_first_underscore(node: Column) -> Column:
    return F.regexp_replace(node, r"^[^_]*_", "")


def short_label(taxon: Column) -> Column:
    """``Phylum Genus species``; a phylum with a digit gives way to the first rank that has none."""
    parts = F.split(taxon, "_")
    name = F.get(F.filter(F.slice(parts, 2, 4), lambda x: ~x.rlike("[0-9]")), F.lit(0))
    return F.concat_ws(" ", name, F.array_join(F.slice(parts, 6, 1 << 20), " "))


def clean_text(c: Column) -> Column:
    return F.trim(F.translate(c, "\t\r\n", "   "))


def clean_taxon_word(c: Column) -> Column:
    """Characters that a path or id cannot hold become one underscore."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"[ /\\()\[\]:;,'\"-]", "_"), "_+", "_"), F.lit("_"))


def clean_group_name(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]", "_"), "_+", "_"), F.lit("_"))


def version_dot(accession: Column) -> Column:
    """``NP_006133_1`` to ``NP_006133.1``."""
    return F.regexp_replace(accession, r"^([A-Z]{2}_\d+)_(\d+)$", "$1.$2")


def probability_of(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, r"probability=([0-9.eE+-]+)", 1), F.lit("")).try_cast("double")


def last_bar(c: Column) -> Column:
    return F.substring_index(c, "|", -1)


def residue_count(sequence: Column, residue: str) -> Column:
    return (F.length(sequence) - F.length(F.replace(sequence, F.lit(residue), F.lit("")))).cast("long")


def residue_percent(sequence: Column, residue: str) -> Column:
    return F.when(F.length(sequence) > 0, F.bround(100.0 * residue_count(sequence, residue) / F.length(sequence), 2)).otherwise(F.lit(0.0))


def valid_residues(sequence: Column, invalid: str, by: str = "X") -> Column:
    return F.translate(sequence, invalid, by * len(invalid))


def invalid_residues(rows: DataFrame, key: str, sequence: str, allowed: str = "A-Za-z*") -> DataFrame:
    """(key, position from 1, residue) of every character that is not allowed."""
    hits = rows.where(F.col(sequence).rlike(f"[^{allowed}]")).select(key, F.posexplode(F.split(sequence, "")).alias("position", "residue"))
    return hits.where(F.col("residue").rlike(f"[^{allowed}]")).select(key, (F.col("position") + 1).cast("long").alias("position"), "residue")


def short_ids(rows: DataFrame, key: str, prefix: str = "s") -> DataFrame:
    """(key, short_id): a dictionary of distinct keys; the order of keys gives the numbers."""
    numbered = numbered_rows(rows.select(key).distinct(), "_number", key)
    return numbered.select(key, F.concat(F.lit(prefix), (F.col("_number") + 1).cast("string")).alias("short_id"))


def decode_ids(rows: DataFrame, dictionary: DataFrame, short: str, key: str) -> DataFrame:
    return rows.join(dictionary.withColumnRenamed("short_id", short), short).drop(short).select(key, *[c for c in rows.columns if c != short])


def unknown_clades(rows: DataFrame, ranks: list[str], ordinal: str, prefix: str = "unknown") -> DataFrame:
    """Empty ranks get a numbered name; rows alike in rank and first named rank below share the number, which counts in order of ordinal."""
    out = rows
    for i, rank in enumerate(ranks):
        below = F.coalesce(*[F.nullif(F.trim(F.col(r)), F.lit("")) for r in ranks[i + 1 :]], F.lit(""))
        gap = F.coalesce(F.trim(F.col(rank)), F.lit("")) == ""
        out = out.withColumns({"_below": below, "_gap": gap})
        firsts = out.where("_gap").groupBy("_below").agg(F.min(ordinal).alias("_o"))
        numbered = numbered_rows(firsts, "_n", "_o").select("_below", (F.col("_n") + 1).alias("_number"))
        out = out.join(numbered, "_below", "left")
        out = out.withColumn(rank, F.when(F.col("_gap"), F.concat(F.lit(f"{prefix}_{rank}_"), F.col("_number").cast("string"))).otherwise(F.col(rank))).drop("_below", "_gap", "_number")
    return out


def mark_unofficial(user: Column, official: Column, suffix: str = "UNOFFICIAL") -> Column:
    """Suffix on each of the five upper ranks of a user's taxon path that differs from the official one; never twice, and
    paths of fewer than seven parts stay."""
    a, b = F.split(user, "_"), F.split(official, "_")
    marked = F.transform(a, lambda x, i: F.when((i < 5) & ~F.coalesce(x == F.get(b, i), F.lit(False)) & ~x.endswith(suffix), F.concat(x, F.lit(suffix))).otherwise(x))
    return F.when(F.size(a) < 7, user).otherwise(F.array_join(marked, "_"))
