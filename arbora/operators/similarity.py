"""Similarity hits: filters, best and reciprocal hits, local clusters, exact pairings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arbora.operators.graphs import components
from arbora.operators.skew import numbered_rows, stage


def strong_hits(hits: DataFrame, query: str, subject: str, evalue: str, most: float = 1e-60) -> DataFrame:
    """Hits other than on oneself whose e-value is zero or at most ``most``."""
    return hits.where((F.col(query) != F.col(subject)) & ((F.col(evalue) == 0) | (F.col(evalue) <= most)))


def is_self_hit(least_coverage: float = 0.95) -> Column:
    """Full identity without mismatch or gap over nearly all of the query."""
    return (F.col("pident") == 100) & (F.col("mismatch") == 0) & (F.col("gapopen") == 0) & ((F.col("qend") - F.col("qstart") + 1) / F.col("qlen") >= least_coverage)


def top_hits(hits: DataFrame, query: str, ordinal: str, self_hit: Column, subject: str, k: int = 10) -> DataFrame:
    """Per query, among its first ``k`` hits in order: how many, and the first hit on itself and on another."""
    rows = hits.withColumns({"_self": self_hit, "_k": F.row_number().over(Window.partitionBy(query).orderBy(ordinal))}).where(F.col("_k") <= k)
    first = lambda cond: F.min_by(F.when(cond, F.col(subject)), F.when(cond, F.col("_k")))
    return rows.groupBy(query).agg(F.count(F.lit(1)).alias("n_hits"), first(F.col("_self")).alias("self_hit"), first(~F.col("_self")).alias("other_hit"), F.min(F.when(~F.col("_self"), F.col("_k"))).alias("other_rank"))


def best_hits(scores: DataFrame, query: str, subject: str, score: str) -> DataFrame:
    """Each query's best subject; ties go to the smaller subject."""
    rank = F.row_number().over(Window.partitionBy(query).orderBy(F.desc(score), F.asc(subject)))
    return scores.withColumn("_r", rank).where("_r = 1").drop("_r")


def reciprocal_best(scores: DataFrame, a: str, b: str, score: str) -> DataFrame:
    """Pairs that are each other's best; scores: (a, b, score) of two sides."""
    there = best_hits(scores, a, b, score).select(a, b, score)
    back = best_hits(scores, b, a, score).select(a, b)
    return there.join(back, [a, b])


def reciprocal_keepers(forward: DataFrame, reverse: DataFrame, seeds: DataFrame, seed_sources: DataFrame) -> DataFrame:
    """Candidates whose reverse hit is a seed and that are neither a seed nor in a seed's own source set.

    forward: (candidate), reverse: (candidate, hit), seeds: (id), seed_sources: (id)."""
    ok = reverse.join(seeds.select(F.col("id").alias("hit")), "hit", "left_semi").select("candidate").distinct()
    kept = forward.select("candidate").distinct().join(ok, "candidate", "left_semi")
    return kept.join(seeds.select(F.col("id").alias("candidate")), "candidate", "left_anti").join(seed_sources.select(F.col("id").alias("candidate")), "candidate", "left_anti")


def homologs(hits: DataFrame, reverse: DataFrame, seeds: DataFrame, sources: DataFrame, keepers: DataFrame, sequences: DataFrame, taxon: Column) -> DataFrame:
    """(id, role, sequence): seeds, and the homologs found by them, with their whole sequences.

    hits: (query, subject, region), of seeds on candidates; reverse: (candidate, hit), of the candidates' regions on the
    seeds' own genomes; seeds: (id); sources: (id), all of the seeds' genomes; keepers: (taxon), species to keep;
    sequences: (id, sequence).  A candidate stays if a seed hits it, its region hits a seed back, it is no sequence of a
    seed's genome, and ``taxon`` (of the column candidate) is kept.
    """
    found = reciprocal_keepers(hits.select(F.col("subject").alias("candidate")), reverse, seeds, sources)
    kept = found.withColumn("taxon", taxon).join(keepers.select("taxon").distinct(), "taxon", "left_semi")
    both = seeds.select("id", F.lit("seed").alias("role")).unionByName(kept.select(F.col("candidate").alias("id"), F.lit("homolog").alias("role")))
    return both.join(sequences, "id").select("id", "role", "sequence")


def thresholds(hits: DataFrame, least: float = 95.0) -> DataFrame:
    """Hits with identity and both coverages at least ``least`` whose seed is not longer than its target."""
    return hits.where((F.col("identity") >= least) & (F.col("qcov") >= least) & (F.col("scov") >= least) & (F.col("seed_length") <= F.col("target_length")))


def unique_claims(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Pairs where a has one candidate and that candidate is claimed by no other."""
    of = lambda c: F.count(F.lit(1)).over(Window.partitionBy(c))
    pairs = pairs.select(a, b).distinct()
    return pairs.withColumns({"_na": of(a), "_nb": of(b)}).where("_na = 1 and _nb = 1").drop("_na", "_nb")


def optimal_assignment(pairs: DataFrame, block: str, a: str, b: str, score: str) -> DataFrame:
    """The one-to-one pairing of greatest total score in each block (a gene family, a genome), exact.

    Blocks run in parallel, each in one task; a block is a few hundred rows in use and must fit a task.
    """
    schema = pairs.select(block, a, b, score).schema

    def solve(pdf):
        import numpy as np

        rows, columns = sorted(pdf[a].unique()), sorted(pdf[b].unique())
        n = max(len(rows), len(columns))
        cost, known = np.zeros((n, n)), {}
        at_r, at_c = {x: i for i, x in enumerate(rows)}, {x: i for i, x in enumerate(columns)}
        for x, y, s in zip(pdf[a], pdf[b], pdf[score], strict=True):
            i, j = at_r[x], at_c[y]
            if (i, j) not in known or s > known[i, j]:
                known[i, j], cost[i, j] = s, -s
        # shortest augmenting paths with potentials
        u, v, match, way = np.zeros(n + 1), np.zeros(n + 1), np.zeros(n + 1, dtype=int), np.zeros(n + 1, dtype=int)
        for i in range(1, n + 1):
            match[0], j0 = i, 0
            least, used = np.full(n + 1, np.inf), np.zeros(n + 1, dtype=bool)
            while True:
                used[j0] = True
                free = np.flatnonzero(~used[1:]) + 1
                here = cost[match[j0] - 1, free - 1] - u[match[j0]] - v[free]
                better = here < least[free]
                least[free[better]], way[free[better]] = here[better], j0
                j1 = free[np.argmin(least[free])]
                delta = least[j1]
                u[match[used]] += delta
                v[used] -= delta
                least[~used] -= delta
                j0 = j1
                if match[j0] == 0:
                    break
            while j0:
                match[j0] = match[way[j0]]
                j0 = way[j0]
        out = [(pdf[block].iloc[0], rows[match[j] - 1], columns[j - 1], known[match[j] - 1, j - 1]) for j in range(1, n + 1) if (match[j] - 1, j - 1) in known]
        return type(pdf)(out, columns=schema.names)

    return pairs.select(block, a, b, score).groupBy(block).applyInPandas(solve, schema)


def seed_mapping(seeds: DataFrame, accessions: DataFrame, hits: DataFrame) -> DataFrame:
    """(seed, target, status): by accession, else by the only close hit, else by optimal assignment, else NOT_FOUND.

    seeds: (seed, accession), accessions: (accession, target), hits: (seed, target, identity, qcov, scov, seed_length,
    target_length, score).  Later steps see only seeds and targets that earlier ones left.  What is left is assigned by
    components of seeds and targets that hits connect, each in a task of its own.
    """
    direct = seeds.join(accessions, "accession").groupBy("seed").agg(F.min("target").alias("target")).withColumn("status", F.lit("ACCESSION"))
    left = thresholds(hits).join(direct, "seed", "left_anti").join(direct.select("target"), "target", "left_anti")
    alone = unique_claims(left, "seed", "target").withColumn("status", F.lit("UNIQUE"))
    more = left.join(alone, "seed", "left_anti").join(alone.select("target"), "target", "left_anti")
    more = stage(more, "contested")
    ends = more.select(F.concat(F.lit("s"), F.col("seed").cast("string")).alias("a"), F.concat(F.lit("t"), F.col("target").cast("string")).alias("b"))
    blocks = components(ends).select(F.col("node").alias("_node"), F.col("comp").alias("block"))
    more = more.join(blocks, F.concat(F.lit("s"), F.col("seed").cast("string")) == F.col("_node"))
    solved = optimal_assignment(more, "block", "seed", "target", "score").select("seed", "target", F.lit("ASSIGNED").alias("status"))
    found = direct.select("seed", "target", "status").unionByName(alone).unionByName(solved)
    return seeds.select("seed").join(found, "seed", "left").fillna("NOT_FOUND", ["status"])


def positions(genes: DataFrame, chromosome: str, *order: str) -> DataFrame:
    """Zero-based position along the chromosome."""
    return genes.withColumn("position", F.row_number().over(Window.partitionBy(chromosome).orderBy(*order)) - 1)


def neighbour_pairs(hits: DataFrame, placed: DataFrame, window: int = 20) -> DataFrame:
    """(chromosome, a, b): hits between genes of one chromosome at most half a window apart.

    hits: (query, subject); placed: (gene, chromosome, position).  Genes without a place drop out.
    """
    q = placed.select(F.col("gene").alias("query"), F.col("chromosome").alias("c1"), F.col("position").alias("p1"))
    s = placed.select(F.col("gene").alias("subject"), F.col("chromosome").alias("c2"), F.col("position").alias("p2"))
    near = hits.select("query", "subject").join(q, "query").join(s, "subject")
    return near.where((F.col("c1") == F.col("c2")) & (F.abs(F.col("p1") - F.col("p2")) <= window // 2) & (F.col("query") != F.col("subject"))).select(F.col("c1").alias("chromosome"), F.col("query").alias("a"), F.col("subject").alias("b"))


def unplaced(hits: DataFrame, placed: DataFrame) -> DataFrame:
    """One row: hits dropped because the query or the subject has no place."""
    here = placed.select("gene")
    q = hits.join(here.withColumnRenamed("gene", "query"), "query", "left_anti").agg(F.count(F.lit(1)).alias("query_unplaced"))
    s = hits.join(here.withColumnRenamed("gene", "subject"), "subject", "left_anti").agg(F.count(F.lit(1)).alias("subject_unplaced"))
    return q.crossJoin(s)


def hotspots(hits: DataFrame, genes: DataFrame, window: int = 20, least: int = 2, species: str = "species") -> DataFrame:
    """Local clusters: connected near neighbours of a chromosome, numbered along it.

    genes: (species, gene, chromosome, start, stop).  hotspot_end is that of the last gene by (start, stop); the
    greatest end is given as max_end.
    """
    if least < 2:
        raise ValueError("a cluster has two genes at least")
    order = Window.partitionBy(species, "gene").orderBy("start", "stop")
    once = genes.withColumn("_k", F.row_number().over(order)).where("_k = 1").drop("_k")
    placed = once.withColumn("position", F.row_number().over(Window.partitionBy(species, "chromosome").orderBy("start", "stop", "gene")) - 1)
    key = placed.select(F.concat_ws("\x1f", species, "chromosome").alias("chromosome"), F.concat_ws("\x1f", species, "gene").alias("gene"), "position", species, F.col("gene").alias("_gene"), F.col("chromosome").alias("_chromosome"), "start", "stop")
    named = hits.select(F.concat_ws("\x1f", species, "query").alias("query"), F.concat_ws("\x1f", species, "subject").alias("subject"))
    member = components(neighbour_pairs(named, key, window), "a", "b").join(key, F.col("node") == F.col("gene")).drop("gene", "chromosome")
    last = F.max_by("stop", F.struct("start", "stop"))
    ids = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "stop", "_gene"))), lambda x: x["_gene"]), ",")
    spots = member.groupBy(species, F.col("_chromosome").alias("chromosome"), "comp").agg(F.count(F.lit(1)).alias("genes"), F.min("start").alias("hotspot_start"), last.alias("hotspot_end"), F.max("stop").alias("max_end"), ids.alias("gene_ids"))
    spots = spots.where(F.col("genes") >= least)
    number = F.row_number().over(Window.partitionBy(species).orderBy("chromosome", "hotspot_start", "hotspot_end", "gene_ids"))
    return spots.withColumn("hotspot_id", F.concat(F.col(species), F.lit("_w"), F.lit(window), F.lit("_"), F.lpad(number.cast("string"), 5, "0"))).drop("comp")


def islands(rows: DataFrame, key: list[str], position: str, radius: int, least: int = 2) -> DataFrame:
    """Components where every two rows of a key within ``radius`` are linked: a gap over it starts a new one.  No pairs are made."""
    order = Window.partitionBy(*key).orderBy(position)
    fresh = F.when(F.col(position) - F.lag(position).over(order) <= radius, 0).otherwise(1)
    rows = rows.withColumn("_f", fresh).withColumn("_i", F.sum("_f").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(*key, "_i").agg(F.count(F.lit(1)).alias("members"), F.min(position).alias("first"), F.max(position).alias("last")).where(F.col("members") >= least).drop("_i")


def species_summary(spots: DataFrame, manifest: DataFrame, species: str = "species") -> DataFrame:
    """Per species clusters and genes in them, EXCLUDED where the manifest marks it, and a totals row (null species)."""
    per = spots.groupBy(species).agg(F.count(F.lit(1)).alias("hotspots"), F.sum("genes").alias("genes"), F.max("genes").alias("largest"))
    out = manifest.join(per, species, "left").fillna(0, ["hotspots", "genes", "largest"])
    out = out.withColumn("status", F.when(F.col("excluded"), "EXCLUDED").otherwise("PROCESSED"))
    total = out.agg(F.lit(None).cast("string").alias(species), F.lit(False).alias("excluded"), F.sum("hotspots").alias("hotspots"), F.sum("genes").alias("genes"), F.max("largest").alias("largest"), F.lit("TOTAL").alias("status"))
    return out.unionByName(total.select(*out.columns)).drop("excluded")


def deal(rows: DataFrame, parts: int, *order: str) -> DataFrame:
    """An even split in order: the first (n mod parts) parts hold one row more."""
    n = rows.count()
    size, more = divmod(n, parts)
    k = numbered_rows(rows, "_number", *order)
    early = F.expr(f"_number div {size + 1}")
    late = F.lit(more) + F.expr(f"(_number - {more * (size + 1)}) div {max(size, 1)}")
    return k.withColumn("part", (F.when(F.col("_number") < more * (size + 1), early).otherwise(late) + 1).cast("int")).drop("_number")


def deal_within(rows: DataFrame, size: int, by: list[str], *order: str) -> DataFrame:
    """Chunks of a fixed size in order, within each key."""
    return rows.withColumn("chunk", F.expr(f"(row_number() over (partition by {', '.join(by)} order by {', '.join(order)}) - 1) div {size}"))


def missing_chunks(expected: DataFrame, found: DataFrame, *keys: str) -> DataFrame:
    return expected.select(*keys).distinct().join(found.select(*keys).distinct(), list(keys), "left_anti")


def subsequences(hits: DataFrame, sequences: DataFrame, legacy_end: bool = False) -> DataFrame:
    """(subject, region): the hit's part of the sequence, of the last hit by ordinal; the legacy end leaves out the last residue."""
    last = hits.groupBy("subject").agg(F.max_by(F.struct("sstart", "send"), "ordinal").alias("h"))
    length = F.col("h.send") - F.col("h.sstart") + (0 if legacy_end else 1)
    return last.join(sequences, F.col("subject") == F.col("id")).select("subject", F.substring(F.col("sequence"), F.col("h.sstart"), F.greatest(length, F.lit(0))).alias("region"))


#: Rows a side of a cell of the grid on which a query set is compared with all rows.
GRID_ROWS = 4_096


def similar_to(queries: DataFrame, vectors: DataFrame, key: str, vector: str, least: float) -> DataFrame:
    """(query, subject, cosine): subjects at least ``least`` alike, to six places, of a stated query set, out of all vectors.

    Queries and vectors are dealt to blocks of about GRID_ROWS by hash, and each cell of the grid of blocks is one
    product of two matrices; so a task holds two blocks and what is alike in them, however many rows there are.
    """
    across, down = (max(1, -(-df.count() // GRID_ROWS)) for df in (queries, vectors))
    block = lambda n, name: F.pmod(F.xxhash64(key), F.lit(n)).cast("int").alias(name)
    every = lambda n, name: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    values = F.col(vector).cast("array<double>").alias("v")
    a = queries.select(F.col(key).alias("k"), values, block(across, "x"), every(down, "y"))
    b = vectors.select(F.col(key).alias("k"), values, block(down, "y"), every(across, "x"))
    id_type = vectors.schema[key].dataType.simpleString()

    def cell(left, right):
        import numpy as np

        empty = type(left)({"query": left["k"].iloc[:0], "subject": left["k"].iloc[:0], "cosine": np.zeros(0)})
        if not len(left) or not len(right):
            return empty
        p, q = np.stack(left["v"].to_list()), np.stack(right["v"].to_list())
        norm = lambda m: np.sqrt(np.cumsum(m * m, 1)[:, -1])
        n, m = norm(p), norm(q)
        with np.errstate(invalid="ignore", divide="ignore"):
            i, j = np.nonzero(p @ q.T / np.outer(n, m) >= least - 1e-6)  # what rounding can lift to the least
            i, j = (z[left["k"].to_numpy()[i] != right["k"].to_numpy()[j]] for z in (i, j))
            cosine = np.concatenate([np.zeros(0), *(np.cumsum(p[i[s : s + 8192]] * q[j[s : s + 8192]], 1)[:, -1] for s in range(0, len(i), 8192))]) / (n[i] * m[j])
        return type(left)({"query": left["k"].to_numpy()[i], "subject": right["k"].to_numpy()[j], "cosine": cosine})

    found = a.groupBy("x", "y").cogroup(b.groupBy("x", "y")).applyInPandas(cell, f"query {id_type}, subject {id_type}, cosine double")
    return found.select("query", "subject", F.bround("cosine", 6).alias("cosine")).where(F.col("cosine") >= least)
