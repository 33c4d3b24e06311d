"""SimHash near-duplicates: 64-bit fingerprints, generalised pigeonhole search, connected components.

Search: bits that vary together are grouped into partitions; a dynamic programme gives each partition its own
threshold, by candidate counts estimated on a bounded sample of fingerprints, so that the thresholds add up to
``tau - partitions + 1``.  A partition with threshold t becomes the masks that keep its bits but any t of them:
two fingerprints within ``tau`` bits agree under at least one mask.  Every distinct fingerprint is probed under
every mask.  Pairs in a bucket of up to ``pair_limit`` fingerprints are verified one by one; members of larger
buckets are linked exactly through the balls of radius one around them (65 rows each, at most 65 in a ball), so
the work stays linear in the number of fingerprints and no link is lost.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arbora.llm.shared import chosen_rows, discard, lookup, materialize, quote
from arbora.operators.graphs import components

SEED = 42
BITS = 64
TAU = 2
SHINGLE = 3
SAMPLE = 20_000
PAIR_LIMIT = 24
MOST_BALLS = 3
_OCTET_BITS = (np.arange(256)[:, None] >> np.arange(8)) & 1


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned fingerprint: a bit is 1 if set in over half the XXH64 of the word shingles; no word: 0."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []  # bytes: A-Z and the six ASCII spaces only
    if not words:
        return 0
    digest, join = xxhash.xxh64_intdigest, b" ".join
    shifted = [words[i:] for i in range(shingle)]
    hashes = [digest(join(s), SEED) for s in zip(*shifted)] if len(words) >= shingle else [digest(join(words), SEED)]
    return fingerprint(np.array(hashes, dtype=np.uint64))


def fingerprint(hashes: np.ndarray) -> int:
    """The bits that are set in over half the hashes (unsigned 64-bit); none: 0."""
    octets = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    seen = np.bincount((octets + np.arange(0, 2048, 256, dtype=np.int64)).ravel(), minlength=2048).reshape(8, 256)
    counts = (seen @ _OCTET_BITS).ravel()  # of bit 0 to 63
    return int(sum(1 << int(b) for b in np.flatnonzero(2 * counts > len(hashes))))


def with_fingerprint(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, name: str = "fingerprint") -> DataFrame:
    """Adds the fingerprint of every whole text as a signed long; null and blank texts get 0."""
    def batch(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([simhash(t, shingle) for t in texts], dtype=np.uint64).view(np.int64))

    return docs.withColumn(name, F.pandas_udf(batch, "long")(F.col(text)))


def correlated_partitions(bits: np.ndarray, parts: int) -> list[list[int]]:
    """Groups the columns of a 0/1 matrix into ``parts`` groups of nearly equal size, correlated ones together."""
    n = bits.shape[1]
    x = bits - bits.mean(0)
    scale = np.sqrt((x * x).sum(0)) + 1e-9
    near = np.abs(x.T @ x) / np.outer(scale, scale)
    free, groups = set(range(n)), []
    for p in range(parts):
        width = n // parts + (p < n % parts)
        group = [max(sorted(free), key=lambda b: near[b, sorted(free)].sum())]
        free.discard(group[0])
        while len(group) < width:
            group.append(max(sorted(free), key=lambda b: near[b, group].sum()))
            free.discard(group[-1])
        groups.append(sorted(group))
    return groups


def _mask(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def _pairs(values: np.ndarray) -> float:
    _, counts = np.unique(values, return_counts=True)
    return float((counts * (counts - 1.0) / 2).sum())


def allot(costs: list[list[float]], total: int) -> list[int]:
    """Thresholds from -1 up (``costs[i][t + 1]`` is partition i's cost at t) that add up to ``total`` at the least cost."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        grown: dict[int, tuple[float, list[int]]] = {}
        for s, (c, ts) in best.items():
            for t, extra in enumerate(row, start=-1):
                if s + t not in grown or c + extra < grown[s + t][0]:
                    grown[s + t] = (c + extra, [*ts, t])
        best = grown
    return best[total][1]


def plan_masks(sample: np.ndarray, total: int, tau: int = TAU, most_parts: int = 4) -> list[int]:
    """The masks to probe, for ``total`` distinct fingerprints of which ``sample`` (uint64) is a bounded sample."""
    n = len(sample)
    bits = ((sample[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(float) if n else np.zeros((1, BITS))
    scale, plans = (total / max(n, 1)) ** 2, []
    for parts in range(2, most_parts + 1):
        groups, costs = correlated_partitions(bits, parts), []
        for group in groups:
            row = [0.0]
            for t in range(tau + 1):
                keys = comb(len(group), t)
                if keys > 200:  # more rows than the balls need
                    row.append(float("inf"))
                    continue
                pairs = sum(_pairs(sample & np.uint64(_mask([b for b in group if b not in out]))) for out in combinations(group, t)) * scale
                pairs += keys * total * (total - 1.0) / 2 / 2.0 ** (len(group) - t)  # what chance adds, seen in the sample or not
                row.append(keys * total + 0.25 * min(pairs, 65.0 * total * keys))
            costs.append(row)
        ts = allot(costs, tau - parts + 1)
        plans.append((sum(row[t + 1] for row, t in zip(costs, ts, strict=True)), groups, ts))
    _, groups, ts = min(plans, key=lambda p: p[0])
    return [_mask([b for b in g if b not in out]) for g, t in zip(groups, ts, strict=True) if t >= 0 for out in combinations(g, t)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def links(prints: DataFrame, total: int, tau: int = TAU, pair_limit: int = PAIR_LIMIT, sample: int = SAMPLE, large: bool = True) -> DataFrame:
    """Links (a, b), a < b, whose closure is that of all pairs of ``prints`` (distinct column fp) within ``tau`` bits.

    Without ``large``, pairs that meet in buckets of over ``pair_limit`` only are left out, for callers that find them
    another way.  For any ``tau``; over MOST_BALLS bits large buckets are compared pair by pair, too, which costs the square of their size.
    """
    every = max(1, total // sample)
    got = prints.where(F.pmod(F.xxhash64("fp"), F.lit(every)) == 0).select("fp").toPandas()["fp"].to_numpy(np.int64).view(np.uint64)
    masks = plan_masks(np.sort(got), total, tau)
    keys = F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("long")) for m in masks])
    rows = prints.select("fp", F.posexplode(keys).alias("mask", "key"))
    sizes = materialize(rows.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
    crowded = materialize(rows.join(sizes, ["mask", "key"]), "crowded")
    small = crowded.where(F.col("n") <= pair_limit) if tau <= MOST_BALLS or not large else crowded
    a, b = small.withColumnRenamed("fp", "a"), small.withColumnRenamed("fp", "b")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= tau
    found = a.join(b, (a["mask"] == b["mask"]) & (a["key"] == b["key"]) & (F.col("a") < F.col("b")) & near).select("a", "b")
    if large and tau <= MOST_BALLS:
        found = found.unionByName(stars(crowded.where(F.col("n") > pair_limit).select("fp").distinct(), tau))
    out = materialize(found.distinct(), "links")
    discard(sizes, crowded)
    return out


def stars(prints: DataFrame, tau: int) -> DataFrame:
    """Links (a, b) whose closure is that of all pairs within ``tau`` bits, without comparing pairs.

    Prints within ``tau`` agree after the right ``tau - 2`` bits are cleared but for two, so that the balls of radius one
    around them meet (for one bit: after one is cleared).  All that share cleared bits and a point of their balls are
    within ``tau``, and are linked to the least of them.
    """
    if tau < 1:
        return prints.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    one = lambda c, i: c.bitwiseXOR(F.lit(_signed(1 << i)).cast("long"))
    cleared = [_mask(list(out)) for out in combinations(range(BITS), max(0, tau - 2) if tau > 1 else 1)]
    kept = F.explode(F.array(*[F.lit(_signed(~m & (1 << BITS) - 1)).cast("long") for m in cleared])).alias("kept")
    rows = prints.select("fp", kept).withColumn("at", F.col("fp").bitwiseAND(F.col("kept")))
    if tau > 1:
        rows = rows.select("fp", "kept", F.explode(F.array(F.col("at"), *[one(F.col("at"), i) for i in range(BITS)])).alias("at"))
    least = rows.groupBy("kept", "at").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return rows.join(least, ["kept", "at"]).select("a", F.col("fp").alias("b")).where("a < b").distinct()


def near_duplicate_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, tau: int = TAU) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fingerprint`` (16 hex digits), ``component_id``, ``n_copies``.

    ``component_id`` is the smallest id that links of at most ``tau`` differing bits reach; ``n_copies`` the rows with
    that very fingerprint.  Null, empty and blank texts have fingerprint zero and link like any other.  Rows with a
    null id stay, but are no representative: the component of rows that have no id among them is null.  Repeated rows
    stay repeated.  Other columns are not read.
    """
    rows = materialize(with_fingerprint(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", shingle, "fp").select("doc_id", "fp"), "fingerprints")
    return classes_of(rows, tau)


def classes_of(rows: DataFrame, tau: int = TAU) -> DataFrame:
    """The classes of written rows (doc_id, fp)."""
    prints = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n_copies")), "distinct")
    total, n_rows = prints.count(), rows.count()
    found = components(links(prints, total, tau))
    member = materialize(prints.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "n_copies", "first_id", F.coalesce("comp", "fp").alias("comp")), "members")
    first = member.groupBy("comp").agg(F.min("first_id").alias("component_id"))
    of_print = lookup(member.select("fp", "n_copies", "comp"), first, "comp", total).select("fp", "n_copies", "component_id")
    return lookup(rows, of_print, "fp", n_rows).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "n_copies")


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, tau: int = TAU) -> DataFrame:
    """One row of each near-duplicate class, with all columns: that with the smallest id; null ids come last.

    Classes are made of texts, so ids need not be unique: of rows with one id and one text the least by the other columns
    stays, and no class is lost.  Null, empty and blank texts are one class.
    """
    key = F.xxhash64(F.coalesce(F.col(quote(text)), F.lit("")))
    plain = docs.select(F.col(quote(doc_id)).alias("id"), key.alias("th"), F.col(quote(text)).alias("text"))
    rows = materialize(with_fingerprint(plain, "text", shingle, "fp").select("id", "th", "fp"), "fingerprints")
    prints = rows.groupBy("fp").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "th")).alias("best"))
    prints = materialize(prints, "distinct")
    found = components(links(prints.select("fp"), prints.count(), tau)).withColumnRenamed("node", "fp")
    best = prints.join(found, "fp", "left").groupBy(F.coalesce("comp", "fp").alias("comp")).agg(F.min("best").alias("best"))
    return chosen_rows(docs, doc_id, key, best.select("best.id", "best.th"), rows.select("id", "th"))
