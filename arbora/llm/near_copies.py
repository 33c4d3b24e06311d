"""Near copies: rows whose sets of five-word shingles have a Jaccard similarity of at least 0.8, and the classes they link.

Candidates come from two searches, and whole sets decide.  The first is the SimHash operator's: fingerprints of the
shingles, generalised pigeonhole, two differing bits.  At a similarity of 0.8 some ten of 64 bits differ, though, and
no allotment of ten bits to partitions of 64 is selective, so a second search probes partitions of another
fingerprint: the least values of BANDS * ROWS permutations of the shingles, in BANDS groups of ROWS, one of which two
similar sets share but for a chance of (1 - 0.8 ** ROWS) ** BANDS, 3 in a million at 0.8 and less above it.

Sets are first compared with one hub: the set of their buckets that shares most buckets with others.  Buckets that then
still hold different classes are compared set by set; pairs are sifted by size and by parity (1024 bits,
each the parity of the shingles that fall on it: sets differ by no fewer shingles than bits), which loses no pair.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arbora.llm import simhash  # for its search; tasks get functions, not modules
from arbora.llm.shared import chosen_rows, discard, lookup, materialize, quote
from arbora.llm.simhash import fingerprint
from arbora.operators.graphs import components

SEED = 42
SHINGLE = 5
BANDS, ROWS = 32, 5
WORDS = 16  # longs of parity
CHUNK = 1_024
SIGNATURE = "sid long, n int, fp long, bits array<long>, bands array<long>"


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct XXH64 of the five-word shingles of a whole text; a shorter text is one shingle, a blank one none."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []  # as in simhash
    if not words:
        return np.zeros(0, dtype=np.uint64)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    grams = zip(*[words[i:] for i in range(SHINGLE)]) if len(words) >= SHINGLE else [words]
    return np.unique(np.array([digest(join(g), SEED) for g in grams], dtype=np.uint64))


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Jaccard similarity of two sorted sets >= 0.8, in whole numbers."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 9 * both >= 4 * (len(a) + len(b))


def permutations() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Odd factors and offsets of the permutations of 32-bit values, and the factors that make keys of their minima."""
    rng = np.random.default_rng(SEED)
    n = BANDS * ROWS
    return rng.integers(0, 1 << 32, n, dtype=np.uint32) | np.uint32(1), rng.integers(0, 1 << 32, n, dtype=np.uint32), rng.integers(0, 1 << 63, (BANDS, ROWS + 1), dtype=np.uint64) | np.uint64(1)


def bands(sets: list[np.ndarray]) -> np.ndarray:
    """A row of BANDS keys for each set; sets are read in runs of CHUNK shingles."""
    factor, offset, mix = permutations()
    least = np.full((len(sets), BANDS * ROWS), np.uint32(0xFFFFFFFF))
    for i, s in enumerate(sets):
        x = (s >> np.uint64(32)).astype(np.uint32)
        for k in range(0, len(x), CHUNK):
            np.minimum(least[i], (x[k : k + CHUNK, None] * factor + offset).min(0), out=least[i])
    grouped = least.reshape(len(sets), BANDS, ROWS).astype(np.uint64)
    key = (grouped * mix[:, :ROWS]).sum(2, dtype=np.uint64) + mix[:, ROWS]
    return (key ^ (key >> np.uint64(31))).view(np.int64)


def signatures(texts: list[str | None]) -> pd.DataFrame:
    """Of each text: ``sid`` of the set, its size ``n``, SimHash ``fp``, parity ``bits`` and ``bands``."""
    import xxhash

    sets = [shingles(t) for t in texts]
    odd = np.stack([np.bincount((s & np.uint64(64 * WORDS - 1)).astype(np.int64), minlength=64 * WORDS) & 1 for s in sets]).astype(np.uint8)
    return pd.DataFrame({
        "sid": np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets], dtype=np.uint64).view(np.int64), "n": [len(s) for s in sets],
        "fp": np.array([fingerprint(s) for s in sets], dtype=np.uint64).view(np.int64), "bits": list(np.packbits(odd, axis=1).view(np.int64)), "bands": list(bands(sets)),
    })


def with_signature(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with the columns of SIGNATURE in place of the text."""
    made = F.pandas_udf(lambda texts: signatures(texts.tolist()), SIGNATURE)
    return docs.withColumn("_signature", made(F.col(text))).drop(text).select("*", "_signature.*").drop("_signature")


def _sift(a: str, b: str) -> Column:
    """Sizes and parities that do not rule a similarity of 0.8 out: sets may differ by a ninth of their sizes' sum."""
    n, m = F.col(f"{a}n"), F.col(f"{b}n")
    apart = sum((F.bit_count(F.col(f"{a}p{i}").bitwiseXOR(F.col(f"{b}p{i}"))) for i in range(WORDS)), F.lit(0))
    return (5 * n >= 4 * m) & (5 * m >= 4 * n) & (9 * apart <= n + m)


def _named(df: DataFrame, head: str) -> DataFrame:
    return df.select(*[F.col(c).alias(head + c) for c in df.columns])


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of set ids whose whole ``sets`` (sid, s) are similar, written.

    The sets of ``b`` travel with the pairs; a hub that is ``a`` of very many of them is looked up in a broadcast.
    """

    def check(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(a, b, strict=True)], dtype=bool)

    right = pairs.join(sets.select(F.col("sid").alias("b"), F.col("s").alias("b_s")), "b")
    both = lookup(right, sets.select(F.col("sid").alias("a"), F.col("s").alias("a_s")), "a", pairs.count())
    return materialize(both.where(F.pandas_udf(check, "boolean")("a_s", "b_s")).select("a", "b"), "links")


def hub_pairs(postings: DataFrame) -> DataFrame:
    """(a, b): of each set of ``postings`` (key, sid, many) the hub of its buckets that shares most buckets with others."""
    degree = postings.groupBy("sid").agg(F.sum("many").alias("degree"))
    known = materialize(postings.join(degree, "sid"), "degrees")
    hubs = known.groupBy("key").agg(F.max(F.struct("degree", "sid")).alias("hub"))
    best = known.join(hubs, "key").groupBy("sid").agg(F.max("hub").alias("hub"))
    return best.select(F.col("hub.sid").alias("a"), F.col("sid").alias("b")).where("a <> b")


def links(sets: DataFrame, texts) -> DataFrame:
    """Links (a, b) of set ids whose closure is that of all similar pairs of ``sets``, distinct rows of SIGNATURE, written.

    ``texts``: from a table of needed ``sid`` to one of (sid, text).
    """
    some = sets.where("n > 0")
    # the operator's own candidates: prints within two bits, and sets of one print; crowded buckets are left to the bands
    first = materialize(some.groupBy("fp").agg(F.min("sid").alias("least"), F.count(F.lit(1)).alias("sets")), "prints")
    near = simhash.links(first.select("fp"), first.count(), large=False)
    at = lambda c, name: first.select(F.col("fp").alias(c), F.col("least").alias(name))
    found = near.withColumnsRenamed({"a": "x", "b": "y"}).join(at("x", "a"), "x").join(at("y", "b"), "y").select("a", "b")
    twins = some.select("sid", "fp").join(first.where("sets > 1"), "fp").where("sid <> least").select(F.col("least").alias("a"), F.col("sid").alias("b"))

    rows = some.select("sid", F.explode("bands").alias("key"))
    shared = materialize(rows.groupBy("key").agg(F.count(F.lit(1)).alias("many")).where("many > 1"), "buckets")
    postings = materialize(rows.join(shared, "key"), "postings")
    pairs = hub_pairs(postings).unionByName(found).unionByName(twins)
    pairs = materialize(pairs.distinct(), "pairs")
    sizes = some.select("sid", "n")
    fits = pairs.join(_named(sizes, "a_"), F.col("a") == F.col("a_sid")).join(_named(sizes, "b_"), F.col("b") == F.col("b_sid")).where("5 * a_n >= 4 * b_n and 5 * b_n >= 4 * a_n")
    # the sets of all candidates, of both rounds, are made once
    needed = reduce(DataFrame.unionByName, [postings.select("sid"), *(pairs.select(F.col(c).alias("sid")) for c in "ab")]).distinct()
    whole = F.pandas_udf(lambda ts: pd.Series([shingles(t).tobytes() for t in ts]), "binary")
    wholes = materialize(texts(needed).select("sid", whole("text").alias("s")), "wholes")
    stars = _verified(materialize(fits.select("a", "b"), "fits"), wholes)

    comps = components(stars).withColumnRenamed("node", "sid")
    left = postings.join(comps, "sid", "left").withColumn("comp", F.coalesce("comp", "sid"))
    open_ = left.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("key")
    facts = some.select("sid", "n", *[F.col("bits")[i].alias(f"p{i}") for i in range(WORDS)])
    left = materialize(left.join(open_, "key", "left_semi").join(facts, "sid").drop("many"), "undecided")
    a, b = _named(left, "a_"), _named(left, "b_")
    apart = (F.col("a_key") == F.col("b_key")) & (F.col("a_sid") < F.col("b_sid")) & (F.col("a_comp") != F.col("b_comp"))
    rest = a.join(b, apart & _sift("a_", "b_")).select(F.col("a_sid").alias("a"), F.col("b_sid").alias("b")).distinct()
    rest = rest.join(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti")
    out = materialize(stars.unionByName(_verified(materialize(rest, "rest"), wholes)), "all_links")
    discard(first, near, shared, postings, pairs, stars, left, wholes)
    return out


def drop_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class of near copies, with all columns: that with the smallest id; null ids come last.

    Null, empty and blank texts are one class.  Ids need not be unique: classes are made of texts, and of rows with one
    id and one text the least by the other columns stays.  Very long texts are read whole, in runs of shingles.
    """
    key = F.xxhash64(F.coalesce(F.col(quote(text)), F.lit("")))  # of the text; with the id it names a row, or rows that say the same
    plain = docs.select(F.col(quote(doc_id)).alias("id"), key.alias("th"), F.col(quote(text)).alias("text"))
    rows = materialize(with_signature(plain, "text"), "signatures")
    sets = materialize(rows.drop("id", "th").dropDuplicates(["sid"]), "sets_once")
    named = materialize(rows.groupBy("sid").agg(F.min_by(F.struct("id", "th"), F.struct(F.col("id").isNull(), "id", "th")).alias("at")).select("sid", "at.*"), "places")

    def texts(needed: DataFrame) -> DataFrame:
        at = named.join(needed, "sid").select("sid", F.col("id").alias("_id"), F.col("th").alias("_th"))
        return plain.join(at, (F.col("th") == F.col("_th")) & F.col("id").eqNullSafe(F.col("_id"))).select("sid", "text").dropDuplicates(["sid"])

    found = components(links(sets, texts))
    of_set = named.join(found.withColumnRenamed("node", "sid"), "sid", "left").withColumn("comp", F.coalesce("comp", "sid"))
    best = of_set.groupBy("comp").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "th")).alias("best"))
    out = chosen_rows(docs, doc_id, key, best.select("best.id", "best.th"), rows.select("id", "th"))
    discard(rows, sets, named)
    return out
