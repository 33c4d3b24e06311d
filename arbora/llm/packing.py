"""Packing of tokenised documents into sequences: vector best-fit under several capacities.

A piece of l tokens asks for the vector (l tokens, 1 document, l * l attention cost); a sequence offers the residual
of each capacity.  As the vector depends on the length alone, best-fit decreasing is run on the histogram of lengths
(one row a length, so bounded by the token capacity), for runs of alike sequences at once.  The result is a list of
slots (length, ranks from-to, sequence, offset); each piece finds its own by its rank among the pieces of its length.
The corpus itself never meets in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arbora.llm.shared import materialize, write_buckets
from arbora.llm.tokens import slices

CAPACITY = 1024
END = 2
#: Fixed value: how byte-level BPE cuts a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Capacities(NamedTuple):
    tokens: int = CAPACITY
    documents: int = CAPACITY
    attention: int = CAPACITY * CAPACITY


class Slots(NamedTuple):
    """Pieces of length[i] with ranks first[i] to first[i] + n[i] - 1 lie at offset[i] of sequences sequence[i] and on."""

    length: np.ndarray
    first: np.ndarray
    n: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray


def plan(histogram: dict[int, int], caps: Capacities = Capacities(), weights: tuple[float, float, float] | None = None, rule: str = "norm") -> Slots:
    """Best-fit decreasing.  Of the open sequences with room in every capacity, rule "norm" takes that whose weighted
    residual vector would be shortest, rule "dot" that whose residual has the least weighted dot product with the piece.
    Without ``weights`` each capacity weighs by how far all pieces together exhaust it.
    """
    cap = np.array(caps, dtype=float)
    demand = sum((n * np.array([x, 1.0, x * x]) / cap for x, n in histogram.items()), np.zeros(3))
    w = np.array(weights) if weights else demand / max(demand.max(initial=0.0), 1e-12)
    res, many, base, fill = np.zeros((0, 3), dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    slots: list[tuple[int, int, int, int, int]] = []
    opened = 0

    def place(length: int, rank: int, groups: int, each: int, sequence: int, offset: int) -> None:
        slots.extend((length, rank + j * groups, groups, sequence, offset + j * length) for j in range(each))

    for length in sorted(histogram, reverse=True):
        left, rank, item = histogram[length], 0, np.array([length, 1, length * length])
        if (item > cap).any():
            raise ValueError(f"a piece of {length} tokens exceeds a capacity")
        while left > 0:
            room = np.flatnonzero((res >= item).all(1))
            if len(room):
                after, now = (res[room] - item) / cap, res[room] / cap
                score = (w * after * after).sum(1) if rule == "norm" else (w * now * (item / cap)).sum(1)
                g = int(room[np.argmin(score)])
                each = min(int((res[g] // item).min()), left)
                took = min(int(many[g]), left // each)
                place(length, rank, took, each, int(base[g]), int(fill[g]))
                if took < many[g]:  # the rest of the run stays as it was
                    res, many = np.vstack([res, res[g]]), np.append(many, many[g] - took)
                    base, fill = np.append(base, base[g] + took), np.append(fill, fill[g])
                res[g] -= each * item
                many[g], fill[g] = took, fill[g] + each * length
            else:
                each = min(int((cap // item).min()), left)
                took = left // each
                place(length, rank, took, each, opened, 0)
                res, many = np.vstack([res, cap.astype(np.int64) - each * item]), np.append(many, took)
                base, fill = np.append(base, opened), np.append(fill, each * length)
                opened += took
            rank, left = rank + took * each, left - took * each
        open_ = (res[:, 0] > 0) & (res[:, 1] > 0) & (res[:, 2] > 0)
        res, many, base, fill = res[open_], many[open_], base[open_], fill[open_]
    columns = np.array(slots, dtype=np.int64).reshape(-1, 5)
    columns = columns[np.lexsort((columns[:, 1], columns[:, 0]))]
    return Slots(*columns.T)


class Encoder:
    """Token ids of texts under a byte-level BPE file of the tokenizers library.

    The file's own vocabulary is run by the tiktoken engine, which gives the same ids (tests hold it against the
    library itself) in a fifth of the time: a token's rank among the merges is its id.  With ``added`` the file's added
    tokens are single ids where a text spells them, as the library has it by default; else they are text like any other.
    Texts that spell them, and those with white space in runs too long for the engine, go to the library, and so does
    every text under a file that cuts or merges in another way.
    """

    def __init__(self, path: str, added: bool = False):
        import json
        import re

        import tiktoken
        from tokenizers import Tokenizer

        data = json.loads(open(path, encoding="utf-8").read())
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves in the file
        octet = {chr(x): x for x in shown} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in shown)}
        special = {t["content"] for t in data.get("added_tokens", [])}
        ranks = {bytes(octet[c] for c in token): i for token, i in data["model"]["vocab"].items() if token not in special}
        cut, model = data.get("pre_tokenizer") or {}, data["model"]
        merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        plain = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space") and not data.get("normalizer")
        #: whether the file is one that the engine runs alike: this cutting rule, and ids in the order of merges
        self.alike = plain and model["type"] == "BPE" and all(a < b for a, b in zip(merged, merged[1:])) and not model.get("ignore_merges")  # noqa: RUF007
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = not added
        self.added = sorted(special) if added else []
        self.coder = self.alike and tiktoken.Encoding(re.sub(r"\W", "_", path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by END, and where each text's ids start (one more than texts)."""
        each = [x for t in texts for x in (self.one(t), [END])]
        bounds = np.zeros(len(texts) + 1, dtype=np.int64)
        np.cumsum([len(x) + 1 for x in each[::2]], out=bounds[1:])
        return np.concatenate(each).astype(np.uint32), bounds

    def one(self, text: str) -> np.ndarray:
        if self.alike and not any(token in text for token in self.added):
            try:
                return self.coder.encode_to_numpy(text, disallowed_special=())
            except ValueError:  # the engine's expression gives up on a million white-space characters in a row
                pass
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


PIECES = pa.schema([("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32()), ("ids_crc32", pa.int64()), ("part", pa.int32()), ("rank", pa.int64())])
PIECES_SQL = "piece int, start long, length int, ids_crc32 long, part int, rank long"


def pieces_of(docs: DataFrame, path: str, capacity: int = CAPACITY, added: bool = False) -> DataFrame:
    """doc_id and a row a piece: its document's ids before it, its length and checksum, the task that cut it and its rank there.

    A document is cut only if longer than ``capacity``: into pieces of that length, the first of which may be shorter.
    """
    id_type = docs.schema["doc_id"].dataType

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        from pyspark import TaskContext

        encoder, part = Encoder(path, added), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            keys = batch.column(0)
            for first, run in slices(batch.column(1).to_pylist()):
                ids, bounds = encoder(run)
                rows, out = [], []
                for i in range(len(run)):
                    a, b = int(bounds[i]), int(bounds[i + 1])
                    cuts = [a, *range(a + ((b - a) % capacity or capacity), b, capacity), b]
                    for k in range(len(cuts) - 1):
                        x, y = cuts[k], cuts[k + 1]
                        rows.append(first + i)
                        out.append((k, x - a, y - x, zlib.crc32(ids[x:y].astype("<u4").tobytes()), part, int(seen[y - x])))
                        seen[y - x] += 1
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), PIECES.types, strict=True)]
                yield pa.RecordBatch.from_arrays([keys.take(pa.array(rows)), *columns], names=["doc_id", *PIECES.names])

    return docs.select("doc_id", "text").mapInArrow(cut, f"doc_id {id_type.simpleString()}, {PIECES_SQL}")


def pack(docs: DataFrame, tokenizer: str, caps: Capacities = Capacities(), rule: str = "norm", added: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: a row a piece of each row of ``docs``.

    Null and empty texts are one piece of the end token.  Repeated rows and rows with a null id are packed like any
    other.  An empty table packs to none.  Other columns are not read.  ``added`` is that of ``Encoder``.
    """
    pieces = materialize(pieces_of(docs, tokenizer, caps.tokens, added), "pieces")
    counts = materialize(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "lengths")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # a row a length
    slots = docs.sparkSession.sparkContext.broadcast(tuple(plan(histogram, caps, rule=rule)))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("before"))
    buckets = write_buckets(offsets, "part", counts.count(), "offsets")  # a task looks up the few parts that it reads

    def seat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, first, _, sequence, offset = slots.value
        key, at, starts = length * (1 << 40) + first, -1, np.zeros(0, dtype=np.int64)
        for batch in batches:
            parts, lengths = (batch.column(i).to_numpy().astype(np.int64) for i in (5, 3))
            rank = batch.column(6).to_numpy().copy()
            cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(parts)]
            for x, y in zip(cuts, cuts[1:], strict=False):
                if y > x and parts[x] != at:
                    at, starts = int(parts[x]), np.zeros(caps.tokens + 1, dtype=np.int64)
                    for t in buckets.of(at, ["length", "before"]):
                        starts[t.column(0).to_numpy()] = t.column(1).to_numpy()
                rank[x:y] += starts[lengths[x:y]]
            i = np.searchsorted(key, lengths * (1 << 40) + rank, "right") - 1
            found = [pa.array(lengths), batch.column(4), pa.array(sequence[i] + rank - first[i]), pa.array(offset[i])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *found], names=[*batch.schema.names[:5], "sequence_id", "offset"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return pieces.mapInArrow(seat, f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
