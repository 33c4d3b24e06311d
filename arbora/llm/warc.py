"""WARC archives: an index of offsets written with the records, and coalesced byte-range reads.

Archives lie in the shared folder and are reached through pyarrow's file systems, so any store it knows will do.  A
task writes archives of its own, each under a new name; the index (archive, offset, length, url, digest ...) is
committed by Spark, so that what a lost attempt left is never read.  Each record is a gzip member of its own.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arbora.llm.shared import Buckets, lookup, materialize, new_path, write_buckets

DATE = "2020-01-01T00:00:00Z"
ARCHIVE_BYTES = 64 << 20
#: Reads are joined across gaps up to GAP, and hold at most RUN bytes (or one record).
GAP, RUN = 64 << 10, 8 << 20
#: Reading tasks: one an archive up to READERS of them, or of TASK_BYTES each.
READERS, TASK_BYTES = 2_000, 1 << 30
FATE = ["page_id", "sha1", "refers_to"]
URN = "urn:uuid:a2b0a000-0000-5000-"
INDEX = "archive string, offset long, length long, page_id long, url string, digest string, record_type string"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    """A fixed prefix and the id's 64 bits; a new id where there is none."""
    if page_id is None:
        return f"<urn:uuid:{uuid.uuid4()}>"
    x = f"{page_id & (1 << 64) - 1:016x}"
    return f"<{URN}{x[:4]}-{x[4:]}>"


def page_id_of(urn: str) -> int | None:
    if not urn.startswith(f"<{URN}"):
        return None
    x = int(urn[len(URN) + 1 : -1].replace("-", ""), 16)
    return x - (1 << 64) if x >> 63 else x


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> tuple[bytes, str]:
    """A response, or a revisit of the response of page ``refers_to``, as one gzip member; and the payload's digest."""
    digest, revisit = base32_sha1(payload), refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    uri = "".join(c if c > " " else f"%{ord(c):02X}" for c in url or "")
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Target-URI: {uri}", f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to)}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    whole = "\r\n".join(head).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"
    return gzip.compress(whole, 3, mtime=0), digest


def parse(member: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers and body of a gzip member; raises ValueError if it is not one whole record."""
    try:
        whole = zlib.decompressobj(31).decompress(member)
    except zlib.error as e:
        raise ValueError("no gzip member") from e
    head, _, rest = whole.partition(b"\r\n\r\n")
    fields = lambda lines: {k.decode(): v.strip().decode("utf-8", "replace") for k, _, v in (x.partition(b":") for x in lines)}
    version, *lines = head.split(b"\r\n")
    warc = fields(lines)
    size = int(warc.get("Content-Length", -1))
    if not version.startswith(b"WARC/") or rest[size:] != b"\r\n\r\n":
        raise ValueError("no whole WARC record")
    http, _, body = rest[:size].partition(b"\r\n\r\n")
    return warc, fields(http.split(b"\r\n")[1:]), body


def fates(pages: DataFrame) -> Buckets:
    """(part, page_id, sha1, refers_to) of all rows, in buckets by ``part``.

    ``part`` is the partition of ``pages`` that a row was read in, so that the task that reads it again finds what it
    needs in one bucket, and payloads need not travel.  ``refers_to`` is the smallest id of the payload.
    """
    rows = materialize(pages.select("page_id", F.sha1(F.coalesce("html", F.lit(""))).alias("sha1"), F.spark_partition_id().alias("part")), "digests")
    first = rows.groupBy("sha1").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    total = rows.count()
    return write_buckets(lookup(rows, first, "sha1", total), "part", total, "fates")


class Fates:
    """What becomes of the rows of one partition; rows that it was not told of, as the partition is another now, are sought in all buckets."""

    def __init__(self, buckets: Buckets, part: int):
        self.buckets = buckets
        self.known = {k: v for t in buckets.of(part, FATE) for k, v in self.cells(t)}

    @staticmethod
    def cells(t: pa.Table) -> Iterator[tuple[tuple, int | None]]:
        ids, digests, first = (t.column(i).to_pylist() for i in range(3))
        return zip(zip(ids, digests, strict=True), first, strict=True)

    def __call__(self, keys: list[tuple[int | None, str]]) -> list[int | None]:
        missing = {k for k in keys if k not in self.known}
        if missing:
            self.known.update({k: v for t in self.buckets.all(FATE) for k, v in self.cells(t) if k in missing})
        return [None if k[0] is not None and k[0] == self.known[k] else self.known[k] for k in keys]


def write_archives(pages: DataFrame, smallest_revisit: int = 0) -> DataFrame:
    """Writes a record per row of ``pages`` and returns the committed index, a row a record.

    Of equal payloads of at least ``smallest_revisit`` bytes the page with the smallest id is a response, the others
    revisit it; rows that repeat the smallest id are responses, too.  Pages are read twice, for digests and to be
    archived; only ids and digests are shuffled.
    """
    folder = new_path(pages.sparkSession, "archives")
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    buckets = fates(pages)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        from pyspark import TaskContext

        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        fate = Fates(buckets, TaskContext.get().partitionId())
        stream, name, at = None, "", 0
        try:
            for batch in batches:
                out, ids = [], batch.column(0).to_pylist()
                payloads = [(html or "").encode("utf-8", "replace") for html in batch.column(2).to_pylist()]
                first = fate([(i, hashlib.sha1(p).hexdigest()) for i, p in zip(ids, payloads, strict=True)])
                for page_id, url, payload, refers_to in zip(ids, batch.column(1).to_pylist(), payloads, first, strict=True):
                    if len(payload) < smallest_revisit:
                        refers_to = None
                    if stream is None or at >= ARCHIVE_BYTES:
                        if stream is not None:
                            stream.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        stream = store.open_output_stream(f"{root}/{name}", compression=None)
                    member, digest = record(page_id, url, payload, refers_to)
                    stream.write(member)
                    out.append((name, at, len(member), page_id, url, digest, "response" if refers_to is None else "revisit"))
                    at += len(member)
                names = ["archive", "offset", "length", "page_id", "url", "digest", "record_type"]
                types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
                columns = zip(*out, strict=True) if out else [[]] * 7
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)
        finally:
            if stream is not None:
                stream.close()

    index = pages.mapInArrow(write, INDEX)
    return materialize(index.withColumn("archive", F.concat(F.lit(folder + "/"), "archive")), "index")


def coalesce(ranges: list[tuple[int, int]], gap: int = GAP, run: int = RUN) -> list[tuple[int, int, int, int]]:
    """(from, to, first, last + 1) of reads that cover ``ranges`` (offset, length), which are sorted by offset."""
    reads: list[tuple[int, int, int, int]] = []
    for i, (offset, length) in enumerate(ranges):
        if reads and offset - reads[-1][1] <= gap and offset + length - reads[-1][0] <= run:
            a, b, first, _ = reads[-1]
            reads[-1] = (a, max(b, offset + length), first, i + 1)
        else:
            reads.append((offset, offset + length, i, i + 1))
    return reads


def read_records(index: DataFrame, with_payload: bool = False) -> DataFrame:
    """Reads the index's rows back: page_id, payload_bytes, payload_digest, record_type, refers_to (and url, payload).

    A task takes whole archives, by hash; rows are sorted by place and reads coalesced.  Each record is parsed and held
    against its index row and, for a response, its payload against its digest.  A record that does not match raises.
    """
    found = index.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"), F.approx_count_distinct("archive").alias("archives")).first()
    tasks = max(1, min(found["archives"], READERS), found["bytes"] // TASK_BYTES)
    placed = index.repartition(tasks, "archive").sortWithinPartitions("archive", "offset")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["url", "payload"] * with_payload
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()] + [pa.string(), pa.binary()] * with_payload
        for batch in batches:
            rows = batch.to_pylist()
            by_archive: dict[str, list[dict]] = {}
            for r in rows:
                by_archive.setdefault(r["archive"], []).append(r)
            for archive, own in by_archive.items():
                store, path = fs.FileSystem.from_uri(archive)
                with store.open_input_file(path) as file:
                    for a, b, first, last in coalesce([(r["offset"], r["length"]) for r in own]):
                        data, out = file.read_at(b - a, a), []
                        for r in own[first:last]:
                            warc, http, body = parse(data[r["offset"] - a : r["offset"] - a + r["length"]])
                            digest, kind = warc["WARC-Payload-Digest"].removeprefix("sha1:"), warc["WARC-Type"]
                            size = int(http["Content-Length"])
                            if kind == "response":
                                digest = base32_sha1(body)
                                size = len(body)
                            if digest != r["digest"] or kind != r["record_type"]:
                                raise ValueError(f"record at {r['offset']} of {archive} differs from its index row")
                            refers_to = page_id_of(warc["WARC-Refers-To"]) if kind == "revisit" else None
                            row = (page_id_of(warc["WARC-Record-ID"]), size, digest, kind, refers_to)
                            out.append(row + (warc["WARC-Target-URI"], body) if with_payload else row)
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    extra = ", url string, payload binary" if with_payload else ""
    return placed.mapInArrow(fetch, f"page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long{extra}")


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Writes all ``pages`` and reads every record back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Null html is an empty payload; empty payloads revisit each other like any other.  A null id stays null: such a
    row revisits the smallest id of its payload or, if there is none, is a response.  Null urls become empty.
    Repeated rows are archived each.  An empty table gives none.  Other columns are not archived.
    """
    return read_records(write_archives(pages))
