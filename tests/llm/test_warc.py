import base64
import gzip
import hashlib
import random

import pytest

from arbora.llm import warc as W

SCHEMA = "page_id long, url string, html string, digest string, offset int"


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def rows():
    rng = random.Random(15)
    texts = ["", None, "<p>é</p>", "x" * 300_000, "a\r\n\r\nb", "WARC/1.1\r\n\r\n"] + [f"<b>{rng.random()}</b>" for _ in range(20)]
    out = [(i, f"http://h/{i} x" if i % 7 else None, rng.choice(texts), "clash", 1) for i in rng.sample(range(-5, 1000), 150)]
    return out + [out[0], out[0], (None, "u", "only null id", "", 0), (None, "u", "x" * 300_000, "", 0)]


def test_round_trip_matches_brute_force(spark):
    data = rows()
    got = sorted(map(tuple, W.archive_round_trip(spark.createDataFrame(data, SCHEMA)).collect()), key=str)
    first = {}
    for i, _, html, *_ in data:
        if i is not None:
            first[digest(html)] = min(i, first.get(digest(html), i))
    want = []
    for i, _, html, *_ in data:
        d = digest(html)
        revisit = d in first and first[d] != i
        want.append((i, len((html or "").encode()), d, "revisit" if revisit else "response", first[d] if revisit else None))
    assert got == sorted(want, key=str)
    assert W.archive_round_trip(spark.createDataFrame([], SCHEMA)).collect() == []


def test_payloads_selected_ranges_and_damage(spark):
    data = [(i, f"http://h/{i}", f"<p>{i}</p>" * 50, "", 0) for i in range(300)]
    index = W.write_archives(spark.createDataFrame(data, SCHEMA))
    some = W.read_records(index.where("page_id % 3 = 0"), with_payload=True).collect()
    assert {r.page_id: r.payload.decode() for r in some} == {i: h for i, _, h, *_ in data if i % 3 == 0}
    assert all(r.url == f"http://h/{r.page_id}" for r in some)
    row = index.first()
    path = row.archive.removeprefix("file://")
    whole = open(path, "rb").read()
    assert gzip.decompress(whole).count(b"WARC/1.1\r\n") == index.where(W.F.col("archive") == row.archive).count()
    open(path, "wb").write(whole[: row.offset + 30] + bytes(8) + whole[row.offset + 38 :])
    with pytest.raises(Exception, match="record|gzip"):
        W.read_records(index).collect()


def test_small_payloads_are_no_revisits_above_the_limit(spark):
    data = [(1, "a", "xy", "", 0), (2, "b", "xy", "", 0)]
    kinds = lambda n: sorted(r.record_type for r in W.write_archives(spark.createDataFrame(data, SCHEMA), n).collect())
    assert kinds(0) == kinds(2) == ["response", "revisit"] and kinds(3) == ["response", "response"]


def test_coalesce():
    assert W.coalesce([(0, 10), (10, 5), (40, 5), (100, 1)], gap=25, run=50) == [(0, 45, 0, 3), (100, 101, 3, 4)]
    assert W.coalesce([(0, 100), (100, 100)], gap=5, run=50) == [(0, 100, 0, 1), (100, 200, 1, 2)]
    assert W.coalesce([]) == []
    assert W.page_id_of(W.record_id(-3)) == -3 and W.page_id_of(W.record_id(None)) is None
