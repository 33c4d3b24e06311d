"""Every registered query against its DuckDB SQL on the smallest tables; those without SQL must run."""

from pathlib import Path

import duckdb
import pytest

from arbora.plans.queries import QUERIES, SQL

SF = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not SF.exists(), reason="needs the test tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def rows(names, data):
    order = sorted(names)
    at = [list(names).index(n) for n in order]
    return order, sorted(repr(tuple(float(r[i]) if isinstance(r[i], float) else r[i] for i in at)) for r in data)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, str(SF))
    mine = rows(got.columns, [tuple(r) for r in got.collect()])
    if name in SQL:
        rel = duck.sql(SQL[name])
        assert mine == rows(rel.columns, rel.fetchall())


def test_every_oracle_has_its_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_runs(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(QUERIES) <= set(entry.queries())
