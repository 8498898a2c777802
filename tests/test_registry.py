"""Every registered query beside its SQL, over the whole given tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = """
    region nation customer supplier part orders lineitem events documents embeddings pages
    benchmark labels conversations
""".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def _rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(tuple(map(str, row)) for row in frame.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, sql, name):
    got = entry.queries()[name](spark, SF_DIR).toPandas()
    assert len(got)
    oracle = entry.oracle_sql().get(name)
    if oracle is not None:
        want = sql.execute(oracle).fetchdf()
        assert sorted(got.columns) == sorted(want.columns)
        assert _rows(got) == _rows(want)
