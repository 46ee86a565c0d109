"""Every catalog query equals its SQL on the smallest tables, values and types alike."""

import duckdb
import pytest

import __spark_entry__ as entry
import oracle
from spotgrid import catalog
from spotgrid.sources.binding import BASE_TABLES

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQLS = catalog.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in BASE_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield con
    con.close()


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple((type(r[i]).__name__, str(r[i])) for i in order) for r in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQLS)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, db, name):
    frame = QUERIES[name](spark, SF_DIR)
    got = normal(frame.columns, frame.collect())
    cursor = db.execute(SQLS[name])
    assert got == normal([c[0] for c in cursor.description], cursor.fetchall())


def test_entry_returns_rows(spark):
    assert entry.entry(spark).count() > 0
