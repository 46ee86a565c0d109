"""Operators that SQL can express equal their SQL, values and types alike."""

import duckdb
import pytest

from spotgrid.llm import queries, sql
from tests.test_against_sql import normal


@pytest.mark.parametrize("name", list(sql.oracle_sql()))
def test_query_equals_sql(spark, sf, name):
    frame = queries.queries()[name](spark, sf)
    got = normal(frame.columns, frame.collect())
    with duckdb.connect() as db:
        for table in ("documents", "conversations", "pages", "embeddings"):
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
        cursor = db.execute(sql.oracle_sql()[name])
        assert got[1] and got == normal([c[0] for c in cursor.description], cursor.fetchall())
