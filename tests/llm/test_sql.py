"""The corpus queries that have SQL give its rows on the smallest tables."""

import duckdb
import pytest

from wardstats.llm.queries import QUERIES
from wardstats.llm.queries_sql import ORACLE

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    db = duckdb.connect()
    for name in ("documents", "benchmark", "embeddings"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return db


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_rows_of_sql(spark, tables, name):
    want = tables.sql(ORACLE[name])
    columns = sorted(want.columns)
    found = QUERIES[name](spark, FOLDER).select(*columns).collect()
    assert sorted(map(tuple, found)) == sorted(want.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall())
