"""Every registered query with SQL against DuckDB on the same tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from tessellum import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    if not Path(FOLDER).exists():
        pytest.skip("no test tables")
    c = duckdb.connect()
    for f in Path(FOLDER).glob("*.parquet"):
        c.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    want = duck.sql(queries.ORACLE_SQL[name])
    assert sorted(want.columns) == columns
    at = [want.columns.index(c) for c in columns]
    assert sorted(repr(tuple(r[c] for c in columns)) for r in df.collect()) == sorted(repr(tuple(r[i] for i in at)) for r in want.fetchall())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert queries.QUERIES["ransac_fit"](spark, FOLDER).count() > 0
