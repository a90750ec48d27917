"""The text queries against their SQL."""

import pytest

from tessellum.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, folder, name):
    import duckdb

    db = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    df = QUERIES[name](spark, folder)
    want = db.sql(ORACLE_SQL[name])
    assert sorted(want.columns) == sorted(df.columns)
    rows = sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)
    at = [want.columns.index(c) for c in sorted(want.columns)]
    assert rows == sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=repr)
