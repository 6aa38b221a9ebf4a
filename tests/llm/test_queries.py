"""Queries with a SQL counterpart against it on the smallest folder."""

import duckdb
import pytest

from gleanery.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    cursor = con.execute(SQL[name])
    names = sorted(c[0] for c in cursor.description)
    place = [[c[0] for c in cursor.description].index(n) for n in names]
    wanted = sorted(tuple(r[i] for i in place) for r in cursor.fetchall())
    df = QUERIES[name](spark, FOLDER)
    assert sorted(df.columns) == names
    assert sorted(map(tuple, df.select(*names).collect())) == wanted
