"""Each catalogue query against its SQL counterpart on the smallest folder."""

import decimal
import math

import duckdb
import pytest

import __spark_entry__ as entry_points
from gleanery.catalogue import all_queries, all_sql

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents"
    " embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        if isinstance(v, decimal.Decimal):
            v = float(v)
        if isinstance(v, float):
            return None if math.isnan(v) else round(v, 9)
        return v

    return [columns[i] for i in order], sorted((tuple(value(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_sql(spark, duck, name):
    df = entry_points.queries()[name](spark, FOLDER)
    got = comparable(df.columns, df.collect())
    cursor = duck.execute(all_sql()[name])
    names = [c[0] for c in cursor.description]
    assert got == comparable(names, cursor.fetchall())


def test_entry(spark):
    assert entry_points.entry(spark).count() == 1500
