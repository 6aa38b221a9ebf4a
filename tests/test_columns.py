import json

import pytest
from pyspark.sql import functions as F

from gleanery.functions import documents as D
from gleanery.functions import geometry as G
from gleanery.functions import text as T


def one(spark, value, column, kind="string"):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(column(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "name, expected",
    [
        ("My-Source É#1 (Écrins) ~x", "mysource_e#1_ecrins__x"),
        ("  two \t\n blanks here ", "two_blanks_here"),
        ("Ça & là", "ca__la"),
        (None, None),
    ],
)
def test_source_name(spark, name, expected):
    assert one(spark, name, T.simplify_source) == expected


def test_casts(spark):
    assert one(spark, "12", T.clean_int) == 12
    assert one(spark, "12.5", T.clean_int) is None
    assert one(spark, "A" * 8 + "-aaaa-aaaa-aaaa-aaaaaaaaaaaa", T.clean_uuid) == "a" * 8 + "-aaaa-aaaa-aaaa-aaaaaaaaaaaa"
    assert one(spark, "nope", T.clean_uuid) is None
    assert str(one(spark, "2024-05-06 23:59:59", T.clean_date)) == "2024-05-06"
    assert str(one(spark, "2024-05-06T23:59:59.5", T.clean_date)) == "2024-05-06"
    assert one(spark, "2024-13-06", T.clean_date) is None


def test_unknown_keys_and_types_survive(spark):
    doc = '{"z":[1,null,{"q":"é"}],"n":12,"t":true,"x":null,"s":"12"}'
    got = one(spark, doc, lambda c: F.to_json(D.with_member(D.without(D.open_object(c), "x"), "k", F.lit('a"b'))))
    assert json.loads(got) == {"z": [1, None, {"q": "é"}], "n": 12, "t": True, "s": "12", "k": 'a"b'}


def test_absent_null_and_present_keys(spark):
    assert one(spark, '{"a":null}', lambda c: D.has_keys(c, "a")) is True
    assert one(spark, '{"b":1}', lambda c: D.has_keys(c, "a")) is False
    assert one(spark, '{"a":null}', lambda c: D.text_member(D.member(D.open_object(c), "a"), "$")) is None
    assert one(spark, '{"a":{"b":1}}', lambda c: D.as_object(D.member(D.open_object(c), "a")).isNotNull()) is True
    assert one(spark, '{"a":"b"}', lambda c: D.as_object(D.member(D.open_object(c), "a")).isNotNull()) is False
    assert one(spark, "{}", lambda c: D.as_object(D.member(D.open_object(c), "a")).isNotNull()) is False


def test_provenance_of_null_and_old_documents(spark):
    add = lambda c: D.with_provenance(c, F.lit("s"), "m")
    assert json.loads(one(spark, None, add)) == {"source": "s", "module": "m"}
    assert json.loads(one(spark, '{"source":"x","k":1}', add)) == {"source": "s", "module": "m", "k": 1}


def test_geometry(spark):
    middle = lambda c: G.centroid(G.coordinates(c))
    assert tuple(one(spark, "POINT(1.5 -2)", middle)) == (1.5, -2.0)
    assert tuple(one(spark, "point ( 1 2 )", middle)) == (1.0, 2.0)
    x, y = one(spark, "POLYGON((0 0,4 0,4 2,0 2,0 0))", middle)
    assert (round(x, 9), round(y, 9)) == (2.0, 1.0)
    # The same ring the other way round, and far from the origin.
    x, y = one(spark, "POLYGON((1000 1000,1000 1002,1004 1002,1004 1000,1000 1000))", middle)
    assert (round(x, 9), round(y, 9)) == (1002.0, 1001.0)
    assert tuple(one(spark, "POLYGON((0 0,2 0,4 0,0 0))", middle)) == (2.0, 0.0)
    assert one(spark, "LINESTRING(0 0,1 1)", middle) is None
    assert one(spark, "LINESTRING(0 0,1 1)", G.is_supported) is False
    assert one(spark, "POLYGON((0 0,4 0,4 2,0 0))", lambda c: G.as_text(G.coordinates(c))) == "POLYGON((0 0,4 0,4 2,0 0))"


def test_local_projection_at_its_origin(spark):
    x, y = one(spark, "POINT(3 46.5)", lambda c: F.get(G.to_local(G.coordinates(c)), F.lit(0)))
    assert abs(x - 700000) < 0.01 and abs(y - 6600000) < 0.5
