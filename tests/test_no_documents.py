"""Items without documents: nothing is opened or merged, and an escaped key still counts."""

from gleanery import schemas as S
from gleanery.operators import split


def test_items_without_documents_give_none(spark):
    rows = [(1, '{"id":1,"x":[1,null]}'), (2, None), (3, "no json")]
    items = spark.createDataFrame(rows, "seq long, item string")
    assert split.found_documents(items, []) is None
    first = split.first_documents(items, [])
    assert first.columns == split.split_metadata(items)[1].columns and first.count() == 0
    assert sorted(map(tuple, split.split_metadata(items)[0].collect())) == rows


def test_escaped_keys_are_found(spark):
    rows = [(1, r'{"ca\u005fdata":{"uuid":"%s"}}' % ("a" * 32)), (2, r'{"x":"é"}')]
    items = spark.createDataFrame(rows, "seq long, item string")
    found = split.first_documents(items, []).collect()
    assert [(r["seq"], r["level"]) for r in found] == [(1, S.LEVEL_FRAMEWORK)]
