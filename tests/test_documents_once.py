"""Documents and items are made by all tasks, and taken apart once."""

import json

import pytest
from pyspark.sql import functions as F

from gleanery import schemas as S
from gleanery.catalogue import imports, loading
from gleanery.catalogue.views import Domain
from gleanery.operators import facts as FA
from gleanery.operators import split as SP
from gleanery.plans import consolidate as C

FOLDER = "/root/testdata/sf0.001"


def u(n):
    return f"{n:08d}-0000-0000-0000-000000000000"


@pytest.fixture(scope="module")
def domain(spark):
    return Domain(spark, FOLDER)


def dealt(df):
    return "RepartitionByExpression" in df._jdf.queryExecution().optimizedPlan().toString()


def test_documents_are_opened_once(spark, domain, tmp_path):
    actor = {"type_role": "organism", "uuid_actor": u(7), "identity": {"organism_name": "O"}}
    rows = [
        ("framework", {"uuid": u(1), "name": "A", "territories": None, "actors": [actor]}),
        ("dataset", {"uuid": u(2).upper(), "ca_uuid": u(1), "name": "D", "territories": ["Brand#1", None], "actors": [actor, actor]}),
        ("dataset", {"uuid": u(3), "ca_uuid": u(9), "name": "E"}),
        ("dataset", {"uuid": "none", "name": "F", "territories": ["Brand#1"]}),
    ]
    levels = {"framework": S.LEVEL_FRAMEWORK, "dataset": S.LEVEL_DATASET}
    docs = [("s0", "metadata", "t", levels[level], json.dumps(doc), i) for i, (level, doc) in enumerate(rows)]
    given = str(tmp_path / "given")
    spark.createDataFrame(docs, "source string, controler string, type string, level string, item string, seq long").write.parquet(given)
    tables = C.empty_tables(spark, domain.codes(), domain.areas())
    out = C.load_metadata(tables, spark.read.parquet(given), F.expr(loading.NOW))

    names = [n for n in C.LAYOUTS if n.startswith(("framework", "dataset")) or n in ("organisms", "roles")]
    assert not [n for n in names if any(given in path for path in out[n].inputFiles())]
    ds = {r["unique_dataset_id"]: r for r in out["datasets"].collect()}
    assert sorted(ds) == [u(2), u(3)] and ds[u(2)]["id_acquisition_framework"] == 1 and ds[u(3)]["id_acquisition_framework"] is None
    assert {r["id_dataset"] for r in out["dataset_territories"].collect()} == {ds[u(2)]["id_dataset"]}
    assert out["organisms"].count() == 1 and out["dataset_actors"].count() == 1 and out["framework_actors"].count() == 1


def test_documents_are_made_by_all_tasks(domain):
    assert dealt(loading._documents(domain))


def test_items_are_opened_once(spark, domain, monkeypatch):
    made = []
    monkeypatch.setattr(SP, "cut", lambda df: made.append(df) or df)
    items = imports._items(spark, FOLDER)
    assert dealt(items)
    SP.found_documents(items, ["source"])
    _, documents = SP.split_metadata(items)
    for df in (made[0], documents.where("uuid IS NOT NULL")):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_items_without_documents_give_none(spark):
    texts = ['{"ca_data":{"uuid":"%s"},"jdd_data":null}' % u(1), '{"x":"ca_data"}', '{"ca_data":3}', "broken ca_data", None, '{"jdd_data":{"uuid":"?"}}']
    rows = spark.createDataFrame([("s0", i, t) for i, t in enumerate(texts)], "source string, seq long, item string")
    got = SP.first_documents(rows, ["source"]).select("seq", "level", "uuid").collect()
    assert sorted((r["seq"], r["level"], r["uuid"]) for r in got) == [(0, S.LEVEL_FRAMEWORK, u(1)), (5, S.LEVEL_DATASET, None)]


class Enough(Exception):
    pass


def test_items_are_joined_as_texts(spark, domain, monkeypatch):
    made = []

    def stop(df):
        made.append(df)
        raise Enough

    monkeypatch.setattr(FA, "cut", stop)
    assert dealt(loading._raw_items(domain))
    with pytest.raises(Enough):
        loading.load_fact(spark, FOLDER)
    lines = made[0]._jdf.queryExecution().optimizedPlan().toString().split("\n")
    parsed = [i for i, line in enumerate(lines) if "from_json" in line]
    joined = [i for i, line in enumerate(lines) if "Join LeftOuter" in line]
    assert len(parsed) == 1 and parsed[0] < min(joined)
