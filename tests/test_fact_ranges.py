"""Runs on a store open only the ranges of facts that they concern, and number on from the last run."""

import json

import pytest
from pyspark.sql import functions as F

from gleanery.catalogue.views import Domain
from gleanery.plans import consolidate as C
from gleanery.sources import holders, landing
from gleanery.sources.snapshot import Store

FOLDER = "/root/testdata/sf0.001"
NOW = "TIMESTAMP_NTZ '2025-01-01 00:00:00'"
@pytest.fixture(scope="module")
def refs(spark):
    d = Domain(spark, FOLDER)
    return tuple(spark.createDataFrame(t.collect(), t.schema) for t in (d.codes(), d.areas()))


def arrivals(spark, items, run):
    """Arrivals from (source, id, own id, uuid number, name)."""
    rows = []
    for page, (source, i, own, uuid, name) in enumerate(items):
        text = json.dumps({
            "id_synthese": own, "id_perm_sinp": None if uuid is None else f"{uuid:08d}-0000-0000-0000-000000000000",
            "ca_uuid": f"{900:08d}-0000-0000-0000-000000000000", "ca_nom": "AF",
            "jdd_uuid": f"{800:08d}-0000-0000-0000-000000000000", "jdd_nom": "DS", "nom_cite": name,
        })
        rows.append((source, run, page, [text]))
    pages = spark.createDataFrame(rows, "source string, import_id bigint, page_no bigint, items array<string>")
    return landing.arrivals(pages)


def facts_by_uuid(tables):
    names = {r["id_source"]: r["name_source"] for r in tables["sources"].collect()}
    rows = tables["facts"].select("unique_id_sinp", "id_source", "entity_source_pk_value", "id_synthese", "nom_cite", "last_action").collect()
    out = {int(r[0][:8]): (names[r[1]], int(r[2]), r[3], r[4], r[5]) for r in rows}
    assert len(out) == len(rows) == len({r[3] for r in rows})
    return out


def ranges_of(facts, size):
    return {(r[0], r[1] // size) for r in facts.select("id_source", "id_synthese").collect()}


def test_few_ranges_are_opened(spark, refs, tmp_path, monkeypatch):
    store, size = Store(spark, str(tmp_path), ids_per_range=4, uuid_parts=8), 4
    opened, facts_for = [], C.facts_for

    def noted(store, tables, changes, version):
        facts = facts_for(store, tables, changes, version)
        opened.append(ranges_of(facts, size))
        return facts

    monkeypatch.setattr(C, "facts_for", noted)

    def after(run, items, gone=None):
        deleted = gone and spark.createDataFrame([(*g, run) for g in gone], "source string, id_data bigint, import_id bigint")
        C.import_into_store(store, f"r{run}", arrivals(spark, items, run), F.expr(NOW), *refs, deletions=deleted)
        tables = C.open_tables(store, *refs)
        return facts_by_uuid(tables), tables

    held, _ = after(1, [(f"s{i % 2}", i, i, i, f"n{i}") for i in range(1, 41)])
    assert {u: r[:2] + r[3:] for u, r in held.items()} == {i: (f"s{i % 2}", i, f"n{i}", "I") for i in range(1, 41)}
    assert {r[2] for r in held.values()} == set(range(1, 41))

    # An update, a uuid that another row holds, none at all, two new rows that go again with the
    # deletions; the own id 1 is that of a fact of another source as well.
    items = [("s1", 3, 3, 3, "again"), ("s0", 50, 50, 5, "taken"), ("s0", 51, 51, None, "none"), ("s0", 52, 52, 52, "new"), ("s2", 1, 1, 53, "first")]
    got, tables = after(2, items, [("s2", 1), ("s0", 52), ("s1", 7), ("s1", 999)])
    held[3] = (*held[3][:3], "again", "U")
    del held[7]
    assert got == held and tables["sequences"].first()["last"] == 42

    # Numbers that were given are not given again.
    got, tables = after(3, [("s0", 12, 12, 12, "m"), ("s1", 61, 61, 61, "x")], [("s0", 10)])
    held[12] = (*held[12][:3], "m", "U")
    held[61] = ("s1", 61, 43, "x", "I")
    del held[10]
    assert got == held and tables["sequences"].first()["last"] == 43
    every = len(ranges_of(tables["facts"], size))
    assert opened[0] == set() and all(len(found) <= 6 < every / 2 for found in opened[1:])


def test_facts_of_a_store_without_an_index_are_indexed(spark, refs, tmp_path):
    store = Store(spark, str(tmp_path), ids_per_range=4)
    known = C.empty_tables(spark, *refs)
    number = F.format_string("%08d-0000-0000-0000-000000000000", F.col("id"))
    rows = spark.range(1, 10).select(
        F.col("id").alias("id_synthese"), number.alias("unique_id_sinp"), F.lit(1).cast("bigint").alias("id_source"),
        F.col("id").cast("string").alias("entity_source_pk_value"),
    )
    facts = known["facts"].unionByName(rows, allowMissingColumns=True)
    sources = known["sources"].unionByName(spark.createDataFrame([(1, "s0")], "id_source bigint, name_source string"), allowMissingColumns=True)
    store.write("old", {"sources": sources}, {"facts": (facts, store.touched(facts, name="facts"))})
    assert "sequences" not in C.open_tables(store, *refs) and not holders.indexed(store, 1, holders.FACTS)
    C.import_into_store(store, "new", arrivals(spark, [("s0", 2, 2, 2, "b"), ("s0", 20, 20, 20, "c")], 2), F.expr(NOW), *refs)
    held = facts_by_uuid(C.open_tables(store, *refs))
    assert {u: r[2] for u, r in held.items()} == {i: i for i in range(1, 10)} | {20: 10} and held[2][3] == "b"
    wanted = spark.createDataFrame([("u:00000009-0000-0000-0000-000000000000",), ("k:1:4",), ("k:1:20",), ("k:1:21",)], "uuid string")
    found = {(r["uuid"], r["id_data"]) for r in holders.find(store, wanted, 2, holders.FACTS).collect()}
    assert found == {("u:00000009-0000-0000-0000-000000000000", 8), ("k:1:4", 4), ("k:1:20", 8)}
