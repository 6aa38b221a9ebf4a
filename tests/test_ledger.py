"""Runs over a landing folder: late and missing pages, files read once, two writers."""

import json
import os
import time
from datetime import datetime

import pytest

from gleanery import schemas as S
from gleanery.plans.incremental import run_incremental, stored_runs
from gleanery.sources import landing, ledger
from gleanery.sources.snapshot import Store


def uuid(i):
    return f"{i:08d}-0000-0000-0000-000000000000"


def land(folder, source, delivery, pages, **told):
    """Pages by number; a page is a list of (id, time of change)."""
    place = folder / f"source={source}" / f"import_id={delivery}"
    place.mkdir(parents=True, exist_ok=True)
    for n, rows in pages.items():
        items = [{"id_synthese": i, "id_perm_sinp": uuid(i), "derniere_action": at} for i, at in rows]
        (place / f"page-{n}.json").write_text(json.dumps({"items": items} | told))


def ids(store):
    return sorted(r["id_data"] for r in store.read_ranged("data_json", S.DATA_JSON).collect())


def states(store):
    return [(r["source"], r["xfer_status"], r["comment"]) for r in stored_runs(store).orderBy("id").collect()]


@pytest.fixture
def sources(spark):
    return spark.createDataFrame([("one", True, None), ("two", True, None)], "name string, enable boolean, data_type string")


@pytest.fixture
def one(sources):
    return sources.where("name = 'one'")


def test_late_pages_are_imported_and_files_read_once(spark, tmp_path, one, monkeypatch):
    store, folder = Store(spark, str(tmp_path / "store")), tmp_path / "in"
    land(folder, "one", 0, {0: [(1, "2024-01-01")]})
    run_incremental(store, "r1", one, str(folder), datetime(2024, 2, 1), loader=None)
    # Changed before the first run, landed behind it.
    land(folder, "one", 0, {1: [(2, "2024-01-15"), (3, "2024-03-01")]})
    land(folder, "two", 0, {0: [(9, "2024-01-15")]})
    files = ledger.unread(ledger.landed_files(spark, str(folder)).where("source = 'one'"), ledger.taken(store))
    pages = ledger.read_files(spark, str(folder), files)
    assert [f.split("/")[-1] for f in pages.inputFiles()] == ["page-1.json"] and pages.first()["source"] == "one"
    # Beyond the number of named files the result is the same.
    named = pages.drop("file").collect()
    monkeypatch.setattr(ledger, "NAMED_FILES", 0)
    assert ledger.read_files(spark, str(folder), files).drop("file").collect() == named
    report = run_incremental(store, "r2", one, landing.read_pages(spark, str(folder)), datetime(2024, 3, 1), loader=None)
    assert ids(store) == [1, 2, 3] and {r["source"]: r["api_count_items"] for r in report.counters.collect()} == {"one": 2}
    assert [s for _, s, _ in states(store)] == [S.STATUS_SUCCESS] * 2
    # Pages of a source that is not enabled wait for it.
    left = ledger.unread(ledger.landed_files(spark, str(folder)), ledger.taken(store)).collect()
    assert [(r["source"], r["import_id"]) for r in left] == [("two", 0)]


def test_a_page_delivered_anew_counts_as_new(spark, tmp_path):
    folder = tmp_path / "in"
    land(folder, "one", 1, {0: [(1, "2024-01-01")], 1: [(1, "2024-01-01")]})
    files = ledger.landed_files(spark, str(folder))
    taken = ledger.entries(files, landing.read_pages(spark, str(folder))).collect()
    assert sorted(r["page_no"] for r in taken) == [0, 1]
    taken = spark.createDataFrame(taken, ledger.LAYOUT)
    assert ledger.unread(files, taken).isEmpty()
    file = folder / "source=one" / "import_id=1" / "page-0.json"
    os.utime(file, (time.time() + 5, time.time() + 5))
    files = ledger.unread(ledger.landed_files(spark, str(folder)), taken)
    assert [r["path"].split("/")[-1] for r in files.collect()] == ["page-0.json"]


def test_gaps_fail_their_source_alone_until_the_pages_land(spark, tmp_path, sources):
    store, folder = Store(spark, str(tmp_path / "store")), tmp_path / "in"
    land(folder, "one", 0, {1: [(1, "2024-01-01")], 3: [(3, "2024-01-01")]})
    land(folder, "two", 0, {0: [(5, "2024-01-01")]}, total_filtered=250, limit=100)
    land(folder, "three", 0, {0: [(6, "2024-01-01")]}, total_filtered=1, limit=100)
    every = sources.unionByName(spark.createDataFrame([("three", True, None)], sources.schema))
    run_incremental(store, "r1", every, str(folder), datetime(2024, 2, 1), loader=None)
    assert ids(store) == [6]
    assert sorted(states(store)) == [
        ("one", S.STATUS_FAILED, "pages 2-2 have not landed"),
        ("three", S.STATUS_SUCCESS, None),
        ("two", S.STATUS_FAILED, "pages 1-2 have not landed"),
    ]
    # The page lands, and the others of the delivery have waited for it. Of the other source a newer
    # delivery covers the incomplete one, whose page comes first.
    land(folder, "one", 0, {2: [(2, "2024-01-01")]})
    land(folder, "two", 1, {0: [(5, "2024-01-02"), (7, "2024-01-02")]}, total_filtered=2, limit=100)
    run_incremental(store, "r2", every, str(folder), datetime(2024, 3, 1), loader=None)
    assert ids(store) == [1, 2, 3, 5, 6, 7]
    rows = store.read_ranged("data_json", S.DATA_JSON).where("source = 'two'").collect()
    assert {json.loads(r["item"])["derniere_action"] for r in rows} == {"2024-01-02"}
    assert ledger.unread(ledger.landed_files(spark, str(folder)), ledger.taken(store)).isEmpty()
