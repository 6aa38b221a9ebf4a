import json
from datetime import datetime

from gleanery import schemas as S
from gleanery.plans.incremental import run_incremental, stored_runs
from gleanery.sources.landing import read_pages
from gleanery.sources.snapshot import Store


def uuid(i):
    return f"{i:08d}-0000-0000-0000-000000000000"


def land(folder, source, run, pages):
    place = folder / f"source={source}" / f"import_id={run}"
    place.mkdir(parents=True)
    for n, items in enumerate(pages):
        (place / f"page-{n}.json").write_text(json.dumps({"items": items}) if items is not None else '{"items": nonsense')


def item(i, at):
    return {"id_synthese": i, "id_perm_sinp": uuid(i), "derniere_action": at}


def test_two_runs_with_a_failing_and_a_disabled_source(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    sources = spark.createDataFrame([("One", True, None), ("two", None, None), ("off", False, None)], "name string, enable boolean, data_type string")
    land(tmp_path / "a", "one", 0, [[item(1, "2024-01-01"), item(2, "2024-01-02")]])
    land(tmp_path / "a", "two", 0, [[item(5, "2024-01-01")], None])
    land(tmp_path / "a", "off", 0, [[item(9, "2024-01-01")]])
    first = datetime(2024, 2, 1)
    run_incremental(store, "r1", sources, read_pages(spark, str(tmp_path / "a")), first, loader=None)
    state = {r["source"]: r for r in stored_runs(store).collect()}
    assert set(state) == {"one", "two"}
    assert state["one"]["xfer_status"] == S.STATUS_SUCCESS and state["one"]["data_count_upserts"] == 2
    assert state["two"]["xfer_status"] == S.STATUS_FAILED and "page 1" in state["two"]["comment"]

    # Old items of a source that succeeded are passed over; the failed one starts anew.
    land(tmp_path / "b", "one", 0, [[item(1, "2024-01-15"), item(3, "2024-02-10")]])
    land(tmp_path / "b", "two", 0, [[item(5, "2024-01-01")]])
    gone = spark.createDataFrame(
        [("one", 2, "D", datetime(2024, 2, 5)), ("one", 3, "D", datetime(2024, 1, 5))],
        "source string, id_data bigint, last_action string, meta_last_action_date timestamp_ntz",
    )
    pages = read_pages(spark, str(tmp_path / "b"))
    run_incremental(store, "r2", sources, pages, datetime(2024, 3, 1), gone, loader=None)
    assert {(r["source"], r["id_data"]) for r in store.read_ranged("data_json", S.DATA_JSON).collect()} == {("one", 1), ("one", 3), ("two", 5)}
    runs = {(r["id"], r["source"]): r for r in stored_runs(store).collect()}
    last = {r["source"]: r for _, r in sorted(runs.items())}
    assert len(runs) == 4 and last["one"]["data_count_delete"] == 1 and last["two"]["xfer_status"] == S.STATUS_SUCCESS
    events = {r["xfer_status"] for r in store.read_added("import_log", S.IMPORT_LOG + ", seq bigint").collect()}
    assert {S.STATUS_INIT, S.STATUS_IMPORT, S.STATUS_DELETE} <= events
    # The same run again does nothing.
    assert run_incremental(store, "r2", sources, pages, datetime(2024, 3, 1), gone, loader=None) is None


def test_a_fault_of_one_source_leaves_the_others(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    sources = spark.createDataFrame([("One", True, None), ("two", None, None)], "name string, enable boolean, data_type string")
    land(tmp_path / "a", "one", 0, [[item(1, "2024-01-01")]])
    land(tmp_path / "a", "two", 0, [[item(2, "2024-01-01")]])

    def loader(tables, changes):
        if not changes.data.where("source = 'two'").isEmpty():
            raise ValueError("no place for two")
        return tables

    for _ in range(2):  # the second time nothing is done
        run_incremental(store, "r1", sources, str(tmp_path / "a"), datetime(2024, 2, 1), loader=loader)
    assert {r["source"] for r in store.read_ranged("data_json", S.DATA_JSON).collect()} == {"one"}
    state = {r["source"]: (r["xfer_status"], r["comment"]) for r in stored_runs(store).collect()}
    assert state == {"one": (S.STATUS_SUCCESS, None), "two": (S.STATUS_FAILED, "ValueError: no place for two")}
    assert stored_runs(store).count() == 2
