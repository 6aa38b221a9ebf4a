import json

from pyspark.sql import functions as F

from gleanery import schemas as S
from gleanery.operators.merge import upsert_data
from gleanery.plans.consolidate import open_tables
from gleanery.sources.landing import arrivals, read_pages
from gleanery.sources.snapshot import Store
from gleanery.streaming.polling import poll_into_store, upsert_into_store


def land(spark, folder, import_id, rows):
    lines = [
        (json.dumps({"page_no": n, "items": [{"id_synthese": i, "id_perm_sinp": f"{i:08d}" + "-0000" * 3 + "-000000000000", "v": v} for i, v in rows[n : n + 5]]}),)
        for n in range(0, len(rows), 5)
    ]
    spark.createDataFrame(lines, "line string").coalesce(1).write.text(f"{folder}/source=s/import_id={import_id}")


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"), ids_per_range=7)
    landing, progress = str(tmp_path / "landing"), str(tmp_path / "progress")
    land(spark, landing, 1, [(i, "a") for i in range(20)])
    poll_into_store(spark, landing, progress, store).awaitTermination()
    versions = store.version()
    # Nothing new: nothing is written.
    poll_into_store(spark, landing, progress, store).awaitTermination()
    assert store.version() == versions
    land(spark, landing, 2, [(i, "b") for i in range(15, 30)] + [(15, "c")])
    poll_into_store(spark, landing, progress, store).awaitTermination()
    got = {(r["id_data"], json.loads(r["item"])["v"]) for r in store.read_ranged("data_json", S.DATA_JSON).collect()}
    batch = arrivals(read_pages(spark, landing)).drop("_raw_uuid")
    whole = upsert_data(spark.createDataFrame([], S.DATA_JSON), batch).state
    assert got == {(r["id_data"], json.loads(r["item"])["v"]) for r in whole.collect()}
    assert (15, "c") in got and len(got) == 30


def test_repeated_batch_does_nothing(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    rows = spark.createDataFrame([("s", "data", "t", 1, None, "{}", None, 1, 0)], S.DATA_JSON + ", seq bigint")
    upsert_into_store(store, "run-1", rows)
    upsert_into_store(store, "run-1", rows.withColumn("item", F.lit("changed")))
    assert store.version() == 1 and store.read_ranged("data_json", S.DATA_JSON).first()["item"] == "{}"


def ids(store):
    return {r["id_data"] for r in store.read_ranged("data_json", S.DATA_JSON).collect()}


def test_a_fresh_checkpoint_does_not_hide_new_pages(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    for n in (1, 2):
        land(spark, str(tmp_path / f"landing{n}"), n, [(n, "a")])
        poll_into_store(spark, str(tmp_path / f"landing{n}"), str(tmp_path / f"progress{n}"), store).awaitTermination()
    assert ids(store) == {1, 2}


def test_every_landed_item_is_stored_superseded_or_logged(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    landing = tmp_path / "landing" / "source=s" / "import_id=1"
    landing.mkdir(parents=True)
    uuid = "{:08d}-0000-0000-0000-000000000000".format
    items = [
        {"id_synthese": 1, "id_perm_sinp": uuid(1)},
        {"id_synthese": 1, "id_perm_sinp": uuid(1), "v": 2},
        {"id_synthese": 2, "id_perm_sinp": uuid(1)},
        {"id_synthese": "x", "id_perm_sinp": uuid(3)},
        {"id_synthese": 4, "id_perm_sinp": uuid(4), "nombre_min": "12a"},
        {"id_synthese": 3000000000, "id_perm_sinp": uuid(5)},
    ]
    (landing / "page-1.json").write_text(json.dumps({"items": items}))
    poll_into_store(spark, str(tmp_path / "landing"), str(tmp_path / "progress"), store).awaitTermination()
    errors = store.read_added("error_log", S.ERROR_LOG).collect()
    assert ids(store) == {1, 3000000000}
    assert len(errors) == 3 and len(items) == 2 + 1 + len(errors)
    # What a stream has written opens as the tables of a run.
    tables = open_tables(store, None, None)
    assert tables["data_json"].count() == 2 and tables["metadata_json"].count() == 0 and tables["datasets"].count() == 0


def test_envelopes_of_one_page_number_keep_an_order(spark, tmp_path):
    pages = [(json.dumps({"items": [{"id_synthese": 1, "v": v}]}),) for v in range(3)]
    spark.createDataFrame(pages, "line string").coalesce(1).write.text(str(tmp_path / "source=s" / "import_id=1"))
    rows = arrivals(read_pages(spark, str(tmp_path))).select("seq", "item").collect()
    assert len({r["seq"] for r in rows}) == 3
    assert json.loads(max(rows, key=lambda r: r["seq"])["item"])["v"] == 2


def test_uuid_holder_outside_the_touched_ranges(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"), ids_per_range=10)
    layout = S.DATA_JSON + ", seq bigint"
    row = lambda i, u: [("s", "data", "t", i, u, "{}", None, 1, 0)]
    upsert_into_store(store, "1", spark.createDataFrame(row(1, "u"), layout))
    upsert_into_store(store, "2", spark.createDataFrame(row(99, "u") + row(98, "v"), layout))
    assert {r["id_data"] for r in store.read_ranged("data_json", S.DATA_JSON).collect()} == {1, 98}
