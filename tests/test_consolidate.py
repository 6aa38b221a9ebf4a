"""Whole runs: hand-made traps, and an export that comes back through its pages."""

import json

import pytest
from pyspark.sql import functions as F

from gleanery import schemas as S
from gleanery.catalogue.views import Domain
from gleanery.functions.text import stamp_text
from gleanery.operators import runlog as R
from gleanery.operators.split import split_metadata
from gleanery.plans import consolidate as C
from gleanery.plans import export as X
from gleanery.plans import loaders
from gleanery.sources import landing, publish
from gleanery.sources.snapshot import Store

FOLDER = "/root/testdata/sf0.001"
NOW = "TIMESTAMP_NTZ '2025-01-01 00:00:00'"


def u(n):
    return f"{n:08d}-0000-0000-0000-000000000000"


def pages(spark, items, source="s0", import_id=1, start=0):
    rows = [(source, import_id, start + i, [json.dumps(x) for x in page]) for i, page in enumerate(items)]
    return spark.createDataFrame(rows, "source string, import_id bigint, page_no bigint, items array<string>")


def item(i, uid=True, **more):
    return {"id_synthese": i, "id_perm_sinp": u(i) if uid is True else uid, "ca_uuid": u(900), "ca_nom": "AF", "jdd_uuid": u(800), "jdd_nom": "DS", **more}


@pytest.fixture(scope="module")
def refs(spark):
    d = Domain(spark, FOLDER)
    codes = spark.createDataFrame(d.codes().collect(), d.codes().schema)
    areas = spark.createDataFrame(d.areas().collect(), d.areas().schema)
    return codes, areas


def test_traps_of_one_run(spark, refs):
    items = [
        item(1, nombre_min="3", nature_objet_geo="F", date_debut="2024-01-02 03:04:05"),
        item(2, uid=None),                               # no uuid: stored, but no fact
        item(3, nombre_min="12a"),                       # bad integer: rejected
        item(4, uid=u(1)),                               # uuid already taken: rejected
        item(5, area_attachment=None, nature_objet_geo="unknown"),
        item(6, area_attachment={"type_code": "AFRICA", "area_code": "NATION_0"}, wkt_4326="POLYGON((0 0,4 0,4 2,0 2,0 0))"),
        item(7, wkt_4326="MULTIPOINT(1 2)"),             # unsupported geometry: rejected
        item(1, nom_cite="again"),                       # same key later: update
        item(8, uid="nonsense"),                         # bad uuid: rejected
        item(9, extra={"kept": [1, None]}),
    ]
    now = F.expr(NOW)
    arr = landing.arrivals(pages(spark, [items[:4], items[4:]]))
    tables = C.empty_tables(spark, *refs)
    report = C.run_import(tables, arr, now)
    data = {r["id_data"]: r for r in report.tables["data_json"].collect()}
    assert sorted(data) == [1, 2, 5, 6, 9]
    assert json.loads(data[1]["item"])["nom_cite"] == "again"
    assert json.loads(data[9]["item"])["extra"] == {"kept": [1, None]}
    errors = {json.loads(r["item"])["id_synthese"]: r["error"] for r in report.tables["error_log"].collect()}
    assert sorted(errors) == [3, 4, 7, 8]
    facts = {r["entity_source_pk_value"]: r for r in report.tables["facts"].collect()}
    assert sorted(facts) == ["1", "5", "6", "9"]
    assert facts["1"]["last_action"] == "U" and facts["5"]["last_action"] == "I"
    assert facts["1"]["id_nomenclature_geo_object_nature"] == facts["5"]["id_nomenclature_geo_object_nature"]
    assert facts["6"]["id_area_attachment"] is not None and facts["5"]["id_area_attachment"] is None
    assert facts["6"]["id_nomenclature_info_geo_type"] != facts["5"]["id_nomenclature_info_geo_type"]
    assert facts["6"]["the_geom_point"] == "POINT(2 1)"
    ds = report.tables["datasets"].collect()
    assert [(r["unique_dataset_id"], r["dataset_desc"], r["marine_domain"]) for r in ds] == [(u(800), S.BASIC_DATASET_DESC, True)]
    counters = report.counters.collect()
    assert [(r["api_count_items"], r["data_count_upserts"], r["data_count_errors"]) for r in counters] == [(10, 6, 4)]

    # The same run once more changes nothing but marks updates.
    state = {k: spark.createDataFrame(v.collect(), v.schema) for k, v in report.tables.items()}
    again = C.run_import(state, landing.arrivals(pages(spark, [items], import_id=2)), now, deletions=spark.createDataFrame([("s0", 5, 2), ("s0", 77, 2)], "source string, id_data bigint, import_id bigint"))
    assert sorted(r["id_data"] for r in again.tables["data_json"].collect()) == [1, 2, 6, 9]
    left = {r["entity_source_pk_value"]: (r["id_synthese"], r["last_action"]) for r in again.tables["facts"].collect()}
    assert {k: v[0] for k, v in left.items()} == {k: facts[k]["id_synthese"] for k in ("1", "6", "9")}
    assert {v[1] for v in left.values()} == {"U"}
    assert [r["data_count_delete"] for r in again.counters.collect()] == [1]


def test_dataset_document_gets_its_framework(spark):
    rows = [
        ("both", '{"ca_data":{"uuid":"A"},"jdd_data":{"uuid":"D"}}'),
        ("plain", '{"ca_uuid":"A","jdd_data":{"uuid":"D"}}'),
        ("none", '{"jdd_data":{"uuid":"D"}}'),
        ("null", '{"ca_data":null,"jdd_data":{"uuid":"D"}}'),
        ("text", '{"ca_data":"x","jdd_data":"y"}'),
        ("broken", "not json"),
    ]
    df = spark.createDataFrame([(k, i, 0) for k, i in rows], "k string, item string, seq int")
    data, docs = split_metadata(df)
    slim = {r["k"]: r["item"] for r in data.collect()}
    assert json.loads(slim["both"]) == {"ca_uuid": "A", "jdd_uuid": "D"}
    assert json.loads(slim["null"]) == {"ca_data": None, "jdd_uuid": "D"}
    assert slim["text"] == '{"ca_data":"x","jdd_data":"y"}' and slim["broken"] == "not json"
    owners = {r["k"]: json.loads(r["item"])["ca_uuid"] for r in docs.where("level = 'dataset'").collect()}
    assert owners == {"both": "A", "plain": "A", "none": None, "null": None}


@pytest.mark.parametrize("fanout", [False, True])
def test_fanout_and_missing_actors(spark, fanout):
    d = Domain(spark, FOLDER)
    t = d.publisher()
    docs = X.dataset_docs(t, X.CodeBook(t.codes), fanout).collect()
    with_actors = {r[0] for r in t.dataset_actors.select("id_dataset").distinct().collect()}
    assert {r["id_dataset"] for r in docs} == with_actors
    assert (len(docs) == len(with_actors)) is not fanout


def test_export_pages_ingest_load_export_again(spark, refs, tmp_path):
    """What a publisher exports arrives whole in the local tables."""
    t = Domain(spark, FOLDER).publisher()
    export = X.export_with_metadata(t, ordered=False)
    publish.publish_pages(export, str(tmp_path / "pages"), limit=100)
    delivered = publish.read_published(spark, str(tmp_path / "pages")).withColumn("source", F.lit("p")).withColumn("import_id", F.lit(1).cast("bigint"))
    exported = export.select("id_synthese").distinct().count()
    assert delivered.count() == -(-exported // 100)
    types = spark.createDataFrame([("p", S.TYPE_WITH_METADATA)], "source string, data_type string")
    arrived = landing.arrivals(delivered, types)
    report = C.run_import(C.empty_tables(spark, *refs), arrived, F.expr(NOW))
    out = report.tables
    assert out["data_json"].count() == exported and report.rejected.count() == 0
    # Facts carry the attributes of the publisher's facts; codes default where null.
    facts = out["facts"].select("unique_id_sinp", "cd_nom", "count_max", "cd_hab", stamp_text(F.col("date_min")).alias("d"), "the_geom_4326")
    start = t.facts.join(export.select(F.col("id_perm_sinp").alias("unique_id_sinp")).distinct(), "unique_id_sinp")
    start = start.select("unique_id_sinp", "cd_nom", "count_max", "cd_hab", stamp_text(F.col("date_min")).alias("d"), "the_geom_4326")
    assert facts.exceptAll(start).isEmpty() and start.exceptAll(facts).isEmpty()
    # Every fact found its dataset, and every dataset its framework.
    assert out["facts"].where("id_dataset IS NULL").isEmpty()
    assert out["datasets"].where("id_acquisition_framework IS NULL").isEmpty()
    # Bridges: same number of actors with an identity as at the publisher.
    published = t.dataset_actors.where("id_organism IS NOT NULL OR id_role IS NOT NULL")
    known = published.join(t.organisms, published.id_organism == t.organisms.id_organisme, "left").join(t.roles.drop("email"), "id_role", "left")
    known = known.where("id_organisme IS NOT NULL OR uuid_role IS NOT NULL")
    linked = out["dataset_actors"].where("id_organism IS NOT NULL OR id_role IS NOT NULL")
    assert linked.count() == known.count()
    # The result is a publisher's store again: the second export has the same rows.
    assert out["facts"].join(out["datasets"], "id_dataset").join(out["frameworks"], "id_acquisition_framework").count() == exported


def test_loader_registry(spark, refs):
    @loaders.register("only_count")
    def only_count(tables, changes):
        return {**tables, "n": changes.data.groupBy().count()}

    assert "star_schema" in loaders.names() and loaders.get("only_count") is only_count
    with pytest.raises(KeyError):
        loaders.get("missing")
    arr = landing.arrivals(pages(spark, [[item(1), item(2)]]))
    out = C.run_import(C.empty_tables(spark, *refs), arr, F.expr(NOW), loader=loaders.get("only_count")).tables
    assert out["n"].first()[0] == 2 and out["facts"].isEmpty()


def test_store_takes_over_untouched_ranges(spark, tmp_path):
    store = Store(spark, str(tmp_path), ids_per_range=10)
    rows = lambda ids, tag: spark.createDataFrame([("s", "data", "t", i, None, tag, None, 1) for i in ids], S.DATA_JSON)
    first = rows(range(30), "old")
    store.write("r1", {"import_log": spark.createDataFrame([], S.IMPORT_LOG)}, {"data_json": (first, store.touched(first))})
    second = rows([12, 13], "new")
    touched = store.touched(second, rows([25], ""))
    assert {(r[0], r[1]) for r in touched.collect()} == {("s", 1), ("s", 2)}
    assert {r["id_data"] for r in store.read_ranged("data_json", S.DATA_JSON, touched).collect()} == set(range(10, 30))
    store.write("r2", {"import_log": spark.createDataFrame([], S.IMPORT_LOG)}, {"data_json": (second, touched)})
    got = {r["id_data"]: r["item"] for r in store.read_ranged("data_json", S.DATA_JSON).collect()}
    assert got == {**{i: "old" for i in range(10)}, 12: "new", 13: "new"}
    # An older version stays readable, and a finished run is known.
    assert store.read_ranged("data_json", S.DATA_JSON, version=1).count() == 30
    assert store.has_run("r2") and not store.has_run("r3")


def test_runs_follow_each_other_in_a_store(spark, refs, tmp_path):
    store = Store(spark, str(tmp_path), ids_per_range=3)
    before = C.open_tables(store, *refs)
    report = C.run_import(before, landing.arrivals(pages(spark, [[item(i) for i in range(1, 9)]])), F.expr(NOW))
    assert C.save_run(store, "run-1", before, report) == 1
    assert C.save_run(store, "run-1", before, report) == 1
    first = {r["entity_source_pk_value"]: r["id_synthese"] for r in C.open_tables(store, *refs)["facts"].collect()}
    assert sorted(first) == [str(i) for i in range(1, 9)]

    before = C.open_tables(store, *refs)
    gone = spark.createDataFrame([("s0", 7, 2)], "source string, id_data bigint, import_id bigint")
    arr = landing.arrivals(pages(spark, [[item(2, nom_cite="x"), item(20)]], import_id=2))
    report = C.run_import(before, arr, F.expr(NOW), deletions=gone)
    assert C.save_run(store, "run-2", before, report) == 2
    after = C.open_tables(store, *refs)
    assert sorted(r["id_data"] for r in after["data_json"].collect()) == [1, 2, 3, 4, 5, 6, 8, 20]
    second = {r["entity_source_pk_value"]: r for r in after["facts"].collect()}
    assert sorted(second, key=int) == ["1", "2", "3", "4", "5", "6", "8", "20"]
    assert {k: second[k]["id_synthese"] for k in first if k != "7"} == {k: v for k, v in first.items() if k != "7"}
    assert second["2"]["nom_cite"] == "x" and second["20"]["id_synthese"] == 9


def test_run_states(spark):
    sources = spark.createDataFrame([("b",), ("a",)], "std_name string")
    log = spark.createDataFrame([(4,)], "id bigint")
    opened = R.open_runs(log, sources, F.expr(NOW), "full")
    ids = {r["source"]: r["id"] for r in opened.collect()}
    assert sorted(ids.values()) == [5, 6]
    outcomes = spark.createDataFrame([("a", ids["a"], "data_count_upserts", 3)], "source string, import_id bigint, outcome string, n bigint")
    failed = spark.createDataFrame([("b", "timeout")], "source string, comment string")
    closed = R.close_runs(opened, R.run_counters(outcomes), failed, F.expr(NOW))
    runs = R.current_runs(opened.unionByName(closed, allowMissingColumns=True))
    got = {r["source"]: (r["xfer_status"], r["data_count_upserts"], r["comment"], r["xfer_type"]) for r in runs.collect()}
    assert got == {"a": ("success", 3, None, "full"), "b": ("failed", 0, "timeout", "full")}
    marks = {r["source"] for r in R.watermarks(runs).collect()}
    assert marks == {"a"}


def test_null_uuids_are_all_logged(spark):
    rows = [("s", None, "data", None, "{}", f"e{i}", 1, i) for i in range(3)] + [("s", "u", "data", None, "{}", f"f{i}", 1, 9 - i) for i in range(3)]
    failures = spark.createDataFrame(rows, S.ERROR_LOG + ", seq bigint")
    log = R.append_errors(spark.createDataFrame([], S.ERROR_LOG), failures)
    assert sorted(r["error"] for r in log.collect()) == ["e0", "e1", "e2", "f2"]
