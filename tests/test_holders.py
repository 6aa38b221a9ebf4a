"""Index of uuid holders: against the whole column, files opened, two writers."""

import random

import pytest
from pyspark.sql import functions as F

from gleanery import schemas as S
from gleanery.sources import holders
from gleanery.sources.snapshot import Conflict, Store
from gleanery.streaming.polling import upsert_into_store

ROW = S.DATA_JSON + ", seq bigint"


def batch(spark, rows):
    """Arrivals from (id, uuid)."""
    return spark.createDataFrame([("s", "data", "t", i, u, "{}", None, 1, n) for n, (i, u) in enumerate(rows)], ROW)


def stored(store):
    return {r["id_data"]: r["uuid"] for r in store.read_ranged("data_json", S.DATA_JSON).collect()}


def found(store, uuids):
    wanted = store.spark.createDataFrame([(u,) for u in uuids], "uuid string")
    return {(r["uuid"], r["id_data"]) for r in holders.find(store, wanted, store.version()).collect()}


def test_the_newest_entry_counts_and_parts_are_merged(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(holders, "MERGE_AT", 2)
    store = Store(spark, str(tmp_path), uuid_parts=3)
    draw = random.Random(1)
    every, table = [f"u{i}" for i in range(60)], {}
    for run in range(5):
        changed = [(u, draw.random() < 0.6, "s", draw.randrange(100)) for u in draw.sample(every, 20)]
        table |= {u: i if held else None for u, held, _, i in changed}
        # A uuid that a run stores and gives up is given up.
        both = [(u, not held, s, i) for u, held, s, i in changed[:2]]
        table |= {u: None for u, *_ in both}
        df = spark.createDataFrame([*changed, *both, (None, True, "s", 1)], "uuid string, held boolean, source string, id_data bigint")
        store.write(f"r{run}", {}, beside=lambda token, version, df=df: holders.append(store, token, version, df))
    assert found(store, every) == {(u, i) for u, i in table.items() if i is not None}
    live = holders._live(store, store.version())
    assert max(sum(part == p for _, p, _ in live) for part in range(3)) <= 3


def test_few_files_are_opened(spark, tmp_path):
    store = Store(spark, str(tmp_path), uuid_parts=8)
    opened = []
    for run in range(4):
        held = spark.range(2000).select(F.concat(F.lit(f"u{run}-"), F.col("id").cast("string")).alias("uuid"), F.lit(True).alias("held"), F.lit("s").alias("source"), F.col("id").alias("id_data"))
        store.write(f"r{run}", {}, beside=lambda token, version, held=held: holders.append(store, token, version, held))
    entries = holders._entries

    def counting(store, places):
        opened.append(len(places))
        return entries(store, places)

    holders._entries, back = counting, entries
    try:
        assert found(store, ["u2-17", "u2-18"]) == {("u2-17", 17), ("u2-18", 18)}
        assert found(store, [f"new{i}" for i in range(40)]) == set()
    finally:
        holders._entries = back
    # Of 32 files: one or two for two uuids, hardly any for unknown ones.
    assert opened[0] <= 3 and opened[1] <= 10


def test_a_store_without_an_index_gets_one(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    first = batch(spark, [(1, "a"), (2, "b")]).drop("seq")
    store.write("old", {}, {"data_json": (first, store.touched(first))})
    wanted = spark.createDataFrame([("a",)], "uuid string")
    assert holders.find(store, wanted, 1) is None
    upsert_into_store(store, "new", batch(spark, [(3, "a"), (4, "d")]))
    assert stored(store) == {1: "a", 2: "b", 4: "d"}
    assert found(store, ["a", "b", "d", "x"]) == {("a", 1), ("b", 2), ("d", 4)}
    with pytest.raises(ValueError, match="uuid parts"):
        holders.find(Store(spark, str(tmp_path), uuid_parts=5), wanted, 2)


def test_the_slower_of_two_writers_starts_again(spark, tmp_path, monkeypatch):
    store, other = Store(spark, str(tmp_path)), Store(spark, str(tmp_path))
    record, overtaken = Store._record, []

    def late(self, version, text):
        if not overtaken:
            overtaken.append(version)
            upsert_into_store(other, "fast", batch(spark, [(1, "a"), (2, "b")]))
        record(self, version, text)

    monkeypatch.setattr(Store, "_record", late)
    upsert_into_store(store, "slow", batch(spark, [(2, "c"), (3, "a"), (4, "d")]))
    # As if "fast" had come first: the uuid a is taken, and key 2 keeps its own.
    assert overtaken == [1] and store.version() == 2
    assert stored(store) == {1: "a", 2: "b", 4: "d"}
    assert store.has_run("fast") and store.has_run("slow")


def test_one_record_per_version(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.write("r1", {"t": spark.range(1)}, base=0)
    with pytest.raises(Conflict):
        store.write("r2", {"t": spark.range(2)}, base=0)
    assert store.version() == 1 and store.read("t", "id bigint").count() == 1
