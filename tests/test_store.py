from unittest.mock import MagicMock

import pytest
from pyspark.sql import functions as F

from gleanery import schemas as S
from gleanery.operators import lineage
from gleanery.sources.snapshot import Store


def rows(spark, ids, item="{}"):
    return spark.createDataFrame([("s", "data", "t", i, None, item, None, 1) for i in ids], S.DATA_JSON)


def save(store, run, ids, item="{}"):
    df = rows(store._spark, ids, item)
    store.write(run, {}, {"data_json": (df, store.touched(df))})


def held(store):
    return sorted(r["id_data"] for r in store.read_ranged("data_json", S.DATA_JSON).collect())


def test_opening_a_store_writes_nothing(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    assert store.version() == 0 and held(store) == [] and not (tmp_path / "store").exists()


def test_a_run_that_died_before_its_commit_leaves_nothing(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path), ids_per_range=10)
    save(store, "r1", [1, 2, 15])
    append = Store._append

    def dies(self, df, name):
        if name == "commits":
            raise RuntimeError("died")
        append(self, df, name)

    monkeypatch.setattr(Store, "_append", dies)
    with pytest.raises(RuntimeError):
        save(store, "r2", [1, 3], "dead")
    monkeypatch.setattr(Store, "_append", append)
    assert held(store) == [1, 2, 15]
    save(store, "r3", [15, 16])
    assert held(store) == [1, 2, 15, 16] and store.version() == 2 and not store.has_run("r2")


def test_tables_not_written_by_a_run_stay(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.write("r1", {"organisms": spark.range(3).select(F.col("id").alias("id_organisme"))}, None, {"log": spark.range(1)})
    save(store, "r2", [1])
    store.write("r3", {}, None, {"log": spark.range(5, 7)})
    assert store.read("organisms", "id_organisme bigint").count() == 3
    assert sorted(r["id"] for r in store.read_added("log", "id bigint").collect()) == [0, 5, 6]


def test_intermediate_tables_need_a_shared_folder():
    session = MagicMock()
    session.conf.get.return_value = None
    session.sparkContext.master = "spark://host:7077"
    session.sparkContext._jsc.sc().getCheckpointDir().isEmpty.return_value = True
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        lineage.shared_folder(session)
