"""Merges against a row-by-row simulation."""

import random

import pytest

from gleanery import schemas as S
from gleanery.operators import components as graph
from gleanery.operators import lineage, merge
from gleanery.operators.merge import delete_by_log, upsert_data, upsert_metadata

BATCH = S.DATA_JSON + ", seq bigint"


def arrivals(rnd, n, keys, uuids, start=0, import_id=1):
    out = []
    for i in range(n):
        # One uuid and one key have a large share of the rows.
        key = 1 if rnd.random() < 0.3 else rnd.randrange(keys)
        uid = "hot" if rnd.random() < 0.3 else (None if rnd.random() < 0.1 else f"u{rnd.randrange(uuids)}")
        source = f"s{key % 2}"
        out.append((source, "data", "t", key, uid, f'{{"n":{start + i}}}', None, import_id, start + i))
    return out


def serial(state, rows):
    """state: key -> [uuid, item]; returns rejected sequence numbers and writes per key."""
    holders = {u for u, _ in state.values() if u is not None}
    rejected, writes = [], {}
    for source, _, kind, id_data, uid, item, _, _, seq in rows:
        key = (id_data, source, kind)
        if key in state:
            state[key][1] = item
        elif uid is not None and uid in holders:
            rejected.append(seq)
            continue
        else:
            state[key] = [uid, item]
            if uid is not None:
                holders.add(uid)
        writes[key] = writes.get(key, 0) + 1
    return rejected, writes


def as_state(df):
    return {(r["id_data"], r["source"], r["type"]): [r["uuid"], r["item"]] for r in df.collect()}


@pytest.mark.parametrize("seed", range(4))
def test_upsert_equals_row_by_row(spark, seed):
    rnd = random.Random(seed)
    want, state = {}, spark.createDataFrame([], S.DATA_JSON)
    for run in range(2):
        rows = arrivals(rnd, 300, 60, 80, start=1000 * run, import_id=run + 1)
        rejected, writes = serial(want, rows)
        merged = upsert_data(state, spark.createDataFrame(rows, BATCH).repartition(5))
        assert as_state(merged.state) == want
        assert sorted(r["seq"] for r in merged.rejected.collect()) == rejected
        got = {(r["id_data"], r["source"], r["type"]): r["writes"] for r in merged.written.collect()}
        assert got == writes
        state = spark.createDataFrame(merged.state.collect(), S.DATA_JSON)


def one_uuid_rows(n=200):
    return [(f"s{i % 2}", "data", "t", i % 70, f"u{i % 70 // 2}", f'{{"n":{i}}}', None, 1, i) for i in range(n)]


def test_single_pass_when_keys_have_one_uuid(spark):
    rows, want = one_uuid_rows(), {}
    rejected, writes = serial(want, rows)
    merged = upsert_data(spark.createDataFrame([], S.DATA_JSON), spark.createDataFrame(rows, BATCH))
    assert as_state(merged.state) == want
    assert sorted(r["seq"] for r in merged.rejected.collect()) == rejected
    # Every arrival is stored, superseded or rejected.
    assert sum(writes.values()) + len(rejected) == len(rows)


def test_upsert_twice_is_upsert_once_and_splits_do_not_matter(spark):
    rows = one_uuid_rows()
    empty = spark.createDataFrame([], S.DATA_JSON)
    once = as_state(upsert_data(empty, spark.createDataFrame(rows, BATCH)).state)
    state = upsert_data(empty, spark.createDataFrame(rows, BATCH)).state
    assert as_state(upsert_data(state, spark.createDataFrame(rows, BATCH)).state) == once
    state = empty
    for part in range(0, 200, 50):
        merged = upsert_data(state, spark.createDataFrame(rows[part : part + 50], BATCH))
        state = spark.createDataFrame(merged.state.collect(), S.DATA_JSON)
    assert as_state(state) == once


def test_key_keeps_its_first_uuid(spark):
    state = spark.createDataFrame([("s", "data", "t", 1, "old", "{}", None, 1)], S.DATA_JSON)
    batch = spark.createDataFrame([("s", "data", "t", 1, "new", '{"n":1}', None, 2, 0)], BATCH)
    assert as_state(upsert_data(state, batch).state) == {(1, "s", "t"): ["old", '{"n":1}']}


def test_metadata_first_in_import_last_import_one_owner(spark):
    layout = S.METADATA_JSON + ", seq bigint"
    row = lambda source, uid, item, run, seq: (source, "metadata", "t", "dataset", uid, item, None, run, seq)
    one = [row("a", "u1", "1", 1, 1), row("a", "u1", "2", 1, 2), row("b", "u1", "3", 2, 3), row("b", "u2", "4", 2, 4)]
    first = upsert_metadata(spark.createDataFrame([], S.METADATA_JSON), spark.createDataFrame(one, layout))
    got = {(r["source"], r["uuid"]): r["item"] for r in first.state.collect()}
    assert got == {("a", "u1"): "1", ("b", "u2"): "4"}
    assert [r["seq"] for r in first.rejected.collect()] == [3]
    two = [row("a", "u1", "9", 3, 1), row("a", "u2", "8", 3, 2), row("a", "u1", "7", 3, 3)]
    second = upsert_metadata(first.state, spark.createDataFrame(two, layout))
    got = {(r["source"], r["uuid"]): (r["item"], r["import_id"]) for r in second.state.collect()}
    assert got == {("a", "u1"): ("9", 3), ("b", "u2"): ("4", 2)}
    assert {(r["uuid"], r["inserted"]) for r in second.written.collect()} == {("u1", False)}


def test_delete_by_log_ignores_the_type(spark):
    state = spark.createDataFrame(
        [("s", "data", t, i, None, "{}", None, 1) for i in (1, 2) for t in ("x", "y")] + [("o", "data", "x", 1, None, "{}", None, 1)],
        S.DATA_JSON,
    )
    log = spark.createDataFrame([("s", 1), ("s", 1), ("s", 77)], "source string, id_data bigint")
    kept, gone = delete_by_log(state, log)
    assert sorted((r["source"], r["id_data"], r["type"]) for r in gone.collect()) == [("s", 1, "x"), ("s", 1, "y")]
    assert kept.count() == 3


def chain(n):
    """Key i wants what key i - 1 has got, and then a uuid of its own."""
    rows = [("s", "data", "t", 0, "u0", "{}", None, 1, 0)]
    for i in range(1, n):
        rows += [("s", "data", "t", i, f"u{i - 1}", "{}", None, 1, 2 * i), ("s", "data", "t", i, f"u{i}", "{}", None, 1, 2 * i + 1)]
    return rows


def test_a_long_chain_of_keys_takes_few_rounds(spark, monkeypatch):
    written = []
    monkeypatch.setattr(graph, "cut", lambda df: written.append(df) or lineage.cut(df))
    rows, want = chain(1000), {}
    rejected, _ = serial(want, rows)
    merged = upsert_data(spark.createDataFrame([], S.DATA_JSON), spark.createDataFrame(rows, BATCH))
    assert as_state(merged.state) == want and len(want) == 1000
    assert sorted(r["seq"] for r in merged.rejected.collect()) == rejected
    rounds = sum("la" in df.columns for df in written)
    assert rounds <= 15


def test_components_too_large_for_a_task_are_settled_in_rounds(spark, monkeypatch):
    rows, want = chain(5) + [("s", "data", "t", 50, "v", "{}", None, 1, 100), ("s", "data", "t", 51, "v", "{}", None, 1, 101)], {}
    serial(want, rows)
    monkeypatch.setattr(merge, "REPLAY_CLAIMS", 4)
    merged = upsert_data(spark.createDataFrame([], S.DATA_JSON), spark.createDataFrame(rows, BATCH))
    assert as_state(merged.state) == want
