"""Hard negatives against a brute-force ranking of all rows."""

import math
import random

import numpy as np
import pytest

from gleanery.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int, id string, slot string, v string"


def plain(rows, every, positives, count, least, most, scale=256):
    good = []
    for key, vector, label in rows:
        if key is not None and label is not None and vector and all(x is not None and math.isfinite(x) for x in vector):
            good.append((key, label, [math.floor(scale * x) for x in vector]))
    anchors = {}
    for key, label, vector in good:
        if key % every == 0:
            anchors[key] = min(anchors.get(key, (label, vector)), (label, vector))
    out = []
    for own, (label, vector) in anchors.items():
        scored = [(-sum(a * b for a, b in zip(vector, v, strict=True)), k, lab) for k, lab, v in good if k != own and len(v) == len(vector)]
        best = sorted((s, k) for s, k, lab in scored if lab == label)[:positives]
        for place, (s, k) in enumerate(best):
            inside = sorted((t, j) for t, j, lab in scored if lab != label and least * -s <= 100 * -t <= most * -s)[:count]
            out += [(own, k, rank + 1, j, -s, -t, place + 1) for rank, (t, j) in enumerate(inside)]
    return sorted(out)


def got(spark, rows, **parameters):
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)
    found = negatives.mine(df, **parameters)
    return sorted(tuple(r) for r in found.collect())


def table(seed, n, dims=(6,), labels=3, spread=0.4):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        rows.append((i, [round(draw.gauss(0.3, spread), 2) for _ in range(draw.choice(dims))], draw.randrange(labels)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = table(seed, 220, dims=(6, 6, 9), spread=0.3)
    wanted = plain(rows, 7, 5, 3, 50, 95)
    assert wanted and got(spark, rows, every=7, block_rows=40, tile_rows=5) == wanted


def test_ties_copies_nulls_and_odd_vectors(spark):
    rows = table(3, 90, spread=0.05) + [(200 + i, [0.5] * 6, i % 2) for i in range(60)]
    rows += [(50, [0.4] * 6, 1), (51, [0.4] * 6, 1), (51, [0.4] * 6, 1), (52, [0.4] * 6, 0), (52, [0.4] * 6, 0)]
    rows += [(None, [0.4] * 6, 1), (300, None, 1), (350, [], 1), (400, [0.1, None] * 3, 1), (450, [float("nan")] * 6, 1), (500, [float("inf")] * 6, 0), (550, [0.3] * 6, None)]
    rows += [(600, [0.9] * 4, 1), (650, [0.0] * 6, 0), (700, [-0.5] * 6, 1)]
    wanted = plain(rows, 10, 5, 3, 50, 95)
    assert wanted and got(spark, rows, every=10, block_rows=32) == wanted


def test_labels_by_expression_and_empty_table(spark):
    from pyspark.sql import functions as F

    rows = table(4, 60)
    moved = [(k, v, (lab + 1) % 3) for k, v, lab in rows]
    assert got(spark, rows, every=10, label=(F.col("label") + 1) % 3) == plain(moved, 10, 5, 3, 50, 95)
    assert got(spark, []) == [] and got(spark, rows[:1]) == []


def test_scan_leaves_columns_of_lost_candidates_unread():
    draw = np.random.default_rng(1)
    columns = draw.integers(-100, 100, (64, 4000))
    columns[:8] *= 10  # the first columns decide
    query = np.concatenate([np.full(8, 200), draw.integers(-20, 20, 56)])
    block = negatives.Block(np.arange(4000), np.zeros(4000, np.int64), columns, columns.min(1), columns.max(1))
    scores = query @ columns
    scan = negatives.Scan(block, query, np.ones(4000, bool))
    best = sorted(zip((-scores).tolist(), range(4000), strict=True))[:5]
    assert negatives.nearest(scan, 5) == [(i, -s) for s, i in best]
    assert scan.read < columns.size / 4
    scan = negatives.Scan(block, query, np.ones(4000, bool))
    low, high = negatives.window(-best[0][0], 50, 95)
    inside = sorted((-s, i) for i, s in enumerate(scores.tolist()) if low <= s <= high)[:3]
    assert negatives.windowed(scan, [(low, high)], 3) == [[(i, -s) for s, i in inside]]
    assert scan.read < columns.size / 2


@pytest.mark.parametrize("score", [-7, -1, 0, 1, 2, 19, 100, 333])
def test_window_is_exact(score):
    low, high = negatives.window(score, 50, 95)
    assert [s for s in range(-500, 500) if 50 * score <= 100 * s <= 95 * score] == list(range(low, high + 1))


def test_tiles_and_blocks_meet_without_a_broadcast(spark, monkeypatch, capsys):
    rows, met = table(5, 300), []
    meeting = negatives.meeting
    monkeypatch.setattr(negatives, "meeting", lambda *a: met.append(meeting(*a)) or met[-1])
    wanted = plain(rows, 5, 5, 3, 50, 95)
    assert wanted and got(spark, rows, every=5, block_rows=32, tile_rows=8) == wanted
    assert len(met) == 2
    for pairs in met:
        assert "Broadcast" not in pairs._jdf.queryExecution().executedPlan().toString()
        dealt = pairs.select("slot", "is_tile", "ids").collect()
        beside = [(b["ids"], t["ids"]) for t in dealt if t["is_tile"] for b in dealt if not b["is_tile"] and b["slot"] == t["slot"]]
        tiles, blocks = {t["ids"] for t in dealt if t["is_tile"]}, {b["ids"] for b in dealt if not b["is_tile"]}
        assert len(beside) == len(set(beside)) == len(tiles) * len(blocks)


@pytest.mark.parametrize("size", [1, 10**4, 10**6])
def test_bounds_of_earlier_blocks_lose_nothing(size):
    draw = np.random.default_rng(2)
    vectors = draw.integers(-100, 100, (900, 20)) * size
    vectors[400:420] = vectors[7]
    ids, labels = np.arange(900), draw.integers(0, 3, 900)
    search = {"positives": negatives._positives(5), "negatives": negatives._negatives(3, 50, 95)}
    for own in (7, 30, 411):
        scores, found = (vectors.astype(object) @ vectors[own].astype(object)).tolist(), {}
        best = sorted((-s, i) for i, s in enumerate(scores) if labels[i] == labels[own] and i != own)[:5]
        for kind, run in search.items():
            known = found.setdefault(kind, {})
            for i in range(0, 900, 100):
                part = vectors[i : i + 100]
                block = negatives.Block(ids[i : i + 100], labels[i : i + 100], part.T, part.min(0), part.max(0))
                sums = negatives.begun(block, vectors[[own]]) if i % 200 else None
                run(block, own, labels[own], vectors[own], [-s for s, _ in best], known, None if sums is None else sums[0])
        assert found["positives"][0] == [(i, -s) for s, i in best]
        for place, (s, _) in enumerate(best):
            low, high = negatives.window(-s, 50, 95)
            inside = sorted((-t, i) for i, t in enumerate(scores) if labels[i] != labels[own] and low <= t <= high)[:3]
            assert found["negatives"].get(place, []) == [(i, -t) for t, i in inside]
