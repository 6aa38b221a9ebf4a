import math

import numpy as np

from gleanery.llm import topk
from gleanery.llm.topk import top_k

SCHEMA = "vec_id long, embedding array<float>, score string, rank int"


def brute(rows, k, every, scale):
    good = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    asked = {}
    for i, v in good:
        if i % every == 0:
            asked[i] = min(asked.get(i, v), v)
    for q, w in asked.items():
        found = sorted((-sum(a * b for a, b in zip(w, v)), i) for i, v in good if i != q and len(v) == len(w))[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found)]
    return sorted(out)


def check(spark, rows, **options):
    df = spark.createDataFrame([(i, v, "x", 0) for i, v in rows], SCHEMA)
    got = top_k(df, k=5, every=10, **options).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == brute(rows, 5, 10, 256)


def test_equals_brute_force_with_ties_copies_and_bad_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=6).round(1).tolist()) for i in range(120)]
    rows += [(200 + i, [0.5] * 6) for i in range(30)] + [(500, [0.5] * 6), (500, [0.25] * 6), (777, [0.5] * 6), (777, [0.5] * 6)]
    rows += [(20, None), (30, []), (40, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (210, [float("nan")] * 6), (60, [float("inf")] * 6), (None, [1.0] * 6)]
    rows += [(1010, [1.0, 2.0]), (1011, [2.0, 1.0])]
    check(spark, rows, block_rows=16, query_rows=4, cells=4)
    check(spark, rows)


def test_fewer_candidates_and_no_rows(spark):
    check(spark, [(0, [1.0, 2.0]), (1, [3.0, 4.0])])
    check(spark, [])


def test_bounds_hold_from_the_cells_alone():
    rng = np.random.default_rng(5)
    for spread in (3, 1000, 10**7):
        matrix, queries = rng.integers(-spread, spread, (200, 12)), rng.integers(-spread, spread, (9, 12))
        codes, low, width = topk.quantise(matrix, 64)
        assert codes.dtype == np.uint8 and codes.max() < 64
        least, most = topk.bounds(queries, codes, low, width)
        exact = queries @ matrix.T
        assert (least <= exact).all() and (exact <= most).all()


def test_few_exact_vectors_are_read(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(3000)]
    read = []
    in_order = topk._read_in_order
    monkeypatch.setattr(topk, "_read_in_order", lambda *a: read.append(in_order(*a)) or read[-1])
    df = spark.createDataFrame([(i, v, "x", 0) for i, v in rows], SCHEMA)
    got = top_k(df, k=5, every=100, block_rows=256).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == brute(rows, 5, 100, 256)
    assert read[0][1] < 30 * 3000 / 100  # of 30 times 3 000 products


def test_blocks_and_queries_meet_without_a_broadcast(spark, monkeypatch):
    plans, written = [], topk.written

    def watched(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return written(df)

    monkeypatch.setattr(topk, "written", watched)
    rng = np.random.default_rng(6)
    check(spark, [(i, rng.normal(size=8).tolist()) for i in range(400)], block_rows=32, query_rows=8)
    scans = [p for p in plans if p.count("MapInArrow") and "least" in p.split("MapInArrow")[1].split("\n")[0]]
    assert scans and not any("Broadcast" in p for p in scans)


def test_candidates_of_many_blocks_hold_the_best(monkeypatch):
    rng = np.random.default_rng(7)
    matrix, queries, asked = rng.integers(-90, 90, (600, 10)), rng.integers(-90, 90, (7, 10)), np.arange(7) * 20
    matrix[300:330] = matrix[20]
    exact = queries @ matrix.T
    for most in (1 << 20, 40):
        monkeypatch.setattr(topk, "HELD", most)
        held, found = topk.Candidates(asked, 5), []
        for i in range(0, 600, 50):
            codes, low, width = topk.quantise(matrix[i : i + 50], 16)
            rows = np.arange(i, i + 50)
            held.add(rows, rows, *topk._edges(queries, codes, low, width))
            if held.full():
                found += [r for b in held.taken() for r in b.to_pylist()]
        found += [r for b in held.taken() for r in b.to_pylist()]
        for at, q in enumerate(asked.tolist()):
            mine = {r["row"]: r for r in found if r["query_id"] == q}
            best = sorted((-exact[at, r], r) for r in range(600) if r != q)[:5]
            assert q not in mine and all(r in mine for _, r in best)
            assert all(r["least"] <= exact[at, r["row"]] <= r["most"] for r in mine.values())
        assert len(found) < 7 * 600 / 2
