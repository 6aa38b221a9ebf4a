"""Gaps in page numbers against a plain comparison with the plan."""

import math
import random

import pytest

from gleanery.operators.pages import page_gaps


def plain(rows):
    out = set()
    for key in {r[0] for r in rows}:
        pages = [r[1] for r in rows if r[0] == key and r[1] is not None]
        told = [(r[2], r[3]) for r in rows if r[0] == key and r[1] is not None and r[2] is not None and r[3]]
        if not pages:
            continue
        planned = max(1, math.ceil(max(told)[0] / max(told)[1])) if told else None
        first = 1 if min(pages) > 0 and (planned is None or max(pages) >= planned) else 0
        last = max(pages) if planned is None else first + planned - 1
        start = None
        for n in range(first, last + 2):
            if n <= last and n not in pages:
                start = n if start is None else start
            elif start is not None:
                out.add((key, "missing", start, n - 1))
                start = None
        for n in set(pages):
            if pages.count(n) > 1:
                out.add((key, "doubled", n, n))
            if not first <= n <= last:
                out.add((key, "surplus", n, n))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_equals_a_plain_comparison(spark, seed):
    draw = random.Random(seed)
    rows = []
    for key in range(12):
        planned = draw.choice([None, 0, 1, 7, 30, 60])
        first = draw.choice([0, 1])
        for n in range(first, first + (planned or draw.randint(1, 40)) + draw.choice([0, 0, 4])):
            for _ in range(draw.choice([0, 1, 1, 1, 2]) if key % 4 else 1):
                rows.append((f"s{key}", n, None if planned is None else planned * 10 - (3 if planned else 0), None if planned is None else 10))
    rows += [("nameless", None, 10, 10), ("s1", None, None, None)]
    df = spark.createDataFrame(rows, "source string, page_no bigint, total_filtered bigint, `limit` bigint")
    got = [tuple(r) for r in page_gaps(df, ["source"], block=8).collect()]
    assert len(got) == len(set(got)) and set(got) == plain(rows)


def test_a_long_plan_is_not_written_out(spark):
    df = spark.createDataFrame([("s", 0, 10**15, 10), ("s", 10**13, 10**15, 10)], "source string, page_no bigint, total_filtered bigint, `limit` bigint")
    rows = sorted((r["first_page"], r["last_page"]) for r in page_gaps(df, ["source"]).collect())
    assert rows == [(1, 10**13 - 1), (10**13 + 1, 10**14 - 1)]
