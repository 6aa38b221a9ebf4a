import hashlib
import random

from pyspark.sql import functions as F

from gleanery.operators import pages as P
from gleanery.operators.dims import get_or_insert, insert_ignore
from gleanery.operators.joins import join_lookup, spread_join
from gleanery.operators.keys import assign_ids, number_by_id, running_total


def test_ids_follow_the_digest_and_continue(spark):
    names = [f"k{i}" for i in range(500)]
    new = spark.createDataFrame([(n,) for n in names], "k string")
    taken = spark.createDataFrame([(7,), (41,)], "id bigint")
    got = {r["k"]: r["id"] for r in assign_ids(new, F.col("k"), "id", taken).collect()}
    order = sorted(names, key=lambda n: hashlib.md5(n.encode()).hexdigest())
    assert got == {n: 42 + i for i, n in enumerate(order)}
    again = assign_ids(new.repartition(7), F.col("k"), "id", taken)
    assert {r["k"]: r["id"] for r in again.collect()} == got
    assert assign_ids(new.limit(0), F.col("k"), "id", taken).count() == 0


def test_running_total_over_blocks(spark):
    rnd = random.Random(1)
    rows = [(run, page, rnd.randint(0, 9)) for run in "ab" for page in range(0, 57, 2)]
    got = running_total(spark.createDataFrame(rows, "run string, page bigint, n bigint"), ["run"], "page", "n", "t", block=5)
    want, sums = {}, {}
    for run, page, n in sorted(rows):
        sums[run] = sums.get(run, 0) + n
        want[run, page] = sums[run]
    assert {(r["run"], r["page"]): r["t"] for r in got.collect()} == want


def test_positions(spark):
    ids = random.Random(2).sample(range(10_000), 300)
    df = spark.createDataFrame([(i, i % 7) for i in ids], "id bigint, g int")
    got = {r["id"]: r["n"] for r in number_by_id(df, "id", "n", block=100).collect()}
    assert got == {i: n + 1 for n, i in enumerate(sorted(ids))}
    got = {r["id"]: r["n"] for r in P.number_by_order(df.repartition(5), ["g", "id"], "n").collect()}
    assert got == {i: n + 1 for n, i in enumerate(sorted(ids, key=lambda i: (i % 7, i)))}


def test_page_plan(spark):
    totals = spark.createDataFrame([("a", 0), ("b", 1), ("c", 100), ("d", 101), ("e", 2_500_000)], "s string, total bigint")
    got = P.page_plan(totals, "total", 100).groupBy("s").agg(F.count("*").alias("n"), F.min("page"), F.max("page")).collect()
    assert {tuple(r) for r in got} == {("b", 1, 0, 0), ("c", 1, 0, 0), ("d", 2, 0, 1), ("e", 25_000, 0, 24_999)}
    first = P.page_plan(totals.where("s = 'd'"), "total", 100, "page").orderBy("page").collect()
    assert [r["query"] for r in first] == ["limit=100&page=1", "limit=100&page=2"]


def test_pages_come_back_in_order(spark):
    items = spark.range(0, 250).select(F.col("id"), F.concat(F.lit('{"i":'), F.col("id").cast("string"), F.lit("}")).alias("item"))
    back = P.scan_pages(P.to_envelopes(P.paginate(items, 100, id_column="id"), "item", 100, 250))
    rows = back.orderBy("page_no", "pos").collect()
    assert [r["item"] for r in rows] == [f'{{"i":{i}}}' for i in range(250)]
    assert {r["total_len"] for r in rows} == {250}


def test_spread_join_with_a_key_that_has_a_third_of_the_rows(spark):
    left = [(i, 1 if i % 3 == 0 else (None if i % 11 == 0 else i % 50)) for i in range(3000)]
    ldf = spark.createDataFrame(left, "i bigint, k bigint")
    rdf = spark.createDataFrame([(k, f"v{k}") for k in range(0, 40)], "k bigint, v string")
    for how in ("left", "inner"):
        want = sorted(map(repr, ldf.join(rdf, ["k"], how).select("i", "k", "v").collect()))
        assert sorted(map(repr, spread_join(ldf, rdf, ["k"], how).select("i", "k", "v").collect())) == want
        assert sorted(map(repr, join_lookup(ldf, rdf, ["k"], how, max_rows=5).select("i", "k", "v").collect())) == want
    spread = spread_join(ldf, rdf, ["k"], "left", spread_by=["i"])
    plan = spread._jdf.queryExecution().toString()
    assert "_salt" in plan


def test_get_or_insert_takes_the_first_and_skips_missing_columns(spark):
    existing = spark.createDataFrame([(5, "a", "old")], "id bigint, k string, name string")
    wanted = spark.createDataFrame(
        [("a", "new", 1, "x"), ("b", "late", 9, "x"), ("b", "early", 2, "x"), (None, "none", 3, "x")],
        "k string, name string, seq bigint, additional_data string",
    )
    grown = get_or_insert(existing, wanted, "k", "id", ["seq"])
    assert {tuple(r) for r in grown.rows.collect()} == {(5, "a", "old"), (6, "b", "early")}
    assert [tuple(r) for r in grown.added.collect()] == [(6, "b", "early")]


def test_insert_ignore(spark):
    layout = "a int, b int, c string"
    existing = spark.createDataFrame([(1, 1, "old")], layout)
    wanted = [(1, 1, "new"), (2, 1, "z"), (2, 1, "y"), (None, 1, "n"), (None, 1, "n")]
    got = insert_ignore(existing, spark.createDataFrame(wanted, layout), ["a", "b"])
    # Keys with a null part never collide, as in a unique constraint.
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(
        map(repr, [(2, 1, "y"), (None, 1, "n"), (None, 1, "n")])
    )


def test_sparse_ids_are_numbered_without_blocks(spark):
    ids = [n * 10**12 + 7 for n in range(-20, 80)]
    df = spark.createDataFrame([(i,) for i in ids], "id bigint")
    got = {r["id"]: r["n"] for r in number_by_id(df, "id", "n").collect()}
    assert got == {i: n + 1 for n, i in enumerate(ids)}


def test_query_strings_are_encoded_and_repeat(spark):
    totals = spark.createDataFrame([(2,)], "total bigint")
    plan = P.page_plan(totals, "total", 2, parameters={"orderby": "id_synthese", "f": ["a b", "é&"], "none": None})
    assert plan.first()["query"] == "limit=2&offset=0&orderby=id_synthese&f=a+b&f=%C3%A9%26"
