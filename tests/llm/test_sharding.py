import zlib
from collections import Counter

from gleanery.llm.sharding import Node, balanced, grown, leaves, place, shard_rows


def test_every_row_has_a_slot_and_growth_moves_into_the_new_shard_only(spark):
    rows = [(i, None if i % 7 == 0 else "x" * (i % 5) + "é", "clash", 1) for i in range(500)] + [(3, "xxxé", "clash", 1)] * 40 + [(None, "n", "clash", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard string, slot int")
    got = shard_rows(df, balanced(3, 2, 4)).collect()
    assert len(got) == len(rows)
    for shard, n in Counter(r["shard"] for r in got).items():
        assert 0 <= shard < 24 and sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(n))
    assert all(r["grown_shard"] in (r["shard"], 24) for r in got)
    moved = sum(r["grown_shard"] == 24 for r in got)
    assert 5 < moved < 60
    assert len({r["shard"] for r in got if r["doc_id"] == 3}) == 1
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[7]["size"] == 8 and by_id[7]["text_crc32"] is None
    assert by_id[1]["size"] == 8 + len("xé".encode()) and by_id[1]["text_crc32"] == zlib.crc32("xé".encode())


def test_a_changed_weight_moves_rows_of_its_subtree_only(spark):
    def tree(weight):
        a = Node("a", (Node("a0", shard=0), Node("a1", shard=1)))
        b = Node("b", (Node("b0", shard=2), Node("b1", shard=3, own_weight=weight)))
        return Node("root", (a, b))

    df = spark.range(4000)
    before = {r["id"]: r["s"] for r in place(df, "id", tree(1.0), "s").collect()}
    after = {r["id"]: r["s"] for r in place(df, "id", tree(3.0), "s").collect()}
    assert all(after[i] in (2, 3) for i in before if after[i] != before[i])  # only into the heavier region
    assert all(after[i] == before[i] for i in before if after[i] in (0, 1))
    share = Counter(after.values())
    assert abs(share[0] / 4000 - 1 / 6) < 0.04 and abs(share[3] / 4000 - 4 / 6 * 3 / 4) < 0.04


def test_empty_table_and_repeated_growth(spark):
    assert shard_rows(spark.createDataFrame([], "doc_id long, text string"), balanced(1, 1, 2)).count() == 0
    twice = grown(grown(balanced(1, 1, 2)))
    assert [leaf.shard for leaf in leaves(twice)] == [0, 1, 2, 3]
