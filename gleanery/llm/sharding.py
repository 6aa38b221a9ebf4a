"""Sharding by a hierarchical weighted hash tree.

A row descends from the root over regions and racks to a shard. At each level every child
draws a straw from the hash of (key, name of the child), divided by the weight below it,
and the shortest straw wins. A change of weight below one child changes that child's straws
alone, so rows move only into (or out of) the subtree whose weight changed.

A shard that is added opens a branch of its own at the root: the straws of all other
branches stay as they were, so rows move into the new shard only, whatever the tree was.

Defined results: a null key draws like any other key; equal keys share a shard; a null text
has no bytes and no checksum; an empty table gives an empty result. Slots run from 0 without
gaps in every shard; rows that agree in everything get slots in any order.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gleanery.llm.common import picked, written

ROWS_PER_BUCKET = 4096


@dataclass(frozen=True)
class Node:
    """A region, a rack or (with a shard number) a leaf. The name must be unique in the tree."""

    name: str
    children: tuple[Node, ...] = ()
    shard: int = -1
    own_weight: float = 1.0
    weight: float = field(init=False)

    def __post_init__(self) -> None:
        weight = sum(c.weight for c in self.children) if self.children else self.own_weight
        if weight < 0 or (self.children and weight == 0):
            raise ValueError(f"{self.name}: weights must be positive")
        object.__setattr__(self, "weight", weight)


def balanced(regions: int, racks: int, shards: int) -> Node:
    """A tree of equal weights; shards are numbered from 0 in order."""
    number = iter(range(regions * racks * shards))
    return Node(
        "root",
        tuple(
            Node(
                f"region{r}",
                tuple(
                    Node(f"region{r}/rack{k}", tuple(Node(f"shard{i}", shard=i) for i in _take(number, shards)))
                    for k in range(racks)
                ),
            )
            for r in range(regions)
        ),
    )


def _take(numbers: Iterable[int], count: int) -> list[int]:
    return [next(numbers) for _ in range(count)]


def grown(tree: Node, weight: float = 1.0) -> Node:
    """The tree with one more shard, in a branch of its own."""
    number = 1 + max(leaf.shard for leaf in leaves(tree))
    branch = Node(f"added{number}", (Node(f"shard{number}", shard=number, own_weight=weight),))
    return Node(tree.name, (*tree.children, branch))


def leaves(node: Node) -> list[Node]:
    return [leaf for c in node.children for leaf in leaves(c)] if node.children else [node]


def _straw(key: Column, child: Node) -> Column:
    """Exponential draw of rate `weight`; the hash has 53 usable bits and never gives 0."""
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(child.name)), 11)
    return -F.log((bits + F.lit(0.5)) * F.lit(2.0**-53)) / F.lit(child.weight)


def _draw(key: Column, node: Node, numbers: dict[str, int]) -> Column:
    """Number of the child of `node` with the shortest straw."""
    kids = [c for c in node.children if c.weight > 0]
    if len(kids) == 1:
        return F.lit(numbers[kids[0].name])
    straws = [F.struct(_straw(key, c).alias("straw"), F.lit(numbers[c.name]).alias("node")) for c in kids]
    return F.least(*straws)["node"]


def place(df: DataFrame, key: str, tree: Node, into: str) -> DataFrame:
    """Add the shard of every row, one level of the tree after the other."""
    level, numbers = [tree], {}
    here = None
    while level:
        kids = [c for n in level for c in n.children]
        numbers |= {c.name: len(numbers) + i for i, c in enumerate(kids)}
        step = here
        for n in level:
            if n.children:
                drawn = _draw(F.col(key), n, numbers)
                if here is None:
                    step = drawn
                else:
                    step = F.when(F.col(into) == numbers[n.name], drawn).otherwise(step)
        if kids:
            df = df.withColumn(into, step)
            here = F.col(into)
        level = kids
    shard = F.create_map(*[x for leaf in leaves(tree) for x in (F.lit(numbers[leaf.name]), F.lit(leaf.shard))])
    return df.withColumn(into, F.element_at(shard, F.col(into)))


def with_slots(df: DataFrame, shard: str, spread_by: list[str], n_shards: int, into: str) -> DataFrame:
    """Number the rows of every shard from 0 without sending a shard through one task.

    Rows fall into buckets by the hash of `spread_by`; the counts of the buckets give each
    bucket its first slot, and rows are numbered within their bucket only.
    """
    buckets = max(1, -(-df.count() // (n_shards * ROWS_PER_BUCKET)))
    df = df.withColumn("_bucket", F.pmod(F.xxhash64(*spread_by), F.lit(buckets)))
    counts = df.groupBy(shard, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(shard).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(shard, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    inside = Window.partitionBy(shard, "_bucket").orderBy(*spread_by)
    numbered = df.withColumn("_at", F.row_number().over(inside) - 1)
    return (
        numbered.join(first, [shard, "_bucket"])
        .withColumn(into, F.col("_first") + F.col("_at"))
        .drop("_bucket", "_first", "_at")
    )


def shard_rows(df: DataFrame, tree: Node, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row with its shard, its slot there, and its shard after one more is added."""
    rows = picked(df, doc_id=key, text=text).select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32("text").alias("text_crc32"),
    )
    rows = place(place(rows, "doc_id", tree, "shard"), "doc_id", grown(tree), "grown_shard")
    rows = written(rows)
    rows = with_slots(rows, "shard", ["doc_id", "text_crc32", "size"], len(leaves(tree)), "slot")
    return rows.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        "slot",
        "grown_shard",
    )
