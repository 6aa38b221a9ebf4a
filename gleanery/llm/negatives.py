"""Hard-negative mining by a vertical scan of columnar blocks.

Vectors lie in blocks of bounded size, one column per dimension, with the lowest and highest value
of each. An anchor reads the columns in the descending magnitude of its own components. After every
few columns the sum so far and the least and most that the unread ones can add bound each
candidate's score; candidates that can no longer reach a result leave the bitmap. The unread ones
add no more than the ends of their columns allow, nor more than the anchor's length there times the
length of the block's longest vector. The first half of each anchor's columns is summed for a whole
tile in one product of matrices, the others for what is left in the bitmap:

* positives: rows of the anchor's label; out go those below the kth best lower bound;
* negatives: rows of other labels; out go those outside of all windows that the positives' scores
  open, and those below the best lower bounds that already fill a window.

What is left after the last column has its exact score. Anchors come in tiles; every tile meets
every block, which is the stated set of queries against all rows, so tiles are repeated for each
chunk of blocks, in a shuffle. A task holds one chunk, of bounded size, and reads its blocks for one
tile after the other; what an anchor has found in a block bounds the scans of the next ones. A few
rows per anchor and chunk are returned and ranked over all chunks.

Defined results: rows without id or label, with a null, empty or non-finite vector take no part;
vectors meet those of their own length only. Scores are 64-bit integers; larger sums are not defined.
Several rows of one anchor id ask once, with the smallest label and vector; a row with an
anchor's id is never its positive or negative. Repeated rows are candidates each. An anchor without
positives, or a positive without negatives in its window, gives no row; an empty table gives none.
Extra columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gleanery.llm.common import beside, meeting, written
from gleanery.llm.topk import integers

BLOCK_ROWS = 8192
TILE_ROWS = 256
#: Columns read between two looks at the bounds.
STEP = 8
#: Share of a block that must be alive for a column to be read whole: gathering single rows costs more.
DENSE = 1 / 4
#: Candidates that are read to their end at once.
FEW = 32
#: (id, score) of candidates, best first.
Hits = list[tuple[int, int]]


@dataclass(frozen=True)
class Block:
    """Rows of one length: a column per dimension, its least and largest value."""

    ids: np.ndarray
    labels: np.ndarray
    columns: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @cached_property
    def kinds(self) -> dict[type, np.ndarray]:
        return {}

    def of(self, kind: type) -> np.ndarray:
        """The columns as numbers of that kind."""
        if kind not in self.kinds:
            self.kinds[kind] = self.columns.astype(kind)
        return self.kinds[kind]

    @cached_property
    def length(self) -> float:
        """Of the longest vector."""
        return float(np.sqrt(np.square(self.columns.astype(np.float64)).sum(0).max(initial=0)))


def _kind(block: Block, queries: np.ndarray) -> type:
    """Numbers that hold all sums of products exactly: floats do below 2**24, or 2**53."""
    most = np.max(np.abs(queries).astype(np.float64) @ np.maximum(np.abs(block.low), np.abs(block.high)).astype(np.float64), initial=0)
    return np.float32 if most < 2.0**24 else np.float64 if most < 2.0**53 else np.int64


def begun(block: Block, queries: np.ndarray) -> np.ndarray | None:
    """Sums of the first half of each anchor's columns, a row per anchor, as one product of matrices.

    None where only whole numbers hold them: there is no fast product of these.
    """
    kind = _kind(block, queries)
    if kind is np.int64:
        return None
    first = np.argsort(-np.abs(queries), axis=1, kind="stable")[:, : queries.shape[1] // 2]
    some = np.zeros(queries.shape, kind)
    np.put_along_axis(some, first, np.take_along_axis(queries, first, 1).astype(kind), 1)
    return some @ block.of(kind)


class Scan:
    """One anchor over one block; `alive` are the places still in the bitmap.

    `sums` are those of the first half of the columns, if these have been read for all anchors of a tile.
    """

    def __init__(self, block: Block, query: np.ndarray, bitmap: np.ndarray, sums: np.ndarray | None = None) -> None:
        self.block, self.query = block, query
        self.order = np.argsort(-np.abs(query), kind="stable")
        ends = np.stack([query * block.low, query * block.high])[:, self.order]
        rest = np.concatenate([ends, np.zeros((2, 1), np.int64)], 1)[:, ::-1]
        unread = np.sqrt(np.cumsum(np.square(np.append(query[self.order].astype(np.float64), 0)[::-1]))[::-1])
        # A little more than the lengths, for what they lose to rounding.
        reach = np.minimum(np.ceil(unread * block.length * (1 + 1e-9)), 2.0**62).astype(np.int64)
        self.least = np.maximum(np.cumsum(rest.min(0))[::-1], -reach)
        self.most = np.minimum(np.cumsum(rest.max(0))[::-1], reach)
        self.alive = np.flatnonzero(bitmap)
        self.columns = block.of(_kind(block, query[None]))
        self.weights = query.astype(self.columns.dtype)
        self.done = 0 if sums is None else len(query) // 2
        self.sums = np.zeros(len(self.alive), self.columns.dtype) if sums is None else sums[self.alive]
        self.read = self.done * len(self.alive)  # components read, over all candidates

    def steps(self) -> Iterator[tuple[int, int]]:
        """The least and most that the unread columns can add to `sums`, after each step; nothing after the last."""
        size = self.columns.shape[1]
        done = self.done
        if done:
            yield int(self.least[done]), int(self.most[done])
        while done < len(self.order):
            some = self.order[done : done + STEP] if len(self.alive) > FEW else self.order[done:]
            if len(self.alive) >= DENSE * size:
                part = self.columns[some]
                added = self.weights[some] @ part
                self.sums = self.sums + (added if len(self.alive) == size else added[self.alive])
            else:
                part = self.columns[some[:, None], self.alive]
                self.sums = self.sums + self.weights[some] @ part
            self.read += part.size
            done += len(some)
            yield int(self.least[done]), int(self.most[done])

    def keep(self, good: np.ndarray) -> None:
        if not good.all():
            self.alive, self.sums = self.alive[good], self.sums[good]

    def best(self, k: int, inside: np.ndarray | None = None) -> Hits:
        """(id, score) of the k highest exact scores, ties by smaller id."""
        at = np.arange(len(self.alive)) if inside is None else np.flatnonzero(inside)
        ids, scores = self.block.ids[self.alive[at]], self.sums[at].astype(np.int64)
        order = np.lexsort((ids, -scores))[:k]
        return list(zip(ids[order].tolist(), scores[order].tolist(), strict=True))


def _highest(values: np.ndarray, k: int) -> int:
    """The kth highest of more than k values."""
    return int(np.partition(values, len(values) - k)[len(values) - k])


def nearest(scan: Scan, k: int, floor: int | None = None) -> Hits:
    """The k highest scores of the bitmap, of those from `floor` up."""
    for least, most in scan.steps():
        if len(scan.sums) > k:
            sure = _highest(scan.sums, k) + least
            floor = sure if floor is None else max(floor, sure)
        if floor is not None:
            scan.keep(scan.sums >= floor - most)
        if not len(scan.alive):
            break
    return scan.best(k)


def windowed(scan: Scan, windows: list[tuple[int, int]], k: int) -> list[Hits]:
    """The k highest scores of the bitmap in each window (from, to)."""
    for least, most in scan.steps():
        open_ = []
        for low, high in windows:
            if most - least <= high - low:  # else no score is sure to lie inside yet
                sure = scan.sums[(scan.sums >= low - least) & (scan.sums <= high - most)]
                if len(sure) > k:
                    low = max(low, _highest(sure, k) + least)
            open_.append((low - most, high - least))
        good = np.zeros(len(scan.sums), bool)
        for low, high in _merged(open_):
            good |= (scan.sums >= low) & (scan.sums <= high)
        scan.keep(good)
        if not len(scan.alive):
            break
    return [scan.best(k, (scan.sums >= low) & (scan.sums <= high)) for low, high in windows]


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same numbers in ranges that do not overlap."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(ranges):
        if out and low <= out[-1][1]:
            out[-1] = out[-1][0], max(high, out[-1][1])
        else:
            out.append((low, high))
    return out


def _joined(held: Hits, more: Hits, k: int) -> Hits:
    """The k best of both."""
    return sorted(held + more, key=lambda hit: (-hit[1], hit[0]))[:k] if more else held


def _packed(values: np.ndarray) -> tuple[bytes, int]:
    """The numbers in as few bytes each as hold them all."""
    for width in (2, 4):
        if not values.size or np.abs(values).max() < 1 << (8 * width - 1):
            return values.astype(f"<i{width}").tobytes(), width
    return values.astype("<i8").tobytes(), 8


def _matrix(vectors: pa.ListArray, rows: np.ndarray, dim: int) -> np.ndarray:
    offsets = vectors.offsets.to_numpy()
    return vectors.values.to_numpy(zero_copy_only=False)[offsets[rows][:, None] + np.arange(dim)]


def _blocks(size: int):
    """Rows (id, label, vector) as columnar blocks."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, labels, vectors = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2)
            lengths = np.diff(vectors.offsets.to_numpy())
            for dim in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == dim)
                for i in range(0, len(rows), size):
                    part = rows[i : i + size]
                    matrix = _matrix(vectors, part, dim)
                    columns, width = _packed(matrix.T)
                    held = [_bytes(ids[part]), _bytes(labels[part]), columns, _bytes(matrix.min(0)), _bytes(matrix.max(0))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([dim], pa.int32()), pa.array([width], pa.int32()), *(pa.array([h]) for h in held)],
                        ["dim", "width", "ids", "labels", "columns", "low", "high"],
                    )

    return pack


def _tiles(size: int):
    """Anchors (id, label, vector, positives' ids, positives' scores) as tiles."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.diff(batch.column(2).offsets.to_numpy())
            for dim in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == dim)
                for i in range(0, len(rows), size):
                    part = rows[i : i + size]
                    some = batch.take(pa.array(part))
                    fields = [pa.array([_bytes(x)]) for x in (_matrix(batch.column(2), part, dim), batch.column(0).to_numpy()[part])]
                    lists = [pa.array([some.column(c).to_pylist()], pa.list_(batch.column(c).type)) for c in (0, 1, 3, 4)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([dim], pa.int32()), *fields, *lists],
                        ["dim", "columns", "ids", "q_ids", "q_labels", "q_positives", "q_scores"],
                    )

    return pack


def _bytes(values: np.ndarray) -> bytes:
    return values.astype("<i8").tobytes()


def _pairs(blocks: DataFrame, anchors: DataFrame, tile_rows: int) -> DataFrame:
    """Every tile of anchors beside every block."""
    schema = "dim int, columns binary, ids binary, q_ids array<long>, q_labels array<long>, q_positives array<array<long>>, q_scores array<array<long>>"
    tiles = written(anchors.select("id", "label", "v", "positives", "scores").mapInArrow(_tiles(tile_rows), schema))
    return meeting(blocks, tiles, "columns")


def _scanned(search):
    """Run `search` for every anchor of a tile and every block of its length: (place of the positive, id, score) each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile, blocks in beside(batches):
            dim = tile["dim"]
            queries = np.frombuffer(tile["columns"], "<i8").reshape(-1, dim)
            anchors = list(zip(tile["q_ids"], tile["q_labels"], queries, tile["q_positives"], tile["q_scores"], strict=True))
            held: list[dict[int, Hits]] = [{} for _ in anchors]
            for row in blocks:
                ids, labels, low, high = (np.frombuffer(row[c], "<i8") for c in ("ids", "labels", "low", "high"))
                columns = np.frombuffer(row["columns"], f"<i{row['width']}").reshape(dim, -1)
                block = Block(ids, labels, columns, low, high)
                sums = begun(block, queries)
                for i, (own, label, query, _, scores) in enumerate(anchors):
                    search(block, own, label, query, scores, held[i], None if sums is None else sums[i])
            found = [
                (own, place, positives[place] if positives else 0, scores[place] if scores else 0, *hit)
                for known, (own, _, _, positives, scores) in zip(held, anchors, strict=True)
                for place, hits in known.items()
                for hit in hits
            ]
            columns = [pa.array([f[i] for f in found], pa.int64()) for i in range(6)]
            yield pa.RecordBatch.from_arrays(columns, ["anchor_id", "place", "positive_id", "positive_score", "id", "score"])

    return run


FOUND = "anchor_id long, place long, positive_id long, positive_score long, id long, score long"


def _positives(k: int):
    def search(block: Block, own: int, label: int, query: np.ndarray, scores: list[int], known: dict[int, Hits], sums: np.ndarray | None = None) -> None:
        held = known.get(0, [])
        scan = Scan(block, query, (block.labels == label) & (block.ids != own), sums)
        known[0] = _joined(held, nearest(scan, k, held[-1][1] if len(held) == k else None), k)

    return search


def window(score: int, least: int, most: int) -> tuple[int, int]:
    """Whole numbers s with least * score <= 100 * s <= most * score."""
    return -(-least * score // 100), most * score // 100


def _negatives(k: int, least: int, most: int):
    def search(block: Block, own: int, label: int, query: np.ndarray, scores: list[int], known: dict[int, Hits], sums: np.ndarray | None = None) -> None:
        open_ = {}
        for i, score in enumerate(scores):
            low, high = window(score, least, most)
            held = known.get(i, [])
            if low <= high:
                open_[i] = (max(low, held[-1][1]) if len(held) == k else low, high)
        if not open_:
            return
        scan = Scan(block, query, (block.labels != label) & (block.ids != own), sums)
        for i, hits in zip(open_, windowed(scan, [*open_.values()], k), strict=True):
            known[i] = _joined(known.get(i, []), hits, k)

    return search


def mine(
    df: DataFrame,
    positives: int = 5,
    negatives: int = 3,
    least: int = 50,
    most: int = 95,
    every: int = 50,
    scale: int = 256,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str | Column = "label",
    block_rows: int = BLOCK_ROWS,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """For every anchor (id divisible by `every`) and each of its positives the best negatives.

    A negative's score is from `least` to `most` percent of the positive's. Labels are whole numbers; a
    column expression may be given for them.
    """
    label = F.col(f"`{label}`") if isinstance(label, str) else label
    rows = df.select(F.col(f"`{key}`").alias("id"), F.col(f"`{vector}`").alias("v"), label.alias("label"))
    rows = rows.select(F.col("id").cast("long"), F.col("label").cast("long"), integers(F.col("v"), scale).alias("v"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull())
    schema = "dim int, width int, ids binary, labels binary, columns binary, low binary, high binary"
    blocks = written(rows.mapInArrow(_blocks(block_rows), schema))
    asked = rows.where(F.col("id") % every == 0).groupBy("id").agg(F.min(F.struct("label", "v")).alias("own"))
    asked = written(asked.select("id", "own.label", "own.v"))
    nothing = F.array().cast("array<long>")
    pairs = _pairs(blocks, asked.withColumns({"positives": nothing, "scores": nothing}), tile_rows)
    ranked = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id")
    found = pairs.mapInArrow(_scanned(_positives(positives)), FOUND).withColumn("at", F.row_number().over(ranked)).where(F.col("at") <= positives)
    held = F.sort_array(F.collect_list(F.struct("at", "id", "score")))  # `positives` at most
    known = found.groupBy(F.col("anchor_id").alias("id")).agg(held.alias("held"))
    anchors = asked.join(known, "id").withColumns({"positives": F.col("held.id"), "scores": F.col("held.score")})
    pairs = _pairs(blocks, anchors, tile_rows)
    ranked = Window.partitionBy("anchor_id", "place").orderBy(F.desc("score"), "id")
    hits = pairs.mapInArrow(_scanned(_negatives(negatives, least, most)), FOUND).withColumn("rank", F.row_number().over(ranked))
    return hits.where(F.col("rank") <= negatives).select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
        (F.col("place") + 1).cast("int").alias("positive_rank"),
    )
