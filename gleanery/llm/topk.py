"""Exact top-k search with vector-approximation files.

Every vector is quantised: each dimension of a block is cut into cells of equal width, and the cell
numbers (one byte per dimension) are the approximation file, written once beside the exact vectors. A
search first scans the cells alone. They bound an inner product from both sides: with the lower
edges of the cells it is one product of matrices, and what the widths can add is one number per
query and block. A candidate whose upper bound is below the kth best lower bound, first of the
blocks of its task and then of all blocks, is out. Exact vectors are then read in descending order of the upper
bound, a few ranks at a time, until the kth result is at least the best bound that is left.

Blocks of queries are repeated over chunks of cell blocks (the stated set of queries against all
rows), in a shuffle. A task holds the cells of one chunk, of bounded size, and scans them for one
block of queries after the other; exact vectors are fetched by row number, for the candidates of
that step only.

Defined results: vectors that are null, empty, of another length than the first dimension
count asked for, or that hold null or non-finite components take no part, neither as query nor
as candidate. Scores are integers (components are floor(scale * x)). Ties go to the smaller id.
Rows that share an id with a query count as the query's own row and are left out of its result.
Several rows of one query id ask once, with the smallest vector. Repeated candidate rows are
candidates each. A row without id is left out. Fewer candidates than k give all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gleanery.llm.common import beside, meeting, picked, written

BLOCK_ROWS = 4096
QUERY_ROWS = 512
CELLS = 64
#: Ranks of candidates read in the first step, as a multiple of k; every step takes so many times more.
FIRST_STEP = 2
MORE = 4
#: Candidates of one block of queries that a task holds before it hands them on.
HELD = 1 << 20


def _parts(batch: pa.RecordBatch, column: int, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, matrix) of at most `size` vectors of one length."""
    vectors = batch.column(column)
    lengths = np.diff(vectors.offsets.to_numpy())
    flat = vectors.values.to_numpy(zero_copy_only=False)
    starts = vectors.offsets.to_numpy()[:-1]
    for dim in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == dim)
        for i in range(0, len(rows), size):
            part = rows[i : i + size]
            yield dim, part, flat[starts[part][:, None] + np.arange(dim)]


def _bytes(values: np.ndarray) -> bytes:
    return values.astype("<i8").tobytes()


def quantise(matrix: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cell numbers, and the lowest value and the width of the cells, by dimension."""
    low, high = matrix.min(0), matrix.max(0)
    width = np.maximum(1, -(-(high - low + 1) // cells))
    return ((matrix - low) // width).astype(np.uint8), low, width


def _approximations(size: int, cells: int):
    """Rows (row, id, v) as blocks of cells."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for dim, part, matrix in _parts(batch, 2, size):
                codes, low, width = quantise(matrix, cells)
                fields = [_bytes(numbers[part]), _bytes(ids[part]), codes.tobytes(), _bytes(low), _bytes(width)]
                yield pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), *(pa.array([f]) for f in fields)], ["dim", "rows", "ids", "cells", "low", "width"])

    return pack


def _queries(size: int):
    """Rows (id, v) as blocks of queries."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for dim, part, matrix in _parts(batch, 1, size):
                fields = [pa.array([dim], pa.int32()), pa.array([_bytes(ids[part])]), pa.array([_bytes(matrix)])]
                yield pa.RecordBatch.from_arrays(fields, ["dim", "ids", "cells"])

    return pack


def _edges(queries: np.ndarray, codes: np.ndarray, low: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inner products with the lower edges of the cells, a row per query, and what at least and at most comes on top.

    float64 holds these integers exactly below 2**53; larger ones are widened by a safe margin.
    """
    q, step = queries.astype(np.float64), width.astype(np.float64)
    edge = (q * step) @ codes.T.astype(np.float64)
    edge += (q @ low.astype(np.float64))[:, None]
    scale = np.abs(q * step) @ np.full(len(step), 255.0) + np.abs(q) @ np.abs(low.astype(np.float64))
    margin = np.where(scale < 2.0**52, 0.0, scale * 1e-12)
    return edge, np.minimum(q, 0) @ (step - 1) - margin, np.maximum(q, 0) @ (step - 1) + margin


def bounds(queries: np.ndarray, codes: np.ndarray, low: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the inner products, a row per query."""
    edge, below, above = _edges(queries, codes, low, width)
    return edge + below[:, None], edge + above[:, None]


CANDIDATE = "query_id long, row long, id long, least double, most double"


class Candidates:
    """What can be among the k best of the blocks seen so far, for one block of queries."""

    def __init__(self, asked: np.ndarray, k: int) -> None:
        self.asked, self.k = asked, k
        self.best = np.full((len(asked), k), -np.inf)  # lower bounds, descending
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, rows: np.ndarray, ids: np.ndarray, edge: np.ndarray, below: np.ndarray, above: np.ndarray) -> None:
        own = np.flatnonzero(np.isin(ids, self.asked))
        edge[:, own] = np.where(ids[own] == self.asked[:, None], -np.inf, edge[:, own])
        kth = self.best[:, -1]
        if len(rows) > self.k and np.isneginf(kth).any():
            kth = np.maximum(kth, np.partition(edge, len(rows) - self.k, axis=1)[:, len(rows) - self.k] + below)
        # The lowest finite number keeps the query's own rows out where nothing else does.
        q, at = np.nonzero(edge >= np.maximum(kth - above, np.finfo(np.float64).min)[:, None])
        found = edge[q, at]
        least, most = found + below[q], found + above[q]
        order = np.lexsort((-least, q))
        place = np.arange(len(q)) - np.searchsorted(q, q)
        some = place < self.k
        fresh = np.full(self.best.shape, -np.inf)
        fresh[q[some], place[some]] = least[order][some]
        self.best = -np.sort(-np.concatenate([self.best, fresh], 1), 1)[:, : self.k]
        self.parts.append(self._left(q, rows[at], ids[at], least, most))
        self.size += len(self.parts[-1][0])

    def _left(self, q: np.ndarray, *rest: np.ndarray) -> tuple[np.ndarray, ...]:
        good = rest[-1] >= self.best[q, -1]
        return tuple(x[good] for x in (q, *rest))

    def full(self) -> bool:
        """Whether so many are left that they are handed on before the last block."""
        if self.size > HELD and self.parts:
            self.parts = [self._left(*(np.concatenate(x) for x in zip(*self.parts, strict=True)))]
            self.size = len(self.parts[0][0])
        return self.size > HELD

    def taken(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            q, *rest = self._left(*(np.concatenate(x) for x in zip(*self.parts, strict=True)))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (self.asked[q], *rest)], ["query_id", "row", "id", "least", "most"])
        self.parts, self.size = [], 0


def _scan(k: int):
    """Candidates that can be among the k best of their task's blocks, from the cells alone."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = lambda row, c: np.frombuffer(row[c], "<i8")
        for tile, blocks in beside(batches):
            queries = read(tile, "cells").reshape(-1, tile["dim"])
            held = Candidates(read(tile, "ids"), k)
            for block in blocks:
                codes = np.frombuffer(block["cells"], np.uint8).reshape(-1, tile["dim"])
                held.add(read(block, "rows"), read(block, "ids"), *_edges(queries, codes, read(block, "low"), read(block, "width")))
                if held.full():
                    yield from held.taken()
            yield from held.taken()

    return scan


def integers(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component; null where a component is null or not finite."""
    x = F.transform(vector, lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    whole = F.transform(x, lambda v: F.floor(v * F.lit(scale)).cast("long"))
    return F.when(vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & (F.size(vector) > 0), whole)


def _kth(rows: DataFrame, column: str, k: int) -> DataFrame:
    """(query_id, kth): the kth highest value of each query that has so many."""
    at = Window.partitionBy("query_id").orderBy(F.desc(column))
    best = rows.select("query_id", column).withColumn("at", F.row_number().over(at)).where(F.col("at") <= k)
    return best.where(F.col("at") == k).select("query_id", F.col(column).alias("kth"))


def _survivors(met: DataFrame, k: int) -> DataFrame:
    """Candidates of all blocks by rank of their upper bound."""
    scanned = written(met.mapInArrow(_scan(k), CANDIDATE))
    left = scanned.join(_kth(scanned, "least", k), "query_id", "left").where("kth IS NULL OR most >= kth")
    by_bound = Window.partitionBy("query_id").orderBy(F.desc("most"), "id", "row")
    return written(left.select("query_id", "row", "id", "most", F.row_number().over(by_bound).alias("rank")))


def _read_in_order(survivors: DataFrame, rows: DataFrame, asked: DataFrame, k: int) -> tuple[DataFrame, int]:
    """Exact scores of candidates, in steps until the kth result is certain, and the number of vectors read."""
    vectors, queries = rows.select("row", "v"), asked.select(F.col("id").alias("query_id"), F.col("v").alias("q"))
    product = F.aggregate(F.zip_with("q", "v", lambda a, b: a * b), F.lit(0).cast("long"), lambda a, x: a + x)
    done, read, last, step = None, 0, 0, FIRST_STEP * k
    open_ = survivors
    while True:
        now = open_.where((F.col("rank") > last) & (F.col("rank") <= step))
        scored = written(now.join(vectors, "row").join(queries, "query_id").select("query_id", F.col("id").alias("vec_id"), product.alias("score")))
        read += scored.count()
        done = scored if done is None else done.unionByName(scored)
        left = open_.where(F.col("rank") > step).join(_kth(done, "score", k), "query_id", "left")
        open_ = written(left.where("kth IS NULL OR most >= kth").select(survivors.columns))
        if open_.isEmpty():
            return done, read
        last, step = step, step * MORE


def top_k(
    df: DataFrame,
    k: int = 5,
    every: int = 50,
    scale: int = 256,
    key: str = "vec_id",
    vector: str = "embedding",
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
    cells: int = CELLS,
) -> DataFrame:
    """The k highest integer inner products of every query row (id divisible by `every`)."""
    rows = picked(df, id=key, v=vector).select(F.col("id").cast("long"), integers(F.col("v"), scale).alias("v"))
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull())
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()))
    asked = written(rows.where(F.col("id") % every == 0).groupBy("id").agg(F.min("v").alias("v")))
    layout = "dim int, rows binary, ids binary, cells binary, low binary, width binary"
    blocks = written(rows.select("row", "id", "v").mapInArrow(_approximations(block_rows, cells), layout))
    queries = written(asked.mapInArrow(_queries(query_rows), "dim int, ids binary, cells binary"))
    survivors = _survivors(meeting(blocks, queries, "cells"), k)
    found, _ = _read_in_order(survivors, rows, asked, k)
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
