"""N-gram Jaccard join: a size-aware heavy-light join on word shingles.

A document's set is its distinct word shingles (hashed to 64 bits); documents with the same set form
a class, and only classes are joined. Two sets of a size from s to t can reach the threshold only
if they share nearly all their elements, so the first few elements of each, in one order for
all sets, must meet:

* Light sets are small. All fixed-size subsets (pairs) of a slightly longer prefix are
  enumerated; sets that link share a subset.
* Heavy sets are large, where subsets would be too many. Their prefix elements go to inverted
  lists, which are scanned. Light sets close to the boundary are listed as well.

The boundary is the size with the least cost, from the counts of sets by size and the mean
length of a list. The order puts rare elements first: elements that occur often in the corpus
(exactly counted) come last, by their count, so that passages shared by many documents do not
make long lists.

Lists can still be long where documents are near copies of each other. In long lists every member
is first tried with the nearest member of another component, in a few rounds, and components are
formed; then every list is searched for pairs from different components, in blocks, with the sizes
and parity bitmaps of the sets as exact filters (the bits that differ are at most the elements that
differ). Members of a block for which a pair is left come again with their whole sets, and the pairs
are verified inside the block. A pair within one component, or within what the block has linked
so far, needs no test, since it cannot change the components; so no list is expanded into
all pairs, a block gives a spanning forest of its members, and no link between components is lost.

Defined results: null texts and texts without words have an empty set, are linked with nothing and
are components of their own; copies of a text or a document are in one component; a null
key counts as no number, so a component of null keys only has a null number. Two different
sets are taken for one with a chance of n^2 / 2^65 for n classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from gleanery.llm.common import free, picked, written
from gleanery.llm.components import components

#: An element counted so often in prefixes is put last; so many of them at most, the most frequent.
OFTEN = 30
OFTEN_KEPT = 1 << 20
#: Largest size that can be light.
LIGHT_MAX = 512
#: In lists from this length on members are first linked with their nearest, in so many rounds.
LONG_LIST = 16
NEAREST_ROUNDS = 3
#: Keys before that of a list which its members carry.
EARLIER = 6
#: Members of a list that one task compares with as many others.
BLOCK = 1024
#: Texts fetched by a broadcast of their hashes; more are fetched by a shuffle.
FETCH_ROWS = 500_000

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_COUNTED_BITS = np.uint64(24)  # frequencies are kept by the upper 40 bits


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _B
    return h ^ (h >> np.uint64(29))


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of `width` words; of all words, if there are fewer."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    h = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
    size = min(width, len(h))
    out = np.full(len(h) - size + 1, size, np.uint64)
    for i in range(size):
        out = _mixed((out ^ h[i : len(h) - size + 1 + i]) * _A + _C)
    return np.unique(out)


class Threshold:
    """Jaccard similarity of at least `percent` / 100, in whole numbers."""

    def __init__(self, percent: int) -> None:
        self.percent = percent

    def prefix(self, size: int, shared: int) -> int:
        """Elements of which sets that link share `shared` at least."""
        return size - -(-self.percent * size // 100) + shared

    def smallest(self) -> int:
        """Sets below this size link with equal sets only."""
        p = self.percent
        return 1 if p == 100 else -(-p // (100 - p))

    def single(self, size: int) -> bool:
        """Whether a set of this size can link with one that has a single element in common."""
        return self.percent * (size + max(1, -(-self.percent * size // 100))) <= 100 + self.percent

    def sizes(self, a, b):
        return (100 * a >= self.percent * b) & (100 * b >= self.percent * a)

    def differ(self, a: int, b: int) -> int:
        """Elements that two sets of these sizes may differ in."""
        return (100 - self.percent) * (a + b) // (100 + self.percent)

    def linked(self, a: np.ndarray, b: np.ndarray) -> bool:
        common = len(np.intersect1d(a, b, assume_unique=True))
        return 100 * common >= self.percent * (len(a) + len(b) - common)


def _bitmap(elements: np.ndarray) -> bytes:
    """Parity bitmap of about half a bit per element, of a power of two of bits."""
    bits = 128
    while 2 * bits < len(elements) and bits < 8192:
        bits *= 2
    odd = np.bincount((elements & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _folded(bitmap: bytes, size: int) -> int:
    """The bitmap as a number, folded to `size` bytes."""
    while len(bitmap) > size:
        half = len(bitmap) // 2
        bitmap = (int.from_bytes(bitmap[:half], "big") ^ int.from_bytes(bitmap[half:], "big")).to_bytes(half, "big")
    return int.from_bytes(bitmap, "big")


def _apart(a: bytes, b: bytes) -> int:
    size = min(len(a), len(b))
    return (_folded(a, size) ^ _folded(b, size)).bit_count()


def _signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64).view(np.int64)


def _prefix_elements(rows: DataFrame, width: int, limit: Threshold) -> DataFrame:
    """Per text the upper bits of the elements that can come into its prefix.

    The size of a set that could be light goes along as a negative number.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column(0):
                own = shingles(text.as_py(), width)
                if len(own) >= limit.smallest():
                    found.append(_signed(own[: 2 * limit.prefix(len(own), 1) + 8] >> _COUNTED_BITS))
                    found.append(np.full(int(len(own) <= LIGHT_MAX), -len(own)))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*found, np.empty(0, np.int64)]))], ["e"])

    return rows.select("text").mapInArrow(run, "e long")


def _sets(rows: DataFrame, width: int, limit: Threshold, often: tuple[bytes, bytes], light: int) -> DataFrame:
    """Per document its class (node), size, keys of its lists and subsets, and bitmap."""
    shared = rows.sparkSession.sparkContext.broadcast(often)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, counts = np.frombuffer(shared.value[0], np.uint64), np.frombuffer(shared.value[1], np.int64)
        for batch in batches:
            nodes, sizes, keys, bitmaps = [], [], [], []
            for text in batch.column(1):
                own = shingles(text.as_py(), width)
                sizes.append(len(own))
                nodes.append(xxhash.xxh3_64_intdigest(own.tobytes()) if len(own) else 0)
                wanted = len(own) >= limit.smallest()
                keys.append(_keys(own, limit, frequent, counts, light) if wanted else own[:0])
                bitmaps.append(_bitmap(own) if wanted else b"")
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, keys)]), pa.int32()), pa.array(_signed(np.concatenate([*keys, np.empty(0, np.uint64)]))))
            columns = [batch.column(0), batch.column(2), pa.array(_signed(np.array(nodes, np.uint64))), pa.array(sizes, pa.int64()), lists, pa.array(bitmaps)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "node", "size", "keys", "bitmap"])

    key = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {key}, text_hash long, node long, size long, keys array<long>, bitmap binary"
    return rows.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(run, schema)


def _keys(own: np.ndarray, limit: Threshold, frequent: np.ndarray, counts: np.ndarray, light: int) -> np.ndarray:
    order = own
    if len(frequent):
        at = np.searchsorted(frequent, own >> _COUNTED_BITS)
        at[at == len(frequent)] = 0
        often = np.where(frequent[at] == own >> _COUNTED_BITS, counts[at], 0)
        order = own[np.lexsort((own, often))]
    keys = []
    if len(own) <= light:
        prefix = order[: limit.prefix(len(own), 2)]
        i, j = np.triu_indices(len(prefix), 1)
        keys.append(_mixed(np.minimum(prefix[i], prefix[j]) * _A ^ _mixed(np.maximum(prefix[i], prefix[j]) * _C)))
    if 100 * len(own) >= limit.percent * (light + 1) or limit.single(len(own)):
        keys.append(order[: limit.prefix(len(own), 1)])
    return np.unique(np.concatenate(keys))


def _boundary(sizes: list[tuple[int, int]], mean_list: float, limit: Threshold) -> int:
    """Size up to which subsets cost less than lists; sizes above LIGHT_MAX are always heavy."""
    best, cost = limit.smallest() - 1, 0.0
    least = 0.0
    for size, n in sorted(sizes):
        if limit.smallest() <= size <= LIGHT_MAX:
            pairs = limit.prefix(size, 2) * (limit.prefix(size, 2) - 1) / 2
            cost += n * (pairs - limit.prefix(size, 1) * mean_list)
            if cost < least:
                best, least = size, cost
    return best


class _List:
    """Members of one list (or of two blocks of one), by size; compares bitmaps."""

    def __init__(self, limit: Threshold, nodes: list, sizes: list, labels: list, blocks: list, own: bool, bitmaps: list, earlier: list) -> None:
        order = sorted(range(len(nodes)), key=sizes.__getitem__)
        take = lambda column: [column[k] for k in order]
        self.limit, self.own = limit, own
        self.nodes, self.sizes, self.labels, self.blocks, self.bitmaps = map(take, (nodes, sizes, labels, blocks, bitmaps))
        self.earlier = [frozenset(e) for e in take(earlier)]

    def near(self) -> Iterator[tuple[int, int, int]]:
        """(differing bits, place, place) of members that can link and are in different components."""
        return self._by_rows() if len(self.nodes) >= 24 else self._by_pairs()

    def _by_pairs(self) -> Iterator[tuple[int, int, int]]:
        for i, size in enumerate(self.sizes):
            for j in range(i + 1, len(self.sizes)):
                if 100 * size < self.limit.percent * self.sizes[j]:
                    break
                if self.labels[i] != self.labels[j] and (self.own or self.blocks[i] != self.blocks[j]):
                    if not self.earlier[i].isdisjoint(self.earlier[j]):
                        continue
                    apart = _apart(self.bitmaps[i], self.bitmaps[j])
                    if apart <= self.limit.differ(size, self.sizes[j]):
                        yield apart, i, j

    def _by_rows(self) -> Iterator[tuple[int, int, int]]:
        sizes, labels, blocks = (np.array(x) for x in (self.sizes, self.labels, self.blocks))
        ends = np.searchsorted(sizes, 100 * sizes // self.limit.percent, "right")
        folded: dict[int, np.ndarray] = {}
        for i, own in enumerate(self.bitmaps):
            if len(own) not in folded:  # larger sets never have smaller bitmaps
                rest = [_folded(b, len(own)).to_bytes(len(own), "big") for b in self.bitmaps[i:]]
                folded[len(own)] = np.frombuffer(b"".join([bytes(len(own))] * i + rest), np.uint64).reshape(len(self.bitmaps), -1)
            bits, others = folded[len(own)], slice(i + 1, ends[i])
            apart = np.bitwise_count(bits[others] ^ bits[i]).sum(1, dtype=np.int64)
            good = (labels[others] != labels[i]) & (apart <= self.limit.differ(sizes[i], sizes[others]))
            if not self.own:
                good &= blocks[others] != blocks[i]
            for k in np.flatnonzero(good).tolist():
                if self.earlier[i].isdisjoint(self.earlier[i + 1 + k]):
                    yield int(apart[k]), i, i + 1 + k

    def nearest(self) -> set[tuple[int, int]]:
        """For each member the pair of nodes with the nearest of another component."""
        best: dict[int, tuple[int, int, int]] = {}
        for pair in self.near():
            for k in pair[1:]:
                if k not in best or pair < best[k]:
                    best[k] = pair
        return {(min(self.nodes[i], self.nodes[j]), max(self.nodes[i], self.nodes[j])) for _, i, j in best.values()}


    def involved(self) -> set[int]:
        """Nodes of members that can link with one of another component."""
        return {self.nodes[k] for _, *pair in self.near() for k in pair}

    def forest(self, sets: dict[int, np.ndarray]) -> Iterator[tuple[int, int]]:
        """Linked pairs of nodes that connect all components whose members link here."""
        above: dict[int, int] = {}

        def root(label: int) -> int:
            while label in above:
                label = above[label]
            return label

        for _, i, j in self.near():
            x, y = root(self.labels[i]), root(self.labels[j])
            if x != y and self.limit.linked(sets[self.nodes[i]], sets[self.nodes[j]]):
                above[max(x, y)] = min(x, y)
                yield self.nodes[i], self.nodes[j]


#: Columns of a member of a list or of a pair of its blocks.
MEMBER = "key long, i int, j int, node long, size long, label long, block int, own boolean, bitmap binary, earlier array<long>"


def _by_list(found, joined):
    """Give every list to `found` as a table, with its members; a list may go over several batches.

    `joined` makes a batch of the results of several lists.
    """

    def whole(rows: pa.Table) -> list:
        at = np.concatenate([[0], _edges(rows), [rows.num_rows]])
        labels = rows["label"].to_numpy()
        out = []
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            if b - a > 1 and (labels[a:b] != labels[a]).any():
                out.append(found(rows.slice(a, b - a)))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = (rows if tail is None else pa.concat_tables([tail, rows])).combine_chunks()
            edges = _edges(rows)
            last = int(edges[-1]) if len(edges) else 0
            tail = rows.slice(last)
            yield from joined(whole(rows.slice(0, last)))
        if tail is not None:
            yield from joined(whole(tail.combine_chunks()))

    return run


def _members(limit: Threshold, rows: pa.Table) -> _List:
    node, size, label, block, own, bitmap, earlier = (rows[c].to_pylist() for c in ("node", "size", "label", "block", "own", "bitmap", "earlier"))
    return _List(limit, node, size, label, block, own[0], bitmap, earlier)


def _nearest(limit: Threshold):
    """The nearest of another component for every member."""
    return _by_list(lambda rows: _members(limit, rows).nearest(), lambda found: [_pairs(set().union(*found))])


def _involved(limit: Threshold):
    """The members for which a pair has to be verified."""

    def found(rows: pa.Table) -> pa.Table:
        some = _members(limit, rows).involved()
        return rows.filter(pa.array([n in some for n in rows["node"].to_pylist()], pa.bool_()))

    return _by_list(found, lambda tables: pa.concat_tables(tables).combine_chunks().to_batches() if tables else [])


def _forests(limit: Threshold):
    """Links between the components of a list, verified on whole sets."""

    def found(rows: pa.Table) -> set[tuple[int, int]]:
        sets = {n: np.frombuffer(e, np.uint64) for n, e in zip(rows["node"].to_pylist(), rows["elements"].to_pylist(), strict=True)}
        return {(min(p), max(p)) for p in _members(limit, rows).forest(sets)}

    return _by_list(found, lambda found: [_pairs(set().union(*found))])


def _edges(rows: pa.Table) -> np.ndarray:
    """Where another list begins."""
    key, i, j = (rows[c].to_numpy() for c in ("key", "i", "j"))
    return 1 + np.flatnonzero((np.diff(key) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0))


def _pairs(found: set[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[i] for p in found], pa.int64()) for i in range(2)], ["a", "b"])


class Join:
    """The join over one corpus; tables that several steps read are written once."""

    def __init__(self, docs: DataFrame, key: str, text: str, width: int, percent: int) -> None:
        self.rows = picked(docs, doc_id=key, text=text)
        self.width, self.limit = width, Threshold(percent)
        often, mean_list, sizes = self._frequencies()
        self.light = _boundary(sizes, mean_list, self.limit)
        self.sets = written(_sets(self.rows, width, self.limit, often, self.light))
        some = self.sets.where(F.size("keys") > 0)
        first = some.groupBy("node").agg(*[F.first(c).alias(c) for c in ("size", "keys", "bitmap", "text_hash")])
        self.classes = written(first)

    def _frequencies(self) -> tuple[tuple[bytes, bytes], float, list[tuple[int, int]]]:
        """Frequent elements with their counts, mean length of the other lists, sets by size."""
        elements = _prefix_elements(self.rows, self.width, self.limit)
        counts = elements.groupBy("e").agg(F.count("*").alias("n"))
        rare = (F.col("e") >= 0) & (F.col("n") < OFTEN)
        seen = Observation()
        counts = counts.observe(seen, F.sum(F.when(rare, F.col("n"))).alias("n"), F.sum(F.when(rare, F.col("n") * F.col("n"))).alias("nn"))
        kept = written(counts.where((F.col("n") >= OFTEN) | (F.col("e") < 0)))
        often = kept.where("e >= 0").orderBy(F.desc("n"), "e").limit(OFTEN_KEPT).toArrow()
        e, n = (often.column(i).to_numpy() for i in range(2))
        order = np.argsort(e)
        sizes = [(-r["e"], r["n"]) for r in kept.where("e < 0").collect()]
        mean = (seen.get["nn"] or 0) / (seen.get["n"] or 1)
        return (e[order].astype(np.uint64).tobytes(), n[order].astype(np.int64).tobytes()), mean, sizes

    def lists(self) -> DataFrame:
        """(key, node, size, n, earlier) of all lists of two classes or more.

        `earlier` has the last keys before this one, in the order of the class's keys. Members
        that have one of those in common meet in its list too, so they need not be compared
        in this one: going back from list to list, there is one where they are.
        """
        entries = self.classes.select(F.posexplode("keys").alias("place", "key"), "node", "size")
        counts = entries.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
        shared = entries.join(counts, "key").join(self.classes.select("node", "keys"), "node")
        earlier = F.slice("keys", F.greatest(F.col("place") - EARLIER + 1, F.lit(1)), F.least(F.col("place"), F.lit(EARLIER)))
        return written(shared.select("key", "node", "size", "n", earlier.alias("earlier")))

    def _elements(self, nodes: DataFrame) -> DataFrame:
        """(node, elements) of the classes: their whole sets, from one of their texts."""
        wanted = written(nodes.distinct().join(self.classes.select("node", "text_hash"), "node"))
        side = F.broadcast(wanted) if wanted.count() <= FETCH_ROWS else wanted
        rows = self.rows.select("text", F.xxhash64("text").alias("text_hash")).join(side, "text_hash")
        width = self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own = [shingles(t.as_py(), width).tobytes() for t in batch["text"]]
                yield pa.RecordBatch.from_arrays([batch["node"], pa.array(own, pa.binary())], ["node", "elements"])

        texts = rows.groupBy("node").agg(F.min("text").alias("text"))
        return written(texts.select("node", "text").mapInArrow(run, "node long, elements binary"))

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs of classes that reach the threshold."""
        pairs = written(pairs)
        sets, limit = self._elements(pairs.select(F.explode(F.array("a", "b")).alias("node"))), self.limit
        first = sets.select(F.col("node").alias("a"), F.col("elements").alias("left"))
        second = sets.select(F.col("node").alias("b"), F.col("elements").alias("right"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sides = (batch[c].to_pylist() for c in ("left", "right"))
                good = [limit.linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(*sides, strict=True)]
                yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

        return written(pairs.join(first, "a").join(second, "b").mapInArrow(run, "a long, b long"))

    def labels(self) -> DataFrame:
        """(node, label) of all classes that are linked with another."""
        lists = self.lists()
        long = lists.where(F.col("n") >= LONG_LIST)
        links = labels = None
        if not long.isEmpty():
            for _ in range(NEAREST_ROUNDS):
                near = self._ordered(self._spread(_labelled(long, labels))).mapInArrow(_nearest(self.limit), "a long, b long")
                found = self.verified(near.distinct())
                links = found if links is None else links.unionByName(found)
                labels = written(components(links))
        found = self._between(_labelled(lists, labels))
        return written(components(found if links is None else links.unionByName(found)))

    def _between(self, labelled: DataFrame) -> DataFrame:
        """Links that connect all components: of every list (or pair of its blocks) a spanning forest."""
        members = written(self._ordered(self._spread(labelled)).mapInArrow(_involved(self.limit), MEMBER))
        sets = self._elements(members.select("node"))
        whole = self._ordered(members.join(sets, "node"))
        return written(whole.mapInArrow(_forests(self.limit), "a long, b long").distinct())

    def _spread(self, labelled: DataFrame) -> DataFrame:
        """Members of lists; long lists in pairs of blocks."""
        blocks = F.ceil(F.col("n") / BLOCK).cast("int")
        spread = labelled.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        spread = spread.select("key", "node", "size", "label", "earlier", "block", other.alias("other"))
        spread = spread.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
        spread = spread.withColumn("own", F.col("i") == F.col("j")).join(self.classes.select("node", "bitmap"), "node")
        return spread.select("key", "i", "j", "node", "size", "label", "block", "own", "bitmap", "earlier")

    @staticmethod
    def _ordered(members: DataFrame) -> DataFrame:
        return members.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def members(self) -> DataFrame:
        """(doc_id, size, node, label) of all documents; the label is null without words."""
        labels = self.labels()
        rows = self.sets.select("doc_id", "size", "node")
        return rows.join(labels, "node", "left").withColumn("label", F.when(F.col("size") > 0, F.coalesce("label", "node")))


def _labelled(lists: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return lists.withColumn("label", F.col("node"))
    return lists.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def link_components(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3, percent: int = 90) -> DataFrame:
    """One row per document: size of its set, and the smallest key in its component."""
    rows = written(Join(docs, key, text, width, percent).members())
    least = rows.where(F.col("size") > 0).groupBy("label").agg(F.min("doc_id").alias("least"))
    linked = rows.where(F.col("size") > 0).join(least, "label").select("doc_id", F.col("size").alias("n_shingles"), F.col("least").alias("component_id"))
    alone = rows.where(F.col("size") == 0).select("doc_id", F.col("size").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)


#: Rows to be dropped that are broadcast; more are dropped by a shuffle.
DROP_ROWS = 200_000


def _placed(docs: DataFrame, name: str) -> DataFrame:
    """The rows with a place that every plan sees alike.

    Rows read from Parquet have one, their file and position; other rows are written once.
    """
    try:
        return docs.withColumn(name, F.struct("_metadata.file_path", "_metadata.row_index"))
    except AnalysisException:
        return written(docs.withColumn(name, F.monotonically_increasing_id()))


def keep_one(docs: DataFrame, text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, the first in the order of files and rows; columns as given."""
    place = free(docs, "_place")
    placed = _placed(docs, place)
    rows = link_components(placed, place, text, width, percent)
    drop = written(rows.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias(place)))
    side = F.broadcast(drop) if drop.count() <= DROP_ROWS else drop
    return placed.join(side, place, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
