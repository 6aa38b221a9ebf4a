"""Benchmark decontamination with a broadcast hash set of benchmark word windows.

Words are runs of ASCII letters and digits and of all non-ASCII characters, A-Z lower-cased.
Every run of `n` words of a benchmark item is a window; an item of fewer words is one window.
Tasks scan the token windows of each document: only stretches of words that the benchmark
knows are hashed, hashes are probed in the sorted set, and a hash that is found is verified
word by word. Hit words can be reported, cut out of the text, or cost the whole document.

The set is broadcast in blocks of at most `BLOCK_WINDOWS` windows; a larger benchmark takes
several passes over the documents, each with one block, so no task ever holds more than one.

Defined results: null and empty texts have no words; an empty benchmark hits nothing; items
without words have no window; items without an id hit words but are not listed; repeated items
count once. Documents are read whole, and repeated documents each give their row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import free, picked, written

#: Windows of one broadcast; a window weighs some 300 bytes.
BLOCK_WINDOWS = 200_000
_ODD = np.uint64(0x9E3779B97F4A7C15)
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: str | bytes | None) -> list[bytes]:
    """The words of a text as UTF-8 bytes, A-Z lower-cased."""
    if not text:
        return []
    raw = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text
    return raw.translate(_WORD_BYTES).split()


class Windows:
    """The windows of some benchmark items: by length, hashed and sorted, with their words and items."""

    def __init__(self, items: list[tuple[str | None, str | None]], n: int) -> None:
        self.ids: dict[bytes, int] = {}
        self.exact: dict[tuple[int, ...], set[str | None]] = {}
        for item, text in items:
            known = [self.ids.setdefault(w, len(self.ids) + 1) for w in words(text)]
            size = min(n, len(known))
            for i in range(len(known) - size + 1 if size else 0):
                self.exact.setdefault(tuple(known[i : i + size]), set()).add(item)
        self.hashes: dict[int, np.ndarray] = {}
        for size in {len(w) for w in self.exact}:
            keys = np.array([w for w in self.exact if len(w) == size], np.uint64)
            self.hashes[size] = np.unique(_rolled(keys.ravel(), np.arange(len(keys)) * size, size))

    def scan(self, tokens: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Which words lie inside a window, and the items whose windows occur."""
        get = self.ids.get
        known = np.fromiter((get(w, 0) for w in tokens), np.uint64, len(tokens))
        hit = np.zeros(len(tokens) + 1, np.int64)
        found: set[str | None] = set()
        blank = np.concatenate([[0], np.cumsum(known == 0)])
        for size, hashes in self.hashes.items():
            starts = np.flatnonzero(blank[size:] == blank[:-size])
            if not len(starts):
                continue
            rolled = _rolled(known, starts, size)
            at = np.searchsorted(hashes, rolled)
            at[at == len(hashes)] = 0
            for i in starts[hashes[at] == rolled].tolist():
                items = self.exact.get(tuple(known[i : i + size].tolist()))
                if items is not None:
                    found |= items
                    hit[i] += 1
                    hit[i + size] -= 1
        return np.cumsum(hit[:-1]) > 0, {x for x in found if x is not None}


def _rolled(ids: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of the `size` word numbers from each start."""
    out = np.zeros(len(starts), np.uint64)
    for j in range(size):
        out = (out ^ ids[starts + j]) * _ODD
        out ^= out >> np.uint64(29)
    return out


def _runs(hit: np.ndarray) -> list[dict]:
    """Stretches of hit words as (first word, word after the last)."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return [{"start": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)]


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _pass(block, n: int):
    """Add what one block of windows finds to what earlier passes found."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(block.value, n)
        for batch in batches:
            names = batch.schema.names
            counts, spans, items = [], [], []
            for text, spans0, items0 in zip(batch["_text"], batch["_spans"], batch["_items"], strict=True):
                tokens = words(text.as_py())
                hit, found = windows.scan(tokens)
                for s in spans0.as_py():
                    hit[s["start"] : s["end"]] = True
                counts.append(len(tokens))
                spans.append(_runs(hit))
                items.append(sorted(found | set(items0.as_py())))
            done = {"_n_words": pa.array(counts, pa.int64()), "_spans": pa.array(spans, _SPANS), "_items": pa.array(items, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays([done.get(c, batch[c]) for c in names], names)

    return scan


def _found(docs: DataFrame, benchmark: DataFrame, text: str, n: int, item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """The given row as `_given`, `_n_words`, `_spans` (hit words) and `_items` (items that occur)."""
    items = picked(benchmark, item=item_key, body=item_text).select(F.col("item").cast("string"), "body").where(F.col("body").isNotNull()).distinct()
    windows = items.agg(F.coalesce(F.sum(F.octet_length("body")), F.lit(0))).first()[0] // 2
    blocks = max(1, -(-windows // BLOCK_WINDOWS))
    spark = docs.sparkSession
    out = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_given"),
        F.col(f"`{text}`").alias("_text"),
        F.lit(0).cast("long").alias("_n_words"),
        F.array().cast("array<struct<start:bigint,end:bigint>>").alias("_spans"),
        F.array().cast("array<string>").alias("_items"),
    )
    for b in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item", "body"), F.lit(blocks)) == b)
        block = spark.sparkContext.broadcast([(r["item"], r["body"]) for r in part.collect()])
        out = out.mapInArrow(_pass(block, n), out.schema)
        if b + 1 < blocks:
            out = written(out)
    return out.drop("_text")


def find_windows(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text", n: int = 10) -> DataFrame:
    """The documents with `_n_words`, `_spans` (hit words) and `_items` (items that occur).

    These take the place of given columns of their names.
    """
    own = ["_n_words", "_spans", "_items"]
    kept = [F.col("_given")[c].alias(c) for c in docs.columns if c.lower() not in own]
    return _found(docs, benchmark, text, n, item_key, item_text).select(*kept, *own)


def _digest(items: Column) -> Column:
    return F.sha2(F.array_join(F.array_sort(items), ","), 256)


def report(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", n: int = 10) -> DataFrame:
    """One row per document: words, hit words, items that occur."""
    found = find_windows(picked(docs, doc_id=key, text=text), benchmark, n=n)
    hit = F.aggregate("_spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.select(
        "doc_id",
        F.col("_n_words").alias("n_words"),
        hit.alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        _digest(F.col("_items")).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def remove_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text", n: int = 10, share: float = 0.0) -> DataFrame:
    """Keep the documents of whose words at most `share` are hit; columns as given."""
    found = _found(docs, benchmark, text, n)
    hit = F.aggregate("_spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.where(hit <= F.col("_n_words") * share).select(*[F.col("_given")[c].alias(c) for c in docs.columns])


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", n: int = 10) -> DataFrame:
    """Cut the hit words out of the texts, with what stands between them; columns as given."""
    columns, spans = docs.columns, free(docs, "_spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [_without(t.as_py(), s.as_py()) for t, s in zip(batch[text], batch[spans], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if c == text else batch[c] for c in columns], columns)

    given = [F.col("_given")[c].alias(c) for c in columns]
    return _found(docs, benchmark, text, n).select(*given, F.col("_spans").alias(spans)).mapInArrow(cut, docs.schema)


def _without(text: str | None, spans: list[dict]) -> str | None:
    if not text or not spans:
        return text
    raw = text.encode("utf-8", "surrogatepass")
    flags = np.frombuffer(raw.translate(_WORD_BYTES), np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))).reshape(-1, 2)
    out, at = [], 0
    for s in spans:
        out.append(raw[at : edges[s["start"]][0]])
        at = int(edges[s["end"] - 1][1])
    return b"".join([*out, raw[at:]]).decode("utf-8", "surrogatepass")
