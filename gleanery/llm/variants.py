"""Spelling variant grouping: words one edit apart, by sorted lists and banded edit rows.

The words of a corpus are counted once. Two words one edit apart are equal but for one place, so
they share the first or the last half of what the shorter one has: words that do so form a block,
and only within a block are words compared. A block of more than `block_words` is divided again
by the halves of what its words do not share yet; it ends where they differ in two characters at
most, so a block is bounded by `block_words` or by the alphabet. The path that a pair takes is known
from its common prefix, so each pair counts in one block only.

A block is a sorted list. For each word of the shorter length the list is scanned once: the three
cells of the edit matrix that can be one or less are kept per depth; the rows up to the common
prefix with the next word stay; where all cells exceed one, the whole range of words
with that prefix is skipped.

Defined results: a null text has no words; a null key counts as an empty one in the checksum;
copies and repeated rows count each; long texts are read whole, in parts; an empty table has no
words; extra columns take no part. Of near words with equal counts the smaller by code points is
the form.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import picked, written

#: The letters of a run, behind the lower-casing of A-Z.
LETTERS = "a-zÀ-ÿ"
#: Distinct words that a task counts before it hands them on, and bytes of text taken together.
KEPT_WORDS = 200_000
PART = 1 << 22
BLOCK_WORDS = 128
_BREAK = re.compile(rb"[\x00-\x40\x5b-\x60\x7b-\x7f]")
_LAST = "\U0010ffff"


def _parts(text: bytes) -> Iterator[bytes]:
    """The text, a long one cut before an ASCII character that is no letter."""
    start = 0
    while start < len(text):
        cut = _BREAK.search(text, start + PART)
        end = cut.start() if cut else len(text)
        yield text[start:end]
        start = end


def count_words(docs: DataFrame, key: str, text: str, least_chars: int, drop_every: int | None) -> DataFrame:
    """(word, n) of all words of `least_chars` or more.

    With `drop_every` a run whose checksum with its document's key is a multiple of it loses one
    character, in every place of that document alike.
    """
    runs = re.compile(f"[{LETTERS}]{{{least_chars},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                before = zlib.crc32(f"{doc or ''}:".encode())
                for part in _parts(body.as_py() or b""):
                    for word, n in Counter(runs.findall(part.lower().decode())).items():
                        if drop_every and (check := zlib.crc32(word.encode(), before)) % drop_every == 0:
                            at = check % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < least_chars:
                                continue
                        counts[word] += n
                if len(counts) > KEPT_WORDS:
                    yield _counted(counts)
                    counts.clear()
        yield _counted(counts)

    rows = picked(docs, doc_id=key, text=text).select(F.col("doc_id").cast("string"), "text")
    found = rows.mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def _counted(counts: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])


def _in_blocks(words: DataFrame, spans: Column) -> DataFrame:
    """One row per word and span (a, b): the block of words that share their first a and last b.

    `m` is the shorter length compared in the block, `path` the halves (f first, l last) that led
    to it; `view` the word, read from the end where more of its end is shared.
    """
    rows = words.withColumn("span", F.explode(spans)).select("word", "n", "m", "span.a", "span.b", "span.path")
    size = F.char_length("word")
    shared = [F.substr("word", F.lit(1), F.col("a")), F.substr("word", size - F.col("b") + 1, F.col("b"))]
    view = F.when(F.col("a") >= F.col("b"), F.col("word")).otherwise(F.reverse("word"))
    return rows.withColumn("key", F.concat_ws(":", "m", "path", *shared)).withColumn("view", view)


def _halves(a: Column, b: Column, path: Column) -> Column:
    """The spans below the span (a, b); itself, if what is left cannot be divided."""
    half = F.floor((F.col("m") - a - b) / 2).cast("int")
    span = lambda x, y, step: F.struct(x.alias("a"), y.alias("b"), F.concat(path, F.lit(step)).alias("path"))
    return F.when(half > 0, F.array(span(a + half, b, "f"), span(a, b + half, "l"))).otherwise(F.array(span(a, b, "f")))


def blocks(vocabulary: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(key, m, path, view, n) of all blocks to be scanned."""
    lengths = F.explode(F.array(F.char_length("word"), F.char_length("word") - 1))
    rows = _in_blocks(vocabulary.select("word", "n", lengths.alias("m")).where("m > 0"), _halves(F.lit(0), F.lit(0), F.lit("")))
    done = []
    while True:
        rows = written(rows)
        counts = rows.groupBy("key", F.expr("m - a - b > 1").alias("wide")).agg(F.count("*").alias("held"))
        large = written(counts.where((F.col("held") > block_words) & F.col("wide")).select("key"))
        last = large.isEmpty()
        done.append((rows if last else rows.join(large, "key", "left_anti")).select("key", "m", "path", "view", "n"))
        if last:
            return reduce(DataFrame.unionByName, done)
        again = rows.join(large, "key", "left_semi").select("word", "n", "m", *[F.col(c).alias(f"own_{c}") for c in ("a", "b", "path")])
        rows = _in_blocks(again, _halves(F.col("own_a"), F.col("own_b"), F.col("own_path")))


def home(m: int, prefix: int, steps: int) -> str:
    """The path to the block in which a pair is compared that has this common prefix."""
    a = b = 0
    path = ""
    for _ in range(steps):
        half = (m - a - b) // 2
        if prefix >= a + half:
            a, path = a + half, path + "f"
        else:
            b, path = b + half, path + "l"
    return path


def span(m: int, path: str) -> tuple[int, int]:
    a = b = 0
    for step in path:
        half = (m - a - b) // 2
        a, b = (a + half, b) if step == "f" else (a, b + half)
    return a, b


def common_prefix(x: str, y: str) -> int:
    n = min(len(x), len(y))
    if x[:n] == y[:n]:
        return n
    return next(i for i in range(n) if x[i] != y[i])


def one_edit(word: str, words: list[str], shared: list[int]) -> Iterator[int]:
    """Places in the sorted list of the words that are exactly one edit away.

    `shared[i]` is the common prefix of words i - 1 and i. Row d of the matrix has the cells for
    d - 1, d and d + 1 characters of `word`.
    """
    query = f"\0{word}\0\0\0"
    rows = [(9, 0, 1)] * (max(map(len, words), default=0) + 1)
    i, n = 0, len(words)
    while i < n:
        other, depth = words[i], shared[i]
        before, same, behind = rows[depth]
        for d in range(depth, len(other)):
            c = other[d]
            before, same, behind = (
                min(before + (query[d] != c), same + 1),
                min(same + (query[d + 1] != c), behind + 1),
                behind + (query[d + 2] != c),
            )
            same = min(same, before + 1)
            behind = min(behind, same + 1)
            rows[d + 1] = before, same, behind
            if before > 1 and same > 1 and behind > 1:
                i = bisect_right(words, other[: d + 1] + _LAST, i + 1)
                break
        else:
            at = len(word) - len(other) + 1
            if 0 <= at <= 2 and rows[len(other)][at] == 1:
                yield i
            i += 1


def _scan_block(m: int, path: str, words: list[str], counts: list[int]) -> Iterator[tuple[str, int, int, str]]:
    """(word, near words, largest count, its word) of the words with a near one in the block."""
    if len(words) < 2 or all(len(w) > m for w in words):
        return
    a, b = span(m, path)
    plain = words if a >= b else [w[::-1] for w in words]
    shared = [0, *map(common_prefix, words, words[1:])]
    near: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        if len(word) == m:
            for j in one_edit(word, words, shared):
                if home(m, common_prefix(plain[i], plain[j]), len(path)) == path:
                    near.setdefault(i, []).append(j)
                    if len(words[j]) > m:
                        near.setdefault(j, []).append(i)
    for i, others in near.items():
        best = min(others, key=lambda j: (-counts[j], plain[j]))
        yield plain[i], len(others), counts[best], plain[best]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks lie one after the other; a block may go over several batches."""
    key, block, words, counts = None, (), [], []
    for batch in batches:
        found = []
        for own, m, path, view, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if own != key:
                found += _scan_block(*block, words, counts) if block else []
                key, block, words, counts = own, (m, path), [], []
            words.append(view)
            counts.append(n)
        yield _nearest(found)
    yield _nearest(list(_scan_block(*block, words, counts)) if block else [])


def _nearest(found: list[tuple[str, int, int, str]]) -> pa.RecordBatch:
    kinds = {"word": pa.string(), "near": pa.int64(), "form_n": pa.int64(), "form": pa.string()}
    return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], kind) for i, kind in enumerate(kinds.values())], list(kinds))


def near_words(vocabulary: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(word, n_near, form_n, form) of words with near ones; the form is the most frequent of these."""
    ordered = blocks(vocabulary, block_words).repartition("key").sortWithinPartitions("key", "view")
    found = ordered.mapInArrow(_scan, "word string, near long, form_n long, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    found = found.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("best"))
    return found.select("word", "n_near", (-F.col("best.less")).alias("form_n"), "best.form")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form: the last one when forms are followed.

    Each round doubles the steps taken; a form is more frequent than its word, so chains end.
    """
    at = written(forms.select("word", F.col("form").alias("root")))
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = written(at.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        at = step.select("word", "root")
        if step.where("moved").isEmpty():
            return at


def group_variants(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least_chars: int = 6,
    least_count: int = 5,
    ratio: int = 5,
    drop_every: int | None = None,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Every word with its near words, its form (at least `ratio` times as frequent) and its root."""
    if ratio < 2:
        raise ValueError("a form must be more frequent than its word")
    vocabulary = written(count_words(docs, key, text, least_chars, drop_every).where(F.col("n") >= least_count))
    rows = vocabulary.join(near_words(vocabulary, block_words), "word", "left")
    formed = F.col("form_n") >= F.lit(ratio) * F.col("n")
    rows = written(
        rows.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(formed, F.col("form")).alias("form"),
            F.when(formed, F.col("form_n")).alias("form_n"),
        )
    )
    known = roots(rows.where("form IS NOT NULL").select("word", "form"))
    return rows.join(known, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
