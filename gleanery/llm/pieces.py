"""SentencePiece encoding and decoding by a batched Viterbi search in numpy.

The distinct words of a batch of rows are searched together, words of one length at a time:
all of them advance by one character per step. Rolling hashes of their substrings probe the
sorted piece hashes of that length (a table of bits by hash spares most probes), the best start is a
vectorised maximum over the starts, and the starts are stored as backpointers. What the
backpointers spell is compared with the word, so a colliding hash cannot change a result. The words'
pieces are then gathered into the rows; a task keeps those of `KEPT_WORDS` words at most.

Defined results: a null text has null pieces and decodes to null, an empty one no pieces.
Decoding gives back the text, except that a U+2581 in it comes back as a space. Ids outside
the vocabulary and control pieces decode to nothing, bytes that are no UTF-8 to U+FFFD.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.llm import vocabulary
from gleanery.llm.common import picked
from gleanery.llm.vocabulary import SPACE, Vocabulary

#: Characters of the words that are searched at once, and of the text taken together.
CELLS = 1 << 18
TEXT = 1 << 21
KEPT_WORDS = 150_000
_SEEN_BITS = np.uint64((1 << 18) - 1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNKNOWN = -1


class Encoder:
    """Piece hashes by length, sorted, with ids and scores."""

    def __init__(self, vocab: Vocabulary) -> None:
        self.vocab = vocab
        lengths: dict[int, list[int]] = {}
        for i in vocab.matched:
            lengths.setdefault(len(vocab.pieces[i]), []).append(i)
        self.longest = max(lengths)
        self.power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(self.longest, _BASE)]), dtype=np.uint64)
        self.tables = {}
        for size, ids in lengths.items():
            hashes = _prefixes(_matrix([vocab.pieces[i] for i in ids], size))[size]
            order = np.argsort(hashes, kind="stable")
            ids = np.array(ids)[order]
            seen = np.zeros(int(_SEEN_BITS) + 1, bool)
            seen[_bits(hashes)] = True
            self.tables[size] = seen, hashes[order], ids, np.array(vocab.scores)[ids]
        self._forget()

    def _forget(self) -> None:
        self.index: defaultdict[str, int] = defaultdict(count().__next__)
        self.flat, self.first, self.counts = (np.empty(0, np.int64) for _ in range(3))

    def words(self, distinct: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all words in a row, with the first place and the number of each word's."""
        by_length: dict[int, list[int]] = {}
        for i, w in enumerate(distinct):
            by_length.setdefault(len(w), []).append(i)
        flat, at, owner = [np.empty(0, np.int64)], [np.empty(0, np.int64)], []
        counts = np.zeros(len(distinct), np.int64)
        for size, members in by_length.items():
            rows = max(1, CELLS // size)
            for i in range(0, len(members), rows):
                part = members[i : i + rows]
                ids, lengths = self._equal([distinct[m] for m in part], size)
                counts[part] = lengths
                owner.append(np.repeat(part, lengths))
                flat.append(ids)
        owners = np.concatenate(owner) if owner else np.empty(0, np.int64)
        order = np.argsort(owners, kind="stable")
        return np.concatenate(flat)[order], np.cumsum(counts) - counts, counts

    def _equal(self, same: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number for words of one length."""
        chars = _matrix(same, size)
        sums, n = _prefixes(chars), len(same)
        best = np.full((size + 1, n), -np.inf)
        best[0] = 0
        start = np.zeros((size + 1, n), np.int32)
        piece = np.full((size + 1, n), _UNKNOWN, np.int32)
        for end in range(1, size + 1):
            alone = np.ones(n, bool)
            for begin in range(max(0, end - self.longest), end):
                if (entry := self.tables.get(end - begin)) is None:
                    continue
                seen, hashes, own, score = entry
                probe = sums[end] - sums[begin] * self.power[end - begin]
                at = np.flatnonzero(seen[_bits(probe)])
                place = np.minimum(np.searchsorted(hashes, probe[at]), len(hashes) - 1)
                hit = hashes[place] == probe[at]
                at, place = at[hit], place[hit]
                if begin == end - 1:
                    alone[at] = False
                total = best[begin, at] + score[place]
                better = total > best[end, at]  # an equal one has an earlier start and stays
                at, place = at[better], place[better]
                best[end, at], start[end, at], piece[end, at] = total[better], begin, own[place]
            total = best[end - 1] + self.vocab.unknown_score
            worse = np.flatnonzero(alone & (total > best[end]))
            best[end, worse], start[end, worse], piece[end, worse] = total[worse], end - 1, _UNKNOWN
        return self._spell(same, chars, start, piece)

    def _spell(self, same: list[str], chars: np.ndarray, start: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Follow the backpointers of all words together, then write unknowns as bytes."""
        n, size = chars.shape
        at, column = np.full(n, size), np.arange(n)
        ids, starts = np.zeros((size, n), np.int32), np.zeros((size, n), np.int32)
        used = np.zeros((size, n), bool)
        for step in range(size - 1, -1, -1):
            on = column[at[column] > 0] if step < size - 1 else column
            if not len(on):
                break
            ids[step, on], starts[step, on], used[step, on] = piece[at[on], on], start[at[on], on], True
            at[on] = start[at[on], on]
            column = on
        rows, steps = np.nonzero(used.T)
        flat, place = ids[steps, rows].astype(np.int64), starts[steps, rows]
        odd = np.flatnonzero(flat == _UNKNOWN)
        spelled = [self.vocab.pieces[i] for i in flat.tolist()]
        for k in odd.tolist():
            spelled[k] = same[rows[k]][place[k]]
        if "".join(spelled) != "".join(same):  # a hash collided: search these words by their substrings
            found = [self._plain(w) for w in same]
            return np.array([i for own in found for i in own], np.int64), np.array([len(own) for own in found])
        if not len(odd):
            return flat, used.sum(0)
        written = [[self.vocab.bytes_from[b] for b in spelled[k].encode("utf-8", "surrogatepass")] for k in odd.tolist()]
        times = np.ones(len(flat), np.int64)
        times[odd] = [len(w) for w in written]
        out, owners = np.repeat(flat, times), np.repeat(rows, times)
        out[out == _UNKNOWN] = [b for w in written for b in w]
        return out, np.bincount(owners, minlength=n)

    def _plain(self, word: str) -> list[int]:
        known = {self.vocab.pieces[i]: i for i in self.vocab.matched}
        best, back = [0.0], [(0, 0)]
        for end in range(1, len(word) + 1):
            top = (-np.inf, 0, 0)
            for begin in range(max(0, end - self.longest), end):
                i = known.get(word[begin:end])
                score = self.vocab.scores[i] if i is not None else self.vocab.unknown_score if begin == end - 1 else -np.inf
                if best[begin] + score > top[0]:
                    top = (best[begin] + score, begin, _UNKNOWN if i is None else i)
            best.append(top[0])
            back.append(top[1:])
        out, at = [], len(word)
        while at:
            begin, i = back[at]
            out += [i] if i != _UNKNOWN else [self.vocab.bytes_from[b] for b in word[begin].encode("utf-8", "surrogatepass")][::-1]
            at = begin
        return out[::-1]

    def texts(self, texts: list[str | None]) -> pa.Array:
        if len(self.index) > KEPT_WORDS:
            self._forget()
        index, known = self.index, len(self.index)
        per_row, numbers = [], []
        for text in texts:
            own = vocabulary.words(text)
            per_row.append(len(own))
            numbers += map(index.__getitem__, own)  # a new word gets the next number
        flat, first, counts = self.words(list(islice(index, known, None)))
        self.first = np.concatenate([self.first, first + len(self.flat)])
        self.flat, self.counts = np.concatenate([self.flat, flat]), np.concatenate([self.counts, counts])
        number = np.array(numbers, np.int64)
        lengths = self.counts[number]
        ids = self.flat[_ranges(self.first[number], lengths)].astype(np.int32)
        word_ends = np.concatenate([[0], np.cumsum(lengths)])
        offsets = word_ends[np.concatenate([[0], np.cumsum(per_row)])].astype(np.int32)
        null = pa.array([t is None for t in texts], pa.bool_())
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids), mask=null)


def _matrix(same: list[str], size: int) -> np.ndarray:
    return np.frombuffer("".join(same).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, size)


def _prefixes(chars: np.ndarray) -> np.ndarray:
    """Rolling hashes of the first 0, 1, ... characters of every word."""
    columns = np.ascontiguousarray(chars.T)
    out = np.zeros((len(columns) + 1, chars.shape[0]), np.uint64)
    for i, column in enumerate(columns):
        out[i + 1] = out[i] * _BASE + column
    return out


def _bits(hashes: np.ndarray) -> np.ndarray:
    return ((hashes ^ (hashes >> np.uint64(32))) & _SEEN_BITS).astype(np.int64)


def _ranges(first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... for each length in turn."""
    ends = np.cumsum(lengths)
    return np.repeat(first - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


def _slices(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Runs of rows of about `most` in sum; a larger row stands alone."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if len(sizes) > start:
        yield start, len(sizes)


def encode(df: DataFrame, text: str = "text", into: str = "pieces", path: str = vocabulary.PATH) -> DataFrame:
    """All columns, and the ids of the pieces of each text (array<int>) in place of a column of that name."""
    if into != text:
        df = df.drop(into)
    vocab = df.sparkSession.sparkContext.broadcast(vocabulary.load(path).plain())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(*vocab.value))
        for batch in batches:
            sizes = pc.binary_length(batch.column(names.index(text))).fill_null(0).to_pylist()
            for a, b in _slices(sizes, TEXT):
                part = batch.slice(a, b - a)
                ids = encoder.texts(part.column(names.index(text)).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, ids], [*names, into])

    names = df.columns
    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(into, T.ArrayType(T.IntegerType()))]))


class Decoder:
    """The bytes of all pieces in one buffer, with their places by id."""

    def __init__(self, vocab: Vocabulary) -> None:
        spelled = [p.replace(SPACE, " ").encode() for p in vocab.pieces]
        for b, i in enumerate(vocab.bytes_from):
            spelled[i] = bytes([b])
        self.size = len(spelled)
        self.lengths = np.array([*map(len, spelled), 0], np.int64)  # the last one stands for ids outside
        self.first = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(spelled), np.uint8)

    def texts(self, lists: pa.ListArray) -> list[str | None]:
        """The text of each list; null for a null one."""
        ids = lists.flatten().fill_null(-1).to_numpy().astype(np.int64)
        ids[(ids < 0) | (ids >= self.size)] = self.size
        lengths = self.lengths[ids]
        raw = self.flat[_ranges(self.first[ids], lengths)].tobytes()
        counts = pc.list_value_length(lists).fill_null(0).to_numpy()
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        null = lists.is_null().to_pylist()
        return [None if out else raw[x:y].removeprefix(b" ").decode("utf-8", "replace") for out, x, y in zip(null, ends, ends[1:], strict=False)]


def decode(df: DataFrame, ids: str = "pieces", into: str = "decoded", path: str = vocabulary.PATH) -> DataFrame:
    """All columns, and the text that each list of ids stands for."""
    vocab = df.sparkSession.sparkContext.broadcast(vocabulary.load(path).plain())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(Vocabulary(*vocab.value))
        for batch in batches:
            sizes = pc.list_value_length(batch.column(names.index(ids))).fill_null(0).to_pylist()
            for a, b in _slices(sizes, TEXT):
                part = batch.slice(a, b - a)
                out = decoder.texts(part.column(names.index(ids)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.string())], [*names, into])

    names = df.columns
    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(into, T.StringType())]))


def round_trip(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = vocabulary.PATH) -> DataFrame:
    """Per document the number and digest of its pieces, and whether decoding gives the text back.

    A batch is encoded and decoded in one go, so only the pieces leave the worker.
    """
    vocab = docs.sparkSession.sparkContext.broadcast(vocabulary.load(path).plain())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = Encoder(Vocabulary(*vocab.value)), Decoder(Vocabulary(*vocab.value))
        for batch in batches:
            for a, b in _slices(pc.binary_length(batch.column(1)).fill_null(0).to_pylist(), TEXT):
                texts = batch.column(1).slice(a, b - a).to_pylist()
                ids = encoder.texts(texts)
                restored = [x == y for x, y in zip(texts, decoder.texts(ids), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), ids, pa.array(restored, pa.bool_())], ["doc_id", "pieces", "restored"])

    given = picked(docs, doc_id=key, text=text)
    done = given.mapInArrow(run, f"doc_id {given.schema['doc_id'].dataType.simpleString()}, pieces array<int>, restored boolean")
    return done.select(
        "doc_id",
        F.coalesce(F.size("pieces"), F.lit(0)).cast("long").alias("n_pieces"),
        F.sha2(F.array_join("pieces", ","), 256).alias("pieces_sha256"),
        "restored",
    )
