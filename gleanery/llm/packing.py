"""Packing of documents into sequences: first-fit decreasing in randomised groups.

A document is its token ids and an end id. Runs of a whole sequence are cut off first and are
sequences of their own; what is left of each document, less than a sequence, is packed. The
rests are dealt into groups of about `group_rows` by a hash of their row number, whatever their
document, source or text, so no group grows with a hot value or with copies. Each group is packed
alone: rests by descending length go to the first bin with room, found by a descent in a
tournament tree of the bins' room. Then the emptiest bins are cut up to fill the room of
the others, and the one bin that is left is divided at powers of two, so a group needs no padding.

Words between ASCII white space are encoded once per worker and kept (`KEPT_WORDS` at most): the
tokenizer drops white space, and no token and no normal form goes over it.

Defined results: a null or empty text is the end id alone; a null key is kept; copies and
repeated rows are packed each on their own; long texts are encoded in parts of about `PART` bytes
and cut at any token; an empty table gives no pieces; extra columns take no part. Ties in length
go by row number. Sequence ids are unique, not gapless: even for whole runs, odd for packed ones.
"""

from __future__ import annotations

import json
import os
import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain, count, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import picked, written
from gleanery.llm.pieces import _ranges, _slices

SIZE = 4096
END_ID = 2
GROUP_ROWS = 2048
#: Bytes of text that are taken together, and distinct words that a task keeps.
PART = 1 << 21
KEPT_WORDS = 600_000
#: Bytes of an id on the way to its group; the vocabulary has fewer than 2^16.
NARROW = 2
#: Pieces in one batch that leaves a task.
BATCH_PIECES = 2048
#: ASCII punctuation but the apostrophe, which can begin a part of its own.
_SIGNS = r"[!-&(-/:-@\[-`{-~]*"
#: A word of lower-case letters below U+0100, with punctuation around them; nothing in it is normalised.
_PLAIN = rf"\A(?P<before>{_SIGNS})(?P<letters>[a-z\x{{df}}-\x{{f6}}\x{{f8}}-\x{{ff}}]*)(?P<behind>{_SIGNS})\z"
_SPACE = re.compile(rb"[ \t\n\r\x0b\x0c]")


def tokenizer_path() -> str:
    """Default place of the vocabulary; every operator takes another path."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a vocabulary of bytes."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = count(256)
    return [chr(b if b in shown else next(others)) for b in range(256)]


_LETTERS = _byte_letters()


class WordTokens:
    """Token ids of texts, by their words between ASCII white space.

    A word of plain letters with ASCII punctuation around them falls into these parts, which
    the vocabulary's merges are applied to directly; other words go through the whole tokenizer.
    """

    def __init__(self, definition: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self._forget()

    def _forget(self) -> None:
        self.index: defaultdict[bytes, int] = defaultdict(count().__next__)
        self.units: defaultdict[str, int] = defaultdict(count().__next__)
        self.flat, self.first, self.counts = _nothing()
        self.unit_flat, self.unit_first, self.unit_counts = _nothing()
        self._units([""], lambda _: [[]])

    def _units(self, units: list[str], encode: Callable[[list[str]], list[list[int]]]) -> np.ndarray:
        """Numbers of some parts of words; new ones are encoded."""
        known = len(self.units)
        number = np.fromiter(map(self.units.__getitem__, units), np.int64, len(units))
        if new := list(islice(self.units, known, None)):
            self.unit_flat, self.unit_first, self.unit_counts = _with(self.unit_flat, self.unit_first, self.unit_counts, encode(new))
        return number

    def _merged(self, units: list[str]) -> list[list[int]]:
        tokenize = self.tokenizer.model.tokenize
        return [[t.id for t in tokenize(u if u.isascii() else "".join(map(_LETTERS.__getitem__, u.encode())))] for u in units]

    def _encoded(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of some words in a row, and their number per word."""
        texts = pa.array(words, pa.binary()).cast(pa.string())
        parts = pc.extract_regex(texts, _PLAIN)
        plain = pc.and_(parts.is_valid(), pc.invert(pc.match_substring(texts, "<|")))
        number = np.zeros((len(words), 3), np.int64)
        for i, name in enumerate(("before", "letters", "behind")):
            coded = pc.if_else(plain, parts.field(name), "").dictionary_encode()
            number[:, i] = self._units(coded.dictionary.to_pylist(), self._merged)[coded.indices.to_numpy()]
        odd = pc.invert(plain)
        number[odd.to_numpy(zero_copy_only=False), 0] = self._units(texts.filter(odd).to_pylist(), self._encoded)
        counts = self.unit_counts[number]
        return self.unit_flat[_ranges(self.unit_first[number].ravel(), counts.ravel())], counts.sum(axis=1)

    def ids(self, texts: list[bytes], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and the number of each text's with its end id."""
        found, totals = [], np.ones(len(texts), np.int64)
        for a, b in _slices([len(t) for t in texts], PART):
            if b - a > 1:
                ids, counts = self._numbered(texts[a:b])
                ends = np.cumsum(counts)
                totals[a:b] += counts
                found.append(np.insert(ids, ends, end_id))
            else:  # perhaps a long one
                for part in _parts(texts[a]):
                    found.append(self._numbered([part])[0])
                    totals[a] += len(found[-1])
                found.append(np.array([end_id], np.uint32))
        return np.concatenate([np.empty(0, np.uint32), *found]), totals

    def _numbered(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words of some texts in a row, and their number per text."""
        if len(self.index) > KEPT_WORDS:
            self._forget()
        known = len(self.index)
        words = pc.ascii_split_whitespace(_lower(pa.array(texts, pa.binary()).cast(pa.string())))
        coded = words.values.dictionary_encode()
        own = coded.dictionary.cast(pa.binary()).to_pylist()  # each word of these texts once
        number = np.fromiter(map(self.index.__getitem__, own), np.int64, len(own))  # a new word gets the next number
        number = number[coded.indices.to_numpy()]
        new = list(islice(self.index, known, None))
        if new:
            ids, counts = self._words(new)
            self.first = np.concatenate([self.first, len(self.flat) + np.cumsum(counts) - counts])
            self.counts = np.concatenate([self.counts, counts])
            self.flat = np.concatenate([self.flat, ids])
        lengths = self.counts[number]
        ends = np.concatenate([[0], np.cumsum(lengths)])[words.offsets.to_numpy()[1:]]
        return self.flat[_ranges(self.first[number], lengths)], np.diff(ends, prepend=0)


def _nothing() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)


def _with(flat: np.ndarray, first: np.ndarray, counts: np.ndarray, ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All ids, the place of the first and the number of each entry, with some entries more."""
    more = np.fromiter(map(len, ids), np.int64, len(ids))
    added = np.fromiter(chain.from_iterable(ids), np.uint32, more.sum())
    return np.concatenate([flat, added]), np.concatenate([first, len(flat) + np.cumsum(more) - more]), np.concatenate([counts, more])


def _lower(texts: pa.StringArray) -> pa.StringArray:
    """A-Z in lower case, as the tokenizer would have them; special tokens stay as they are."""
    return pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))


@lru_cache(1)
def _tokens(definition: str) -> WordTokens:
    """A worker keeps its words from task to task."""
    return WordTokens(definition)


def _parts(text: bytes) -> Iterator[bytes]:
    """The text, a long one cut before white space."""
    start = 0
    while start < len(text):
        cut = _SPACE.search(text, start + PART)
        end = cut.start() if cut else len(text)
        yield text[start:end]
        start = end


def cut_documents(docs: DataFrame, key: str, text: str, size: int, end_id: int, path: str) -> DataFrame:
    """Pieces of at most `size` ids of every document.

    `row` numbers the documents; whole runs have their sequence and ids of 32 bits (little-endian),
    rests have none yet and ids of `NARROW` bytes, as they are shuffled.
    """
    with open(path, encoding="utf-8") as file:
        definition = file.read()  # a vocabulary, of fixed size whatever the corpus
    if max(end_id, *json.loads(definition)["model"]["vocab"].values()) >= 1 << 8 * NARROW:
        raise ValueError("ids need more bytes on their way")
    shared = docs.sparkSession.sparkContext.broadcast(definition)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(shared.value)
        first = TaskContext.get().partitionId() << 33
        rows = runs = 0
        for batch in batches:
            sizes = pc.binary_length(batch.column(1)).fill_null(0).to_pylist()
            for a, b in _slices(sizes, PART):
                keys, texts = batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a)
                flat, totals = tokens.ids([t or b"" for t in texts.cast(pa.binary()).to_pylist()], end_id)
                pieces = -(-totals // size)
                owner = np.repeat(np.arange(len(totals)), pieces)
                start = _ranges(np.zeros(len(totals), np.int64), pieces) * size
                length = np.minimum(size, totals[owner] - start)
                whole = length == size
                sequence = (first + runs + np.cumsum(whole) - 1) * 2
                begin = np.cumsum(length) - length
                for some, width in ((np.flatnonzero(whole), 4), (np.flatnonzero(~whole), NARROW)):
                    for i in range(0, len(some), BATCH_PIECES):
                        part = some[i : i + BATCH_PIECES]
                        yield pa.RecordBatch.from_arrays(
                            [
                                keys.take(pa.array(owner[part])),
                                pa.array(start[part]),
                                pa.array(length[part]),
                                pa.array(totals[owner[part]]),
                                _binary(flat[_ranges(begin[part], length[part])], length[part], width),
                                pa.array(first + rows + owner[part]),
                                pa.array(sequence[part], mask=~whole[part]),
                            ],
                            ["doc_id", "start", "length", "doc_tokens", "ids", "row", "sequence_id"],
                        )
                rows, runs = rows + len(totals), runs + int(whole.sum())

    given = picked(docs, doc_id=key, text=text)
    kind = given.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, doc_tokens long, ids binary, row long, sequence_id long"
    return given.mapInArrow(run, schema)


def _binary(flat: np.ndarray, lengths: np.ndarray, width: int) -> pa.Array:
    """Consecutive runs of ids as little-endian numbers of `width` bytes."""
    offsets = np.concatenate([[0], np.cumsum(lengths) * width]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(flat.astype(f"<u{width}").tobytes())])


def first_fit(lengths: list[int], size: int) -> list[int]:
    """Bin of each length, in the order given: the first with room.

    The leaves of the tree are bins, an inner node has the most room of any bin below it.
    """
    leaves = 1 << max(0, len(lengths) - 1).bit_length()
    room = [size] * (2 * leaves)
    bins = []
    for length in lengths:
        node = 1
        while node < leaves:
            node *= 2
            if room[node] < length:
                node += 1
        bins.append(node - leaves)
        room[node] -= length
        while node > 1:
            node //= 2
            most = max(room[2 * node], room[2 * node + 1])
            if room[node] == most:
                break
            room[node] = most
    return bins


def pack_lengths(lengths: list[int], size: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(item, first id, ids, sequence, offset) of every piece of a group.

    Items are taken by descending length, equal ones as given. All sequences but the last ones
    are full; these are as long as the powers of two that sum up to what is left.
    """
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    bins: dict[int, list[tuple[int, int, int]]] = {}
    for i, place in zip(order, first_fit([lengths[i] for i in order], size), strict=True):
        bins.setdefault(place, []).append((i, 0, lengths[i]))
    by_room = sorted(bins.values(), key=lambda held: size - sum(n for _, _, n in held))
    low, high = 0, len(by_room) - 1
    while low < high:
        free = size - sum(n for _, _, n in by_room[low])
        while free and low < high:
            item, first, n = by_room[high].pop()
            taken = min(n, free)
            by_room[low].append((item, first, taken))
            free -= taken
            if taken < n:
                by_room[high].append((item, first + taken, n - taken))
            elif not by_room[high]:
                high -= 1
        low += not free
    full = [held for held in by_room[: high + 1] if sum(n for _, _, n in held) == size]
    rest = [piece for held in by_room[len(full) : high + 1] for piece in held]
    for sequence, held in enumerate([*full, *_halved(rest)]):
        offset = 0
        for item, first, n in held:
            yield item, first, n, sequence, offset
            offset += n


def _halved(held: list[tuple[int, int, int]]) -> Iterator[list[tuple[int, int, int]]]:
    """The pieces, cut into runs as long as the powers of two in their sum."""
    pieces, left = list(reversed(held)), sum(n for _, _, n in held)
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        own = []
        while room:
            item, first, n = pieces.pop()
            taken = min(n, room)
            own.append((item, first, taken))
            room -= taken
            if taken < n:
                pieces.append((item, first + taken, n - taken))
        yield own


def _pack_group(size: int):
    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("row").combine_chunks()
        found = np.array(list(pack_lengths(table["length"].to_pylist(), size)), np.int64).reshape(-1, 5)
        item, first, length, sequence, offset = found.T
        group = table["group"][0].as_py()
        flat = np.frombuffer(b"".join(table["ids"].to_pylist()), f"<u{NARROW}")
        sizes = table["length"].to_numpy()
        begin = (np.cumsum(sizes) - sizes)[item] + first
        taken = table.select(["doc_id", "start", "doc_tokens"]).take(pa.array(item))
        return pa.table(
            {
                "doc_id": taken["doc_id"],
                "start": pc.add(taken["start"], pa.array(first)),
                "length": pa.array(length),
                "doc_tokens": taken["doc_tokens"],
                "ids": _binary(flat[_ranges(begin, length)], length, 4),
                "sequence_id": pa.array(((group << 24) + sequence) * 2 + 1),
                "offset": pa.array(offset),
            }
        )

    return pack


def pack(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    size: int = SIZE,
    end_id: int = END_ID,
    group_rows: int = GROUP_ROWS,
    path: str | None = None,
) -> DataFrame:
    """Every piece with its ids, its place in its document and its place in its sequence."""
    pieces = written(cut_documents(docs, key, text, size, end_id, path or tokenizer_path()))
    rests = pieces.where("sequence_id IS NULL")
    groups = max(1, -(-rests.count() // group_rows))
    dealt = rests.drop("sequence_id").withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)))
    kind = pieces.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, doc_tokens long, ids binary, sequence_id long, offset long"
    packed = dealt.groupBy("group").applyInArrow(_pack_group(size), schema)
    whole = pieces.where("sequence_id IS NOT NULL").withColumn("offset", F.lit(0).cast("long"))
    return whole.select(*packed.columns).unionByName(packed)


def report(docs: DataFrame, **parameters) -> DataFrame:
    """The pieces with the checksum of their ids."""
    pieces = pack(docs, **parameters)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
