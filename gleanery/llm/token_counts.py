"""Token counts without tokens: a Viterbi search that carries counts only.

An Aho-Corasick automaton of the vocabulary enumerates all pieces that end at each character of a
word, the longest first. The dynamic program keeps, for every position, the best score and the
number of pieces on the best way there; no backpointers and no pieces. A better score replaces,
an equal one does not: since longer pieces come first, the earliest start wins ties, which is the
tokenizer's rule. Counts are kept per distinct word of a task, in a table of bounded size.

Defined results: null and empty texts have no words, no pieces and a score of 0. An unknown
character counts its UTF-8 bytes. Repeated rows are counted each.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from gleanery.llm import vocabulary
from gleanery.llm.common import picked
from gleanery.llm.vocabulary import Vocabulary

#: Distinct words whose counts a task keeps at once.
KEPT_WORDS = 300_000


class Counter:
    def __init__(self, vocab: Vocabulary) -> None:
        import ahocorasick

        self.unknown = vocab.unknown_score
        self.single = frozenset(vocab.pieces[i] for i in vocab.matched if len(vocab.pieces[i]) == 1)
        self.automaton = ahocorasick.Automaton()
        for i in vocab.matched:
            self.automaton.add_word(vocab.pieces[i], (len(vocab.pieces[i]), vocab.scores[i]))
        self.automaton.make_automaton()
        self.counts: dict[str, int] = {}
        self.scores: dict[str, float] = {}

    def word(self, word: str) -> tuple[int, float]:
        """Number of pieces and score of the best segmentation."""
        best = [float("-inf")] * (len(word) + 1)
        count = [0] * (len(word) + 1)
        best[0] = 0.0
        done = 0
        for last, (size, score) in self.automaton.iter(word):
            while done < last:
                self._alone(word, done, best, count)
                done += 1
            end = last + 1
            total = best[end - size] + score
            if total > best[end]:
                best[end] = total
                count[end] = count[end - size] + 1
        while done < len(word):
            self._alone(word, done, best, count)
            done += 1
        return count[-1], best[-1]

    def _alone(self, word: str, at: int, best: list[float], count: list[int]) -> None:
        """The unknown character at this place, after all pieces that end with it."""
        if word[at] not in self.single and best[at] + self.unknown > best[at + 1]:
            best[at + 1] = best[at] + self.unknown
            count[at + 1] = count[at] + len(word[at].encode())

    def text(self, text: str | None) -> tuple[int, int, float]:
        """Words, pieces and score of a text."""
        own = vocabulary.words(text)
        if len(self.counts) > KEPT_WORDS:
            self.counts.clear()
            self.scores.clear()
        for w in set(own).difference(self.counts):
            self.counts[w], self.scores[w] = self.word(w)
        return len(own), sum(map(self.counts.__getitem__, own)), sum(map(self.scores.__getitem__, own))


def count_tokens(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = vocabulary.PATH) -> DataFrame:
    """Per document the number of words and pieces, and the score of its best segmentation."""
    vocab = docs.sparkSession.sparkContext.broadcast(vocabulary.load(path).plain())
    rows = picked(docs, doc_id=key, text=text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(Vocabulary(*vocab.value))
        for batch in batches:
            found = [counter.text(t.as_py()) for t in batch.column(1)]
            n_words, n_pieces, score = ([x[i] for x in found] for i in range(3))
            columns = [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_pieces, pa.int64()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_pieces", "score"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_words long, n_pieces long, score double")
