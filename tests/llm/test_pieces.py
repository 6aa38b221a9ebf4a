import random

import pytest
import unigram

from gleanery.llm import pieces, token_counts, vocabulary

TEXTS = [
    None, "", " ", "   two  spaces ", "one", "The therea theon lereé hesting.\nSthant", "日本語 𝒳 x\ty\r\n", "a" * 5000, "word " * 3000,
    "é" * 40, "\u0000\u0001 ctrl", "emoji 👩‍👩‍👧 end", "the the the", "one",
]


@pytest.fixture(scope="module")
def converted(tmp_path_factory):
    path = str(tmp_path_factory.mktemp("vocabulary") / "unigram.model")
    return path, unigram.convert(vocabulary.PATH, path)


def made_up(n):
    rng = random.Random(5)
    syllables = ["th", "he", "er", "on", "ü", "ß", "ción", "é", "ll", "ä", "the", "\n", "☃", "12", ".", ","]
    return ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 9))) for _ in range(n)]


def test_words_equal_the_library(converted):
    path, library = converted
    encoder = pieces.Encoder(vocabulary.load(path))
    words = sorted(set(made_up(4000)))
    flat, first, counts = encoder.words([vocabulary.SPACE + w for w in words])
    got = [flat[a : a + n].tolist() for a, n in zip(first, counts)]
    assert got == [library.encode(w) for w in words]


def test_counts_equal_pieces_and_the_library(converted):
    path, library = converted
    vocab = vocabulary.load(path)
    counter, encoder = token_counts.Counter(vocab), pieces.Encoder(vocab)
    texts = [" ".join(made_up(6)) for _ in range(200)]
    assert [counter.text(t)[1] for t in texts] == [len(x) for x in encoder.texts(texts)] == [len(library.encode(t)) for t in texts]


def test_round_trip_and_odd_texts(spark):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, pieces string, decoded int")
    rows = {r["doc_id"]: r for r in pieces.round_trip(df).collect()}
    assert len(rows) == len(TEXTS) and all(r["restored"] for r in rows.values())
    assert rows[0]["n_pieces"] == rows[1]["n_pieces"] == 0 and rows[0]["pieces_sha256"] is None
    counts = {r["doc_id"]: r["n_pieces"] for r in token_counts.count_tokens(df).collect()}
    assert counts == {i: r["n_pieces"] for i, r in rows.items()}
    assert pieces.round_trip(df.limit(0)).count() == token_counts.count_tokens(df.limit(0)).count() == 0


def test_a_colliding_hash_is_noticed(monkeypatch):
    words = [vocabulary.SPACE + w for w in made_up(50)]
    vocab = vocabulary.load()
    right = pieces.Encoder(vocab).words(words)
    weak = lambda chars: pieces.np.cumsum(pieces.np.concatenate([pieces.np.zeros((1, len(chars)), pieces.np.uint64), chars.T.astype(pieces.np.uint64) % 7]), 0, dtype=pieces.np.uint64)
    monkeypatch.setattr(pieces, "_prefixes", weak)
    monkeypatch.setattr(pieces, "_BASE", pieces.np.uint64(1))
    found = pieces.Encoder(vocab).words(words)
    text = lambda r: [r[0][a : a + n].tolist() for a, n in zip(r[1], r[2])]
    assert text(found) == text(right)


def test_decoding_odd_ids(spark):
    df = spark.createDataFrame([(1, [1, None, -5, 99999999, 300]), (2, None), (3, [])], "k int, pieces array<int>")
    assert {r["k"]: r["decoded"] for r in pieces.decode(df).collect()} == {1: "om", 2: None, 3: ""}
