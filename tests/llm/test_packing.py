"""Packing: first fit, powers of two, whole documents back from their pieces."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from gleanery.llm import packing

SCHEMA = "doc_id long, text string, ids string, `row` int, `group` string"


TOKENIZER = Tokenizer.from_file(packing.tokenizer_path())


def whole(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [packing.END_ID]


@pytest.mark.parametrize("seed", range(5))
def test_first_fit_equals_a_plain_search(seed):
    draw = random.Random(seed)
    lengths = [draw.randint(1, 100) for _ in range(draw.randint(1, 300))]
    room, plain = [], []
    for n in lengths:
        place = next((i for i, free in enumerate(room) if free >= n), len(room))
        if place == len(room):
            room.append(100)
        room[place] -= n
        plain.append(place)
    assert packing.first_fit(lengths, 100) == plain


@pytest.mark.parametrize("seed", range(8))
def test_group_has_no_padding_and_every_token_once(seed):
    draw = random.Random(seed)
    lengths = [draw.randint(1, 63) for _ in range(draw.choice([0, 1, 2, 40, 500]))]
    held, sequences = defaultdict(list), defaultdict(list)
    for item, first, n, sequence, offset in packing.pack_lengths(lengths, 64):
        held[item] += range(first, first + n)
        sequences[sequence].append((offset, n))
    assert {i: sorted(x) for i, x in held.items()} == {i: list(range(n)) for i, n in enumerate(lengths)}
    for own in sequences.values():
        total = 0
        for offset, n in sorted(own):
            assert offset == total
            total += n
        assert total & (total - 1) == 0 and total <= 64
    assert sum(sum(n for _, n in own) < 64 for own in sequences.values()) <= 6  # the last bin alone is divided


def test_words_give_the_ids_of_the_whole_text():
    tricky = [
        "Straße I'll  DON'T a b c\x1cd\x85e",
        "e ́x é ΣΑΣ ΟΔΟΣ İstanbul",
        "x<|endoftext|>y <|endoftext|> <|startof text|>",
        "".join(chr(c) for c in range(1, 0x500)),
        "\n\n \t",
        "日本語 テキスト 🙂🙂 ½ ④ 1234",
    ]
    with open(packing.tokenizer_path(), encoding="utf-8") as file:
        tokens = packing.WordTokens(file.read())
    flat, totals = tokens.ids([t.encode() for t in tricky], packing.END_ID)
    assert flat.tolist() == [i for t in tricky for i in whole(t)]
    assert totals.tolist() == [len(whole(t)) for t in tricky]


def test_plain_words_and_marks_give_the_ids_of_the_whole_text():
    marks = [chr(c) for c in range(0x300, 0x370)]
    words = [f"{x}{m}" for x in "AEIKNOSUZbq" for m in marks]
    words += [f"{a}{core}{b}" for a in ["", "(", "<|", "..", "'", "#$"] for core in ["", "Don", "isn", "xyz"] for b in ["", ",", "'s", "?!", "|>", "'LL.", "_x", "…"]]
    with open(packing.tokenizer_path(), encoding="utf-8") as file:
        tokens = packing.WordTokens(file.read())
    for one in ([w] for w in words):
        assert tokens.ids([one[0].encode()], packing.END_ID)[0].tolist() == whole(one[0]), one
    assert tokens.ids([" ".join(words).encode(), b"x"], packing.END_ID)[0].tolist() == whole(" ".join(words)) + whole("x")


def test_long_texts_are_encoded_in_parts(monkeypatch):
    monkeypatch.setattr(packing, "PART", 50)
    monkeypatch.setattr(packing, "KEPT_WORDS", 3)
    text = "Lorem ipsum dolor\tsit amet, " * 40 + "x" * 300
    with open(packing.tokenizer_path(), encoding="utf-8") as file:
        tokens = packing.WordTokens(file.read())
    assert tokens.ids([text.encode()], packing.END_ID)[0].tolist() == whole(text)


def test_documents_come_back(spark):
    draw = random.Random(3)
    words = "alpha beta gamma delta, Epsilon zeta".split()
    texts = [" ".join(draw.choices(words, k=draw.choice([0, 1, 5, 60, 300]))) for _ in range(60)]
    rows = [(i, t, "x", 1, "y") for i, t in enumerate(texts)] + [(7, texts[7], "x", 1, "y"), (100, None, None, None, None), (None, "null key", "", 0, "")]
    pieces = packing.pack(spark.createDataFrame(rows, SCHEMA), size=64, group_rows=20).collect()
    by_doc, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert len(p.ids) == 4 * p.length
        by_doc[p.doc_id].append((p.start, np.frombuffer(p.ids, "<u4").tolist(), p.doc_tokens))
        sequences[p.sequence_id].append((p.offset, p.length))
    wanted = {i: whole(t) for i, t in enumerate(texts)} | {100: whole(""), None: whole("null key")}
    for key, ids in wanted.items():
        times = 2 if key == 7 else 1
        got = sorted(by_doc[key])
        assert sorted(x for _, own, _ in got for x in own) == sorted(ids * times)
        assert {n for _, _, n in got} == {len(ids)}
        if times == 1:
            assert [x for _, own, _ in got for x in own] == ids
            assert [s for s, _, _ in got] == [sum(len(own) for _, own, _ in got[:i]) for i in range(len(got))]
    for own in sequences.values():
        ends = 0
        for offset, n in sorted(own):
            assert offset == ends
            ends += n
        assert ends & (ends - 1) == 0 and ends <= 64


def test_report_has_checksums_of_the_pieces(spark):
    docs = spark.createDataFrame([(1, "some words and more of them")], "doc_id long, text string")
    rows = packing.report(docs, size=4).orderBy("start").collect()
    ids = whole("some words and more of them")
    for r in rows:
        part = np.array(ids[r.start : r.start + r.length], "<u4").tobytes()
        assert r.ids_crc32 == zlib.crc32(part)
    assert rows[-1].start + rows[-1].length == len(ids) == rows[0].doc_tokens


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA)).collect() == []


def test_accented_words_are_merged_directly(monkeypatch):
    with open(packing.tokenizer_path(), encoding="utf-8") as file:
        tokens = packing.WordTokens(file.read())
    whole_words = []
    encoded = tokens._encoded
    monkeypatch.setattr(tokens, "_encoded", lambda words: whole_words.extend(words) or encoded(words))
    letters = [chr(c) for c in range(0xC0, 0x100)]
    text = " ".join([*letters, *("x" + c + "yz" for c in letters), "(Straße,)", "año!!", "l'été", "ét", "9é", "<|endoftext|>é"])
    ids, totals = tokens.ids([text.encode(), b"", text.encode()], packing.END_ID)
    assert ids.tolist() == whole(text) + whole("") + whole(text) and totals.tolist() == [len(whole(text)), 1, len(whole(text))]
    assert "año!!" not in whole_words and "xéyz" not in whole_words and "l'été" in whole_words
