"""Spelling variants against a brute-force comparison of all words."""

import random
import re
import zlib
from collections import Counter
from itertools import product

import pytest

from gleanery.llm import variants

SCHEMA = "doc_id long, text string, word string, n int, form string"


def one_apart(x, y):
    if len(x) > len(y):
        x, y = y, x
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y, strict=True)) == 1
    return len(y) == len(x) + 1 and any(y[:i] + y[i + 1 :] == x for i in range(len(y)))


def plain(docs, least_chars, least_count, ratio, drop_every=None):
    counts = Counter()
    for key, text in docs:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", lower):
            check = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if drop_every and check % drop_every == 0:
                run = run[: check % len(run)] + run[check % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least_chars and n >= least_count}
    near = {w: [o for o in words if one_apart(w, o)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best and words[best] >= ratio * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def got(spark, docs, **parameters):
    df = spark.createDataFrame([(k, t, "x", 1, "y") for k, t in docs], SCHEMA)
    return sorted(tuple(r) for r in variants.group_variants(df, **parameters).select("word", "form", "root", "n", "n_near", "form_n").collect())


def skewed(draw, words, times):
    return [w for w in words for _ in range(draw.choice([1, 2, 3, times]))]


@pytest.mark.parametrize("block_words", [2, 128])
def test_equals_brute_force(spark, block_words):
    draw = random.Random(1)
    stems = ["".join(draw.choices("abé", k=draw.randint(1, 9))) for _ in range(250)]
    docs = [(None if i == 3 else i, " ".join(skewed(draw, draw.sample(stems, 40), 30)).title()) for i in range(6)]
    docs += [(9, None), (9, ""), (9, "1 2 .."), docs[0]]
    wanted = plain(docs, 2, 2, 2, 7)
    assert len(wanted) > 100 and any(r[1] and r[2] != r[1] for r in wanted)
    assert got(spark, docs, least_chars=2, least_count=2, ratio=2, drop_every=7, block_words=block_words) == wanted


@pytest.mark.parametrize("block_words", [1, 3, 50])
def test_dense_words_of_one_letter_up(spark, block_words):
    words = ["".join(p) for n in range(1, 6) for p in product("ab", repeat=n)]
    docs = [(1, " ".join(w for i, w in enumerate(words) for _ in range(1 + i % 4 * 5)))]
    assert got(spark, docs, least_chars=1, least_count=1, ratio=2, block_words=block_words) == plain(docs, 1, 1, 2)


def test_scan_skips_and_reuses_rows():
    draw = random.Random(5)
    for _ in range(300):
        words = sorted({"".join(draw.choices("abc", k=draw.randint(3, 4))) for _ in range(draw.randint(1, 40))})
        shared = [0, *map(variants.common_prefix, words, words[1:])]
        for w in words:
            if len(w) == 3:
                assert [words[i] for i in variants.one_edit(w, words, shared)] == [o for o in words if one_apart(w, o)]


def test_long_texts_are_counted_in_parts(spark, monkeypatch):
    docs = [(4, "nothing Lengthier, " * 500)]
    wanted = plain(docs, 6, 5, 5)
    monkeypatch.setattr(variants, "PART", 64)
    parts = [part.decode() for part in variants._parts(docs[0][1].encode())]
    assert len(parts) > 50 and [x for part in parts for x in re.findall("[a-zA-Z]+", part)] == re.findall("[a-zA-Z]+", docs[0][1])
    assert got(spark, docs) == wanted


def test_chain_of_forms_ends_at_the_root(spark):
    words = ["aaaaaa", "aaaaab", "aaaabb", "aaabbb", "aabbbb", "abbbbb"]
    docs = [(1, " ".join(" ".join([w] * 2**i) for i, w in enumerate(words)))]
    rows = got(spark, docs, least_count=1, ratio=2)
    assert {r[2] for r in rows} == {"abbbbb"} and rows == plain(docs, 6, 1, 2)


def test_empty_table(spark):
    assert got(spark, []) == [] and got(spark, [(1, None)]) == []
