import random
import zlib

import numpy as np
import pytest

from gleanery.llm import langid

SYLLABLES = {"aa": ["ka", "lo", "mi", "ne"], "bb": ["ö", "sch", "ung", "er"], "cc": ["ção", "nh", "es", "da"]}


def text(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    out = []
    for i in range(240):
        lang = rng.choice(sorted(SYLLABLES))
        out.append((i, text(rng, lang, rng.choice((3, 40, 300))), lang))
    return out + [(1000, None, "aa"), (1001, "", "bb"), (1002, "123 -- 456!", "cc"), (1003, text(rng, "aa", 50), None), (1004, text(rng, "bb", 20000), "bb"), (0, *out[0][1:])]


def test_gradients_follow_the_loss():
    net = langid.Network.random(3, hidden=4)
    codes, labels = np.random.default_rng(0).integers(0, 256, (3, 6)), np.array([0, 1, 2])
    _, grads = net.loss(codes, labels)
    for name, grad in grads.items():
        values = net.plain()[name]
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        values[at] += 1e-5
        up = net.loss(codes, labels)[0]
        values[at] -= 2e-5
        down = net.loss(codes, labels)[0]
        values[at] += 1e-5
        assert np.isclose((up - down) / 2e-5, grad[at], rtol=1e-4)


def test_stretches_that_advance_together_change_nothing():
    net = langid.Network.of(langid.Network.random(2, hidden=4).plain())
    texts = ["a b c" * 90, None, "", "x", "12"]
    langs, scores = langid.predict_texts(texts, ["p", "q"], net)
    for t, lang, score in zip(texts, langs, scores):
        one_lang, one_score = langid.predict_texts([t], ["p", "q"], net)
        assert one_lang == [lang] and np.isclose(one_score[0], score, atol=1e-6)
    assert langs[1] == langs[2] == langs[4] == "und" and scores[1] == 0


def test_held_out_accuracy_and_odd_rows(spark, rows):
    df = spark.createDataFrame([(*r, 1.0, "x") for r in rows], "doc_id long, text string, lang string, score double, _lang string")
    got = langid.report(df).collect()
    assert len(got) == len(rows)
    truth = {i: lang for i, _, lang in rows[:240]}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    tested = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert np.mean([truth[r["doc_id"]] == r["lang_pred"] for r in tested]) > 0.95
    by_id = {r["doc_id"]: r for r in got}
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0 for i in (1000, 1001, 1002))
    assert by_id[1003]["lang_pred"] == "aa" and by_id[1004]["lang_pred"] == "bb"
    assert len({(r["lang_pred"], r["score"]) for r in got if r["doc_id"] == 0}) == 1
    assert all(0 <= r["score"] <= 1 for r in got)


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert [r["lang_pred"] for r in langid.report(df).collect()] == ["und"]
    assert langid.report(df.limit(0)).count() == 0


def test_copies_and_odd_texts_do_not_thin_the_sample(spark):
    rows = [(i, f"text {chr(97 + i % 26)} {i}", "aa") for i in range(400)] + [(1000 + i, "one text", "aa") for i in range(30000)]
    rows += [(40000 + i, f"autre {i}", f"l{i % 70}") for i in range(700)] + [(50000 + i, None, "l1") for i in range(5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = [name for name, _ in langid.sample(df)]
    assert got.count("aa") == langid.SAMPLE_TEXTS and len(set(got)) == 71
    wanted = {r[1] for r in rows if r[2] == "l1" and r[1] and zlib.crc32(str(r[0]).encode()) % 5}
    assert {part for name, part in langid.sample(df) if name == "l1"} == wanted
