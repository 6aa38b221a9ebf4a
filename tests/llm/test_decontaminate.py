import hashlib
import re

from gleanery.llm.decontaminate import remove_documents, remove_spans, report

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items, n=10):
    words, hit, found = split(text), set(), set()
    for item, body in items:
        own = split(body)
        size = min(n, len(own))
        for i in range(len(own) - size + 1 if size else 0):
            for j in range(len(words) - size + 1):
                if words[j : j + size] == own[i : i + size]:
                    hit.update(range(j, j + size))
                    found |= {str(item)} - {"None"}
    return len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


LONG = " ".join(f"w{i}" for i in range(30))
ITEMS = [(1, LONG), (2, "Short ITEM, only"), (10, "É à ü"), (3, None), (4, ""), (5, "?!"), (None, "no id here"), (2, "Short ITEM, only"), (6, "k " * 12)]
TEXTS = [
    None, "", "...", LONG, "a " + " ".join(f"w{i}" for i in range(5, 16)) + " b", " ".join(f"w{i}" for i in range(9)),
    "before short item-only after", "É À ü", "É à ü", "no id here", "k " * 40, "k " * 11, "w0 " * 3000 + LONG, LONG.upper().replace(" ", "\n--"), LONG,
]


def test_equals_brute_force(spark):
    docs = spark.createDataFrame([(i, t, 0, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, n_hit int, item_id string")
    bench = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, _items string")
    got = {r["doc_id"]: tuple(r)[1:] for r in report(docs, bench).collect()}
    assert got == {i: brute(t, ITEMS) for i, t in enumerate(TEXTS)}


def test_several_blocks_give_the_same(spark, monkeypatch):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    whole = sorted(map(tuple, report(docs, bench).collect()))
    monkeypatch.setattr("gleanery.llm.decontaminate.BLOCK_WINDOWS", 30)
    assert sorted(map(tuple, report(docs, bench).collect())) == whole


def test_removal_and_empty_benchmark(spark):
    docs = spark.createDataFrame([(1, "keep this. " + LONG + " and this!", "s"), (2, "clean", "s"), (3, None, "s")], "doc_id long, text string, source string")
    bench = spark.createDataFrame([(1, LONG)], "item_id long, text string")
    assert sorted(r["doc_id"] for r in remove_documents(docs, bench).collect()) == [2, 3]
    assert {r["doc_id"]: r["text"] for r in remove_spans(docs, bench).collect()} == {1: "keep this.  and this!", 2: "clean", 3: None}
    none = bench.limit(0)
    assert report(docs, none).where("contaminated").count() == 0
    assert report(docs.limit(0), bench).count() == 0
