import random

from gleanery.llm import jaccard


def sets(text, width):
    words = (text or "").encode().lower().split()
    size = min(width, len(words))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1)) if words else frozenset()


def brute(rows, width, percent):
    own = [sets(t, width) for _, t in rows]
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if own[i] and 100 * len(own[i] & own[j]) >= percent * len(own[i] | own[j]):
                a, b = sorted((root(i), root(j)))
                label[b] = a
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(rows[i][0])
    return {rows[i][0]: (len(own[i]), min(groups[root(i)])) for i in range(len(rows))}


def corpus():
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(4000)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    out = [None, "", " \t", "one", "one", "ONE", "one two", "x y z", "x y z w", "É é", "é É"]
    for size in (9, 10, 12, 21, 40, 120, 400):
        for _ in range(4):
            base = text(size)
            out.append(" ".join(base))
            for edits in (1, 1, 2, size // 60 + 1, size // 20 + 1):
                copy = base.copy()
                for _ in range(edits):
                    at = rng.randrange(len(copy))
                    copy[at : at + rng.choice((0, 1))] = [rng.choice(vocabulary)]
                out.append(" ".join(copy))
            out.append(" ".join(base) + " tail")
    passage = text(50)
    out += [" ".join(passage + text(60)) for _ in range(60)]  # a passage of many documents
    near = text(100)
    out += [" ".join(near[:i] + ["changed"] + near[i + 1 :]) for i in range(60)]  # one large group of near copies
    chain = text(400)
    out += [" ".join(chain[i : i + 200]) for i in range(0, 100, 5)]  # linked by neighbours only
    out += [out[20]] * 7
    rng.shuffle(out)
    return list(enumerate(out))


def check(spark, rows, width, percent):
    df = spark.createDataFrame([(i, t, 0, "x") for i, t in rows], "doc_id long, text string, node int, label string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.link_components(df, width=width, percent=percent).collect()}
    assert got == brute(rows, width, percent)


def test_equals_brute_force(spark):
    check(spark, corpus(), 3, 90)


def test_other_width_small_blocks_and_light_sets(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    monkeypatch.setattr(jaccard, "OFTEN", 4)
    monkeypatch.setattr(jaccard, "FETCH_ROWS", 0)
    monkeypatch.setattr(jaccard, "_boundary", lambda *a: 60)
    check(spark, corpus(), 5, 80)


def test_one_document_of_each_group_stays(spark, tmp_path):
    rows = corpus()
    path = str(tmp_path / "docs")
    spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, source string").write.parquet(path)
    kept = jaccard.keep_one(spark.read.parquet(path), width=5, percent=80).collect()
    groups = brute(rows, 5, 80)
    assert len(kept) == len({g for _, g in groups.values()}) and len({groups[r["doc_id"]][1] for r in kept}) == len(kept)


def test_no_rows_and_equal_rows_only(spark):
    check(spark, [], 3, 90)
    check(spark, [(i, "a b c d e f g h i j k l m") for i in range(30)], 3, 90)
    check(spark, [(i, None) for i in range(5)], 3, 90)


def test_rows_keep_their_numbers_when_files_are_split_anew(spark, tmp_path, monkeypatch):
    rows = [(i, f"text {i // 2} " + " ".join(f"w{i // 2}x{j}" for j in range(20)), "s") for i in range(64)]
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(16, "doc_id").write.parquet(path)
    link = jaccard.link_components

    def then_split_anew(*given):
        out = jaccard.written(link(*given))
        spark.conf.set("spark.sql.files.maxPartitionBytes", "600")
        return out

    monkeypatch.setattr(jaccard, "link_components", then_split_anew)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100m")
    try:
        kept = [r["doc_id"] // 2 for r in jaccard.keep_one(spark.read.parquet(path), width=5, percent=80).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(kept) == list(range(32))
