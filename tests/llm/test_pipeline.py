import corpus_pipeline
import __spark_entry__
from gleanery.llm import decontaminate
from gleanery.llm.common import table, written

FOLDER = "/root/testdata/sf0.001"


def test_every_stage_keeps_what_it_should(spark):
    docs = table(spark, FOLDER, "documents")
    bench = table(spark, FOLDER, "benchmark")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(written(stage(spark, seen[-1], FOLDER)))
    ids = [{r["doc_id"] for r in d.select("doc_id").collect()} for d in seen]
    assert all(b <= a for a, b in zip(ids, ids[1:])) and len(ids) == 6
    assert all(d.columns == docs.columns for d in seen[:-1])
    assert ids[1] == ids[0]  # all of these texts have a language
    hit = {r["doc_id"] for r in decontaminate.report(seen[2], bench).where("contaminated").collect()}
    assert ids[3] == ids[2] - hit and ids[5] == ids[4] == ids[3]
    masked = {r["doc_id"]: r for r in seen[4].collect()}
    before = {r["doc_id"]: r for r in seen[3].collect()}
    assert all(masked[i]["text"] == before[i]["text"] or "[SECRET]" in masked[i]["text"] for i in masked)
    assert all(r["n_chars"] == len(r["text"]) for r in masked.values())
    assert all(r["n_pieces"] == len(r["pieces"]) > 0 for r in seen[5].collect())


def test_queries_are_registered():
    names = set(__spark_entry__.queries())
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()} == set(range(1, 14)) and "pipeline" in names


def test_odd_rows_pass_through_the_stages(spark, tmp_path):
    rows = [(1, None, None, None, None), (None, "word " * 12 + "end", "en", None, 3), (2, "", "en", "s", 0), (3, "Some text of its own here", None, "s", 1), (4, "123", "en", "s", 3)]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows * 2, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(path)
    spark.createDataFrame([(1, "nothing alike")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    # Only labelled rows are learned from: one language, so all with a letter are of it; copies go.
    assert sorted(str(r["doc_id"]) for r in got) == ["3", "None"]


def test_columns_of_any_name_pass_through_the_stages(spark, tmp_path):
    names = ["_text", "_spans", "_items", "_n_words", "_lang", "_score", "_place", "_found", "_given", "node", "pieces"]
    text = "These are some words of a plain text that is long enough to be one of a kind number {}"
    docs = spark.createDataFrame([(i, text.format(i // 2), "en", "s", 0, *range(len(names))) for i in range(6)], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` int" for n in names))
    spark.createDataFrame([(1, "nothing alike")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = written(stage(spark, docs, str(tmp_path)))
        assert out.columns == docs.columns and {tuple(r)[5:] for r in out.collect()} == {tuple(range(len(names)))}
        docs = out
    assert docs.count() == 1
