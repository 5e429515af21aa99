import corpus_pipeline
from tickerpulse.llm.common import DOCUMENT_COLUMNS
from tickerpulse.workspace import as_table

from . import brute


def test_stages(spark):
    """Every stage against a plain version of what it must do with its own input."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    marks = {
        r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()
    }
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "quality_rules", "line_dedup", "near_dedup", "packing",
    ]
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        after = as_table(stage(spark, docs, folder), "stage")
        if name == "packing":
            words = sum(len(brute.SPACE.findall(t)) + 1 for t in before.values())
            assert sum(r["length"] for r in after.collect()) == words
            break
        assert after.columns == DOCUMENT_COLUMNS
        texts = {r["doc_id"]: r["text"] for r in after.collect()}
        gone = set(before) - set(texts)
        if name == "toxicity":
            assert sum(marks.get(i) == 0 for i in gone) <= 0.05 * len(before)
        if name == "quality_rules":
            failed = {
                i
                for i, t in before.items()
                if (c := brute.quality_counts(t))[0] < 10 or 100 * c[4] > 20 * c[0]
            }
            assert failed <= gone
        if name == "line_dedup":
            assert texts == brute.line_dedup(list(before.items()))
            assert all(r["n_chars"] == len(r["text"]) for r in after.collect())
        if name == "near_dedup":
            found = brute.components(list(before.items()), 5)
            assert set(texts) == {i for i, (_, root) in found.items() if i == root}
        docs = after


def test_empty_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = as_table(stage(spark, docs, folder), "stage")
        assert docs.count() == 0


def test_rows_are_judged_one_by_one(spark):
    """A null id hides no bad row, and a good row may share the id of a bad one."""
    good = " ".join(f"word{i} of the story" for i in range(60)) + "."
    bad = "spam spam spam spam spam " * 30
    rows = [(None, bad), (None, good), (1, bad), (1, good + " The end."), (2, "short"), (2, None)]
    docs = spark.createDataFrame(
        [(i, t, "en", "s", len(t or "")) for i, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    kept = corpus_pipeline.quality_stage(spark, docs, "/root/testdata/sf0.001").collect()
    assert {(r["doc_id"], r["text"]) for r in kept} == {(None, good), (1, good + " The end.")}
    toxic = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").filter("toxic = 1")
    texts = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").join(
        toxic.select("doc_id"), "doc_id"
    )
    hidden = texts.selectExpr("CAST(NULL AS BIGINT) AS doc_id", "text", "lang", "source", "n_chars")
    seen = corpus_pipeline.toxicity_stage(
        spark, spark.read.parquet("/root/testdata/sf0.001/documents.parquet").unionByName(hidden),
        "/root/testdata/sf0.001",
    )
    assert seen.filter("doc_id IS NULL").count() <= 0.1 * texts.count()
