import json
import time

import pytest
from pyspark.sql import functions as F

from tickerpulse.schemas import ARTICLE, SCORE
from tickerpulse.sources import messages as msg
from tickerpulse.streaming import jobs, sinks


@pytest.fixture
def topic(spark, tmp_path):
    """Adds one file, hence one micro-batch, per call; returns a reader of the topic."""
    folder = tmp_path / "topic"

    def add(values):
        sent = [(None if v is None else v.encode(), i) for i, v in enumerate(values)]
        df = spark.createDataFrame(sent, "value binary, offset long").coalesce(1)
        full = df.select(*[
            F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in msg.ENVELOPE
        ])
        msg.write_messages(full, {"path": str(folder)}, "parquet")

    def stream():
        return msg.stream_topic(spark, {"path": str(folder), "maxFilesPerTrigger": "1"}, "parquet")

    def batch():
        return msg.read_topic(spark, {"path": str(folder)}, "parquet")

    add.stream, add.batch = stream, batch
    return add


def article(i):
    return json.dumps({"title": f"t{i}", "article": f"The cat number {i} sat"})


def prediction(ticker, value):
    return json.dumps({"ticker": ticker, "sentiment_prediction": value})


def rows(df):
    return sorted((tuple(map(str, r)) for r in df.collect()))


def test_parquet_sink_over_batches_and_restart(spark, topic, tmp_path):
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    for part in ([article(1), article(2)], ["broken", None], [article(3)]):
        topic(part)

    def run():
        sinks.run_bounded(sinks.to_parquet(jobs.parsed_articles(topic.stream()), out, check), 60)

    run()
    assert rows(spark.read.parquet(out)) == rows(jobs.parsed_articles(topic.batch()))
    topic([article(4)])
    run()
    run()
    assert rows(spark.read.parquet(out)) == rows(jobs.parsed_articles(topic.batch()))
    assert spark.read.parquet(out).count() == 6


def test_features_on_stream_equal_batch(spark, topic, tmp_path):
    topic([article(1), "junk", None])
    topic([article(2)])
    path = str(tmp_path / "f")
    stream = jobs.article_features(jobs.parsed_articles(topic.stream()))
    sinks.run_bounded(sinks.to_parquet(stream, path, str(tmp_path / "c")))
    assert rows(spark.read.parquet(path)) == rows(jobs.article_features(jobs.parsed_articles(topic.batch())))
    draft = jobs.draft_features(jobs.parsed_articles(topic.stream()))
    path = str(tmp_path / "d")
    sinks.run_bounded(sinks.to_parquet(draft, path, str(tmp_path / "dc")))
    stems = [r["stemmed_tokens"] for r in spark.read.parquet(path).filter("title = 't1'").collect()]
    assert stems == [["cat", "number", "1", "sat"]]


def test_scores_from_topic_to_topic_to_table(spark, topic, tmp_path):
    topic([prediction("A", 0.5), prediction("B", -1)])
    topic([prediction("A", 2), prediction("A", None), "x"])
    out = {"path": str(tmp_path / "scaled")}
    sinks.run_bounded(
        sinks.to_topic(
            jobs.scaled_scores(topic.stream()), ["ticker", "aggregated_score"], out,
            str(tmp_path / "c1"), "parquet",
        )
    )
    sent = [json.loads(r["value"]) for r in spark.read.parquet(out["path"]).collect()]
    assert {"ticker": "A", "aggregated_score": 5.0} in sent
    assert {"ticker": "A", "aggregated_score": None} in sent
    table = str(tmp_path / "scores")
    stream = jobs.scores(spark.readStream.schema("value string").parquet(out["path"]))
    sinks.run_bounded(sinks.to_table(stream, table, str(tmp_path / "c2")))
    stored = sinks.read_table(spark, table, SCORE).drop("query_id", "batch_id")
    assert rows(stored) == rows(jobs.scaled_scores(topic.batch()))
    assert jobs.score_count(stored).first()["count"] == 5
    assert ("A", "3") in rows(jobs.score_count_by_ticker(stored))


def test_replayed_batch_is_stored_once(spark, topic, tmp_path):
    topic([prediction("A", 1)])
    table, check = str(tmp_path / "scores"), tmp_path / "c1"
    for _ in range(2):
        sinks.run_bounded(sinks.to_table(jobs.scaled_scores(topic.stream()), table, str(check)))
        assert sinks.read_table(spark, table, SCORE).count() == 1
        # As if the query had died before it noted the end of the batch.
        (check / "commits" / "0").unlink()
        (check / "commits" / ".0.crc").unlink(missing_ok=True)


def test_readers_see_whole_batches_only(spark, topic, tmp_path, monkeypatch):
    """A batch that dies after its files, or among them, is not there; the next attempt is, once."""
    table, check = str(tmp_path / "scores"), str(tmp_path / "c")

    def run(**options):
        stream = jobs.scaled_scores(topic.stream())
        sinks.run_bounded(sinks.to_table(stream, table, check, **options))

    topic([prediction("A", 1)])
    run()
    topic([prediction("B", 1), prediction("C", 1)])
    before = rows(sinks.read_table(spark, table, SCORE))
    with monkeypatch.context() as patch:
        patch.setattr(sinks, "_commit", lambda *args: 1 / 0)
        with pytest.raises(Exception, match="division"):
            run()
    assert rows(sinks.read_table(spark, table, SCORE)) == before
    broken = F.when(F.col("ticker") == "C", F.raise_error("dies")).otherwise(F.col("ticker"))
    with pytest.raises(Exception, match="dies"):
        run(per_batch=lambda batch: batch.withColumn("ticker", broken.cast("string")))
    assert rows(sinks.read_table(spark, table, SCORE)) == before
    run()
    run()
    assert [r["ticker"] for r in sinks.read_table(spark, table, SCORE).sort("ticker").collect()] == list("ABC")


def test_two_finished_attempts_count_once(spark, topic, tmp_path):
    topic([prediction("A", 1)])
    table = str(tmp_path / "scores")
    sinks.run_bounded(sinks.to_table(jobs.scaled_scores(topic.stream()), table, str(tmp_path / "c")))
    placed = sinks._commits(spark, table).first()
    twin = f"{table}/rows/query_id={placed['query_id']}/batch_id={placed['batch_id']}/attempt=zz"
    spark.createDataFrame([("A", 10.0)], SCORE).write.parquet(twin)
    sinks._commit(spark, table, placed["query_id"], placed["batch_id"], "zz")
    assert sinks.read_table(spark, table, SCORE).count() == 1


def test_a_table_without_batches_is_empty(spark, topic, tmp_path):
    topic([prediction("A", 1)])
    table = str(tmp_path / "scores")
    sinks.to_table(jobs.scaled_scores(topic.stream()), table, str(tmp_path / "c"))
    assert sinks.read_table(spark, table, SCORE).count() == 0


def test_queries_with_own_checkpoints_add_to_one_table(spark, topic, tmp_path):
    topic([prediction("A", 1), prediction("B", 1)])
    table, counts = str(tmp_path / "scores"), str(tmp_path / "counts")
    for check in ("c1", "c2"):
        stream = jobs.scaled_scores(topic.stream())
        sinks.run_bounded(sinks.to_table(stream, table, str(tmp_path / check)))
        sinks.run_bounded(sinks.to_running_counts(stream, counts, str(tmp_path / f"n{check}")))
    assert sinks.read_table(spark, table, SCORE).count() == 4
    assert rows(sinks.latest_counts(spark, counts)) == [("A", "2"), ("B", "2")]


def test_running_counts(spark, topic, tmp_path):
    path, check = str(tmp_path / "counts"), str(tmp_path / "check")
    for part in (["A", "B"], ["A"], ["A", "C"]):
        topic([prediction(t, 1) for t in part])

    def run():
        sinks.run_bounded(sinks.to_running_counts(jobs.scaled_scores(topic.stream()), path, check))

    run()
    assert rows(sinks.latest_counts(spark, path)) == [("A", "3"), ("B", "1"), ("C", "1")]
    topic([prediction("B", 1)])
    run()
    assert rows(sinks.latest_counts(spark, path)) == [("A", "3"), ("B", "2"), ("C", "1")]


def test_previews(spark, topic, tmp_path, capsys):
    topic([article(i) for i in range(5)])
    parsed = jobs.parsed_articles(topic.stream())
    path = str(tmp_path / "p")
    sinks.run_bounded(
        sinks.to_preview_table(parsed, path, str(tmp_path / "c"), [F.col("offset")], 2)
    )
    assert {r["title"] for r in sinks.read_table(spark, path, ARTICLE).collect()} == {"t0", "t1"}
    sinks.run_bounded(sinks.to_console(parsed, str(tmp_path / "c3"), 1))
    assert "t0" in capsys.readouterr().out


def test_timed_stop_lets_the_running_batch_end(spark, topic, tmp_path):
    for t in "ABC":
        topic([prediction(t, 1)])
    table, check = str(tmp_path / "scores"), str(tmp_path / "c")
    begun = []

    def slow(batch):
        begun.append(1)
        time.sleep(2)
        return batch

    def run(timeout):
        stream = jobs.scaled_scores(topic.stream())
        sinks.run_bounded(sinks.to_table(stream, table, check, per_batch=slow), timeout)

    run(1.0)
    stored = sinks.read_table(spark, table, SCORE).count()
    assert 1 <= stored <= 2 and stored >= len(begun) - 1
    run(None)
    assert sorted(r["ticker"] for r in sinks.read_table(spark, table, SCORE).collect()) == list("ABC")
