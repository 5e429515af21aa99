"""The command-line jobs, chained over files."""

import json

import pytest
from pyspark.sql import functions as F

from tickerpulse.__main__ import main, target, topic
from tickerpulse.schemas import HEADLINE_COLUMNS, SCORE
from tickerpulse.sources import messages as msg
from tickerpulse.streaming import sinks


def test_topic_addresses():
    assert topic("kafka:h1:9092,h2:9092/news", "latest") == (
        "kafka",
        {"kafka.bootstrap.servers": "h1:9092,h2:9092", "subscribe": "news", "startingOffsets": "latest"},
    )
    assert target("kafka:h:9092/out")[1] == {"kafka.bootstrap.servers": "h:9092", "topic": "out"}
    assert topic("/data/topic") == ("parquet", {"path": "/data/topic"})


def run(spark, *words):
    main([str(w) for w in words], spark)


def test_from_search_to_labels(spark, tmp_path):
    hits = [(i, f"AMZN news {i}", f"u{i}", "en") for i in range(1, 6)]
    spark.createDataFrame(hits, "rank long, title string, url string, lang string").withColumn(
        "ts", F.lit("2024-03-14 00:00:00").cast("timestamp_ntz")
    ).write.parquet(str(tmp_path / "hits"))
    words = ["profit rise", "", "loss drop", "profit gain", "loss fall"]
    pages = [(i, f"u{i}", f"<article>{w}</article>") for i, w in enumerate(words, 1)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(
        str(tmp_path / "pages")
    )
    run(
        spark, "publish", "--hits", tmp_path / "hits", "--pages", tmp_path / "pages", "--symbol",
        "amzn", "--count", 3, "--as-of", "2024-03-15 00:00:00", "--topic", tmp_path / "topic",
    )
    sent = [json.loads(r["value"]) for r in spark.read.parquet(str(tmp_path / "topic")).collect()]
    assert sorted(m["article"] for m in sent) == ["loss drop", "profit gain", "profit rise"]
    assert {m["ticker"] for m in sent} == {"amzn"}

    for _ in range(2):
        run(
            spark, "ingest", "--topic", tmp_path / "topic", "--out", tmp_path / "articles",
            "--checkpoint", tmp_path / "c1", "--timeout", 60,
        )
    assert spark.read.parquet(str(tmp_path / "articles")).count() == 3

    bad = spark.createDataFrame([(b"{", 9)], "value binary, offset long")
    full = [
        F.col(f.name) if f.name in bad.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in msg.ENVELOPE
    ]
    msg.write_messages(bad.select(*full), {"path": str(tmp_path / "topic")}, "parquet")
    run(
        spark, "ingest", "--topic", tmp_path / "topic", "--out", tmp_path / "clean",
        "--checkpoint", tmp_path / "c3", "--dead-letters", tmp_path / "dead",
    )
    assert spark.read.parquet(str(tmp_path / "clean")).count() == 3
    assert [r["raw"] for r in spark.read.parquet(str(tmp_path / "dead")).collect()] == ["{"]

    rows = [("profit rise gain", 2), ("loss drop fall", 0), ("plain report", 1)] * 10
    spark.createDataFrame(rows, "article string, class int").write.parquet(str(tmp_path / "labelled"))
    run(spark, "train", "--labelled", tmp_path / "labelled", "--model", tmp_path / "model")
    run(
        spark, "label", "--articles", tmp_path / "articles", "--model", tmp_path / "model",
        "--out", tmp_path / "out",
    )
    got = {r["article"]: r["sentiments"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {"profit rise": "positive", "loss drop": "negative", "profit gain": "positive"}


def test_symbol_from_article_to_counts(spark, tmp_path, capsys):
    """The symbol of a message is still there in the scores of its sentiment."""
    texts = [("AMZN", "profit rise"), ("AMZN", "loss drop"), ("MSFT", "profit gain"), (None, "loss fall")]
    articles = spark.createDataFrame([("t", a, s) for s, a in texts], "title string, article string, ticker string")
    msg.write_messages(
        msg.to_messages(articles, articles.columns, "news"), {"path": str(tmp_path / "topic")}, "parquet"
    )
    run(
        spark, "ingest", "--topic", tmp_path / "topic", "--out", tmp_path / "articles",
        "--checkpoint", tmp_path / "c1", "--dead-letters", tmp_path / "dead",
    )
    rows = [("profit rise gain", 2), ("loss drop fall", 0), ("plain report", 1)] * 10
    spark.createDataFrame(rows, "article string, class int").write.parquet(str(tmp_path / "labelled"))
    run(spark, "train", "--labelled", tmp_path / "labelled", "--model", tmp_path / "model")
    run(
        spark, "label", "--articles", tmp_path / "articles", "--model", tmp_path / "model",
        "--out", tmp_path / "out", "--predictions", tmp_path / "predictions",
    )
    run(spark, "scale", "--topic", tmp_path / "predictions", "--to", tmp_path / "scaled", "--checkpoint", tmp_path / "c2")
    run(spark, "store", "--topic", tmp_path / "scaled", "--out", tmp_path / "scores", "--checkpoint", tmp_path / "c3")
    stored = sinks.read_table(spark, str(tmp_path / "scores"), SCORE).collect()
    assert sorted((r["ticker"], r["aggregated_score"]) for r in stored) == [
        ("AMZN", -10.0), ("AMZN", 10.0), ("MSFT", 10.0),
    ]
    assert "AMZN" in capsys.readouterr().out


def test_scale_and_store(spark, tmp_path, capsys):
    events = spark.createDataFrame([("A", 0.5), ("A", 1.0)], "ticker string, sentiment_prediction double")
    sent = msg.to_messages(events, events.columns, "p")
    msg.write_messages(sent, {"path": str(tmp_path / "p")}, "parquet")
    run(
        spark, "scale", "--topic", tmp_path / "p", "--to", tmp_path / "s",
        "--checkpoint", tmp_path / "c1",
    )
    run(
        spark, "store", "--topic", tmp_path / "s", "--out", tmp_path / "t",
        "--checkpoint", tmp_path / "c2",
    )
    stored = sinks.read_table(spark, str(tmp_path / "t"), SCORE).collect()
    assert sorted(r["aggregated_score"] for r in stored) == [5.0, 10.0]
    assert "ticker" in capsys.readouterr().out


@pytest.mark.parametrize("multi_line", [True, False])
def test_headline_csv_quirks(spark, tmp_path, multi_line):
    from tickerpulse.sources.tables import read_headlines_csv

    cells = ['"say ""hi"", é"', ""] + ["x"] * 23
    text = ",".join(["Date", "Label", *HEADLINE_COLUMNS]) + "\n"
    text += ",".join(["20141231", "1", *cells]) + "\n"
    (tmp_path / "d.csv").write_bytes(text.encode("latin-1"))
    row = read_headlines_csv(spark, str(tmp_path / "d.csv"), multi_line=multi_line).first()
    assert (row["Label"], row["Top1"], row["Top2"], row["Top3"]) == (1, 'say "hi", é', None, "x")


def test_evaluation_job(spark, tmp_path, capsys):
    lines = [",".join(["Date", "Label", *HEADLINE_COLUMNS])]
    for i in range(40):
        year, good = ("2014", "2015")[i >= 30], i % 2
        words = ["profit did rise", "loss did grow"][1 - good]
        lines.append(",".join([f"{year}0101", str(good), *[words] * 25]))
    (tmp_path / "d.csv").write_text("\n".join(lines))
    run(
        spark, "evaluate", "--headlines", tmp_path / "d.csv", "--trees", 5, "--depth", 3,
        "--features", 256,
    )
    out = capsys.readouterr().out
    assert "macro avg" in out and "|     1.0|" in out
