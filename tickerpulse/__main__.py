"""Jobs for spark-submit.

    python -m tickerpulse publish --hits H --pages P --symbol AMZN --count 5 --as-of TIME --topic ...
    python -m tickerpulse ingest  --topic ... --out articles --checkpoint C
    python -m tickerpulse train   --labelled L --model M
    python -m tickerpulse label   --articles articles --model M --out labelled --predictions ...
    python -m tickerpulse scale   --topic ... --to ... --checkpoint C
    python -m tickerpulse store   --topic ... --out scores --checkpoint C
    python -m tickerpulse evaluate --headlines data.csv

``--topic`` and ``--to`` take ``kafka:SERVERS/NAME`` (needs Spark's Kafka connector) or the path of
a folder of message files.  Streaming jobs process what is there and stop; any outside scheduler
can repeat them, and their checkpoint makes them go on where they stopped.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.scores import class_name
from .operators import articles as art
from .operators import evaluate, headlines, models, subwords
from .schemas import TICKER_ARTICLE
from .session import build_session
from .sources import messages as msg
from .sources import pages as pg
from .sources import tables
from .streaming import jobs, sinks


def topic(address: str, start: str | None = None) -> tuple[str, dict[str, str]]:
    """(format, reader options) of a topic address."""
    if address.startswith("kafka:"):
        servers, name = address.removeprefix("kafka:").rsplit("/", 1)
        return "kafka", msg.kafka_options(servers, name, start)
    return "parquet", {"path": address}


def target(address: str) -> tuple[str, dict[str, str]]:
    """(format, writer options) of a topic address."""
    fmt, options = topic(address)
    if fmt == "kafka":
        options["topic"] = options.pop("subscribe")
    return fmt, options


def publish(spark: SparkSession, args: argparse.Namespace) -> None:
    """Search stored hits for a symbol, attach page texts, send them as messages."""
    hits = spark.read.schema(
        "rank bigint, title string, url string, lang string, ts timestamp_ntz"
    ).parquet(args.hits)
    pages = tables.read_parquet(spark, args.pages, tables.schemas.PAGES)
    found = pg.matching_hits(hits, args.symbol, args.as_of)
    chosen = art.top_articles(found, pages, args.count).withColumn("ticker", F.lit(args.symbol))
    fmt, options = target(args.topic)
    sent = msg.to_messages(chosen, ["title", "article", "ticker"], args.symbol, F.col("rank"))
    msg.write_messages(sent.select("key", "value") if fmt == "kafka" else sent, options, fmt)


def ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    """Article messages, with the symbol they were found for, to a Parquet table.

    Unreadable messages stay as rows of nulls, or go with the reason to a table of their own if one
    is named.
    """
    fmt, options = topic(args.topic, args.start)
    stream = msg.stream_topic(spark, options, fmt)
    fields = TICKER_ARTICLE.fieldNames()
    parsed = jobs.parsed_articles(stream, tolerant=True, with_ticker=True).select(*fields)
    if args.dead_letters:
        parsed = msg.readable(stream, TICKER_ARTICLE, tolerant=True).select(*fields)
        dead = msg.dead_letters(
            stream, TICKER_ARTICLE, keep=["offset"], tolerant=True, with_reason=True
        )
        writer = sinks.to_parquet(dead, args.dead_letters, f"{args.checkpoint}/dead-letters")
        sinks.run_bounded(writer, args.timeout)
    sinks.run_bounded(
        sinks.to_parquet(parsed, args.out, f"{args.checkpoint}/articles"), args.timeout
    )


def train(spark: SparkSession, args: argparse.Namespace) -> None:
    """Fit the three-class model on (article, class) rows."""
    rows = spark.read.schema("article string, class int").parquet(args.labelled)
    models.save_model(models.text_classifier().fit(rows), args.model)


def label(spark: SparkSession, args: argparse.Namespace) -> None:
    """Add the sentiment of each article.

    With ``--predictions`` each article with a symbol also becomes a message for ``scale``: -1, 0 or
    1 for negative, neutral and positive.  With ``--vocabulary`` the model sees only the words whose
    pieces fit into ``--max-length`` ids; the articles are stored whole.
    """
    rows = tables.read_parquet(spark, args.articles, TICKER_ARTICLE)
    model = models.load_model(args.model)
    if args.vocabulary:
        pieces = subwords.read_vocabulary(args.vocabulary)
        mark = max(pieces.values(), default=0) + 1
        rows = subwords.within_limit(rows, pieces, mark, max_length=args.max_length)
        rows = rows.withColumnsRenamed({"article": "whole_article", "model_text": "article"})
        scored = model.transform(rows).drop("article").withColumnRenamed("whole_article", "article")
    else:
        scored = model.transform(rows)
    named = class_name(F.col("prediction").cast("int")).alias("sentiments")
    scored.select("title", "article", named, "ticker", "prediction").write.parquet(args.out)
    if args.predictions:
        stored = spark.read.schema("ticker string, prediction double").parquet(args.out)
        value = (F.col("prediction") - 1).alias("sentiment_prediction")
        known = stored.filter("ticker IS NOT NULL AND prediction IS NOT NULL").select("ticker", value)
        fmt, options = target(args.predictions)
        sent = msg.to_messages(known, known.columns, "predictions")
        msg.write_messages(sent.select("key", "value") if fmt == "kafka" else sent, options, fmt)


def scale(spark: SparkSession, args: argparse.Namespace) -> None:
    """Predictions to scaled scores, topic to topic."""
    fmt, options = topic(args.topic, args.start)
    scaled = jobs.scaled_scores(msg.stream_topic(spark, options, fmt))
    to_fmt, to_options = target(args.to)
    fields = ["ticker", "aggregated_score"]
    writer = sinks.to_topic(scaled, fields, to_options, args.checkpoint, to_fmt)
    sinks.run_bounded(writer, args.timeout)


def store(spark: SparkSession, args: argparse.Namespace) -> None:
    """Scaled scores to a table; prints the counts a dashboard would show."""
    fmt, options = topic(args.topic, args.start)
    if fmt == "kafka":
        stream = msg.stream_topic(spark, options, fmt)
    else:
        stream = spark.readStream.schema("value string").parquet(options["path"])
    sinks.run_bounded(sinks.to_table(jobs.scores(stream), args.out, args.checkpoint), args.timeout)
    table = sinks.read_table(spark, args.out, tables.schemas.SCORE)
    jobs.score_count(table).show()
    jobs.score_count_by_ticker(table).orderBy(F.desc("count"), "ticker").limit(20).show()


def evaluate_headlines(spark: SparkSession, args: argparse.Namespace) -> None:
    """Fit the bigram forest on the early headlines and report on the late ones."""
    rows = tables.read_headlines_csv(spark, args.headlines)
    train_rows, test_rows = headlines.train_and_test_texts(rows, "Label", typed=args.typed_dates)
    forest = models.bigram_forest(args.trees, args.depth, args.features).fit(train_rows)
    result: DataFrame = forest.transform(test_rows).select(
        F.col("Label").alias("label"), F.col("prediction").cast("int")
    )
    evaluate.confusion(result).orderBy("label", "prediction").show()
    evaluate.accuracy(result).show()
    evaluate.report(result).orderBy("class").show()
    evaluate.report_averages(result).show()


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tickerpulse")
    commands = top.add_subparsers(dest="command", required=True)

    def command(name, run, *needed, **optional):
        sub = commands.add_parser(name, help=run.__doc__)
        sub.set_defaults(run=run)
        for option in needed:
            sub.add_argument(f"--{option}", required=True)
        for option, (kind, default) in optional.items():
            sub.add_argument(f"--{option.replace('_', '-')}", type=kind, default=default)
        return sub

    stream = {"start": (str, "earliest"), "timeout": (float, None)}
    command(
        "publish", publish, "hits", "pages", "symbol", "as-of", "topic", count=(int, 5)
    )
    command("ingest", ingest, "topic", "out", "checkpoint", dead_letters=(str, None), **stream)
    command("train", train, "labelled", "model")
    command(
        "label", label, "articles", "model", "out", predictions=(str, None),
        vocabulary=(str, None), max_length=(int, subwords.MAX_LENGTH),
    )
    command("scale", scale, "topic", "to", "checkpoint", **stream)
    command("store", store, "topic", "out", "checkpoint", **stream)
    command(
        "evaluate",
        evaluate_headlines,
        "headlines",
        trees=(int, models.FOREST_TREES),
        depth=(int, models.MAX_TREE_DEPTH),
        features=(int, 1 << 18),
    ).add_argument("--typed-dates", action="store_true")
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(spark or build_session(f"tickerpulse-{args.command}"), args)


if __name__ == "__main__":
    main()
