import json

from pyspark.sql import functions as F

from tickerpulse.sources import messages as msg
from tickerpulse.streaming import jobs

GOOD = {"title": "T", "article": 'say "hi"\nété'}
VALUES = [
    json.dumps(GOOD),
    json.dumps(json.dumps(GOOD)),
    "{",
    "",
    None,
    json.dumps([GOOD]),
    json.dumps({"title": "only"}),
    json.dumps({"title": "T", "article": {"nested": 1}}),
    json.dumps("just text"),
]


def frame(spark):
    rows = [(i, None if v is None else v.encode()) for i, v in enumerate(VALUES)]
    return spark.createDataFrame(rows, "id int, value binary")


def test_decode_is_permissive(spark):
    rows = {r["id"]: (r["title"], r["article"]) for r in msg.decode(frame(spark), keep=["id"]).collect()}
    assert len(rows) == len(VALUES)
    assert rows[0] == ("T", GOOD["article"])
    assert all(rows[i] == (None, None) for i in (1, 2, 3, 4, 8))
    assert rows[6] == ("only", None)
    assert rows[7][0] == "T"


def test_tolerant_decode_reads_double_encoding(spark):
    rows = msg.decode(frame(spark), keep=["id"], tolerant=True)
    got = {r["id"]: (r["title"], r["article"]) for r in rows.collect()}
    assert got[0] == got[1] == ("T", GOOD["article"])
    assert got[8] == (None, None)


def test_dead_letters_complement_the_readable_rows(spark):
    dead = {r["id"]: r["raw"] for r in msg.dead_letters(frame(spark), keep=["id"], tolerant=True).collect()}
    good = msg.decode(frame(spark), keep=["id"], tolerant=True).filter(~msg.undecodable())
    kept = {r["id"] for r in good.collect()}
    assert kept & set(dead) == set() and kept | set(dead) == set(range(len(VALUES)))
    assert dead[2] == "{" and dead[4] is None


def test_reasons(spark):
    values = ['{"title":null,"article":null}', '{"title":null}', "{}", '{"headline":"x"}', "nonsense", "7", None]
    rows = [(i, None if v is None else v.encode()) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "id int, value binary")
    dead = msg.dead_letters(df, keep=["id"], tolerant=True, with_reason=True)
    assert {r["id"]: r["reason"] for r in dead.collect()} == {
        2: "no known field", 3: "no known field", 4: "unreadable", 5: "unreadable", 6: "null message",
    }
    kept = msg.readable(df, keep=["id"], tolerant=True)
    assert kept.columns == ["id", "title", "article"]
    assert sorted(r["id"] for r in kept.collect()) == [0, 1]


def test_encode_keeps_null_fields(spark):
    df = spark.createDataFrame([("T", None)], "title string, article string")
    assert json.loads(df.select(msg.encode(df)).first()[0]) == {"title": "T", "article": None}


def test_envelope_round_trip(spark):
    df = spark.createDataFrame([(1, "T", 'a"b\\c\n')], "doc_id long, title string, article string")
    sent = msg.to_messages(df, ["title", "article"], "news", F.col("doc_id"))
    assert [f.name for f in sent.schema] == [f.name for f in msg.ENVELOPE]
    assert msg.decode(sent, keep=["offset"]).collect()[0] == (1, "T", 'a"b\\c\n')


def test_ticker_is_an_optional_field(spark):
    values = [(b'{"title":"T","article":"a","ticker":"AMZN"}', 1), (b'{"title":"U"}', 2)]
    df = spark.createDataFrame(values, "value binary, offset long")
    got = jobs.parsed_articles(df, with_ticker=True).collect()
    assert [(r["title"], r["ticker"]) for r in got] == [("T", "AMZN"), ("U", None)]
    assert "ticker" not in jobs.parsed_articles(df).columns


def test_kafka_options():
    assert msg.kafka_options("h:9092", "news", "earliest") == {
        "kafka.bootstrap.servers": "h:9092",
        "subscribe": "news",
        "startingOffsets": "earliest",
    }
