import numpy as np
import pytest
from pyspark.sql import functions as F

from tickerpulse.operators import models, sentiment
from tickerpulse.plans import queries as q
from tickerpulse.sources import tables


@pytest.fixture(scope="module")
def toy(spark):
    words = {0: "loss drop fall", 1: "meeting agenda room", 2: "gain rise profit"}
    data = [(i, words[i % 3] + f" filler{i}", i % 3, i % 2) for i in range(60)]
    return spark.createDataFrame(data, "doc_id long, article string, class int, Label int")


def test_linear_scorer_learns_and_matches_spark(spark, toy):
    weights, bias = models.fit_linear_weights(toy, buckets=256)
    rows = sentiment.with_sentiment(toy, sentiment.linear_scorer(weights, bias)).collect()
    names = {0: "negative", 1: "neutral", 2: "positive"}
    assert sum(r["sentiments"] == names[r["class"]] for r in rows) >= 55
    hashed = toy.select("doc_id", sentiment.hashed_buckets("article", 256).alias("b")).collect()
    for r, h in zip(sorted(rows), sorted(hashed)):
        want = weights[:, h["b"]].sum(axis=1) + bias
        assert np.allclose(r["logits"], want)


def test_scorer_is_loaded_per_task_and_skips_nulls(spark):
    def load():
        return lambda texts: np.array([[len(t), 0.0, 1.5] for t in texts])

    df = spark.createDataFrame([("abcd",), (None,), ("",)], "article string")
    got = sentiment.with_sentiment(df, load).collect()
    assert [r["sentiments"] for r in got] == ["negative", None, "positive"]
    assert got[1]["logits"] is None


def test_registered_function(spark):
    sentiment.register_text_function(spark, "text_length", len, "bigint")
    assert spark.sql("SELECT text_length('abc') AS n").first()["n"] == 3


def test_forest_and_saved_model(spark, toy, tmp_path):
    forest = models.bigram_forest(trees=5, depth=4, features=256).fit(toy)
    rows = forest.transform(toy).select("prediction").collect()
    assert len(rows) == 60 and {r[0] for r in rows} <= {0.0, 1.0}
    with pytest.raises(Exception):
        models.bigram_forest(trees=1, depth=31, features=16).fit(toy)
    model = models.text_classifier(256).fit(toy.withColumnRenamed("Label", "unused"))
    path = str(tmp_path / "model")
    models.save_model(model, path)
    models.save_model(model, path)
    again = models.load_model(path)
    nulls = toy.select("doc_id", F.lit(None).cast("string").alias("article"))
    assert again.transform(nulls).count() == 60
    left, right = (m.transform(toy).select("prediction").collect() for m in (model, again))
    assert left == right
    assert sum(r["prediction"] == r["class"] for r in again.transform(toy).collect()) >= 55


def test_linear_score_features_have_length_one(spark, toy):
    model = models.linear_score_model(toy, "Label", features=256, max_iter=5)
    for r in model.transform(toy).select("features", "sentiment_score").collect():
        assert r["features"].norm(2) == pytest.approx(1.0)
        assert -1 < r["sentiment_score"] < 2


def test_embedding_head(spark):
    data = [([float(i % 2), 1.0 - i % 2, 0.5], i % 2) for i in range(40)]
    df = models.as_vector(spark.createDataFrame(data, "embedding array<float>, label int"))
    head = models.embedding_head(df, 3)
    right = head.transform(df).filter("prediction = label").count()
    assert right >= 36


def test_streamed_predictions_equal_batch(spark, small):
    batch = {r["doc_id"]: r["class"] for r in q.ml_model_roundtrip(spark, small).collect()}
    stream = {r["doc_id"]: r["class"] for r in q.stream_predictions(spark, small).collect()}
    assert batch == stream and len(batch) == tables.documents(spark, small).count()


def test_forest_query_runs_the_default_size(spark, small, monkeypatch):
    from tickerpulse.plans import queries

    class Asked(Exception):
        pass

    def seen(*sizes, **named):
        raise Asked(sizes, named)

    monkeypatch.setattr(queries.models, "bigram_forest", seen)
    with pytest.raises(Asked) as asked:
        queries.ml_random_forest(spark, small)
    assert asked.value.args == ((), {})
