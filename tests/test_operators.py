import math
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tickerpulse.workspace import SHUFFLE_CLEANUP, as_table
from tickerpulse.functions import text
from tickerpulse.operators import articles as art
from tickerpulse.operators import evaluate, features, headlines, joins
from tickerpulse.operators.joins import fits_broadcast, join_by_weight
from tickerpulse.operators.ordering import top_per_key, with_position
from tickerpulse.schemas import HEADLINE_COLUMNS
from tickerpulse.sources import pages as pg


def rows(df):
    return sorted(tuple(r) for r in df.collect())


# --- joins and ordering -------------------------------------------------------------------------


def skewed(spark, n=900):
    """A third of the rows share one key."""
    return spark.range(n).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k")
    )


@pytest.mark.parametrize("limits", [{}, {"rows": 10, "hot_rows": 10}, {"rows": 1, "hot_rows": 1}])
def test_join_by_weight_is_a_plain_join(spark, limits):
    facts = skewed(spark)
    dim = facts.groupBy("k").agg(F.count("*").alias("n"))
    got = join_by_weight(facts, dim, "k", "n", **limits)
    assert rows(got.select("id", "k", "n")) == rows(facts.join(dim, "k").select("id", "k", "n"))


def test_join_by_weight_keeps_hot_rows_in_place(spark):
    facts = skewed(spark)
    dim = facts.groupBy("k").agg(F.count("*").alias("n"))
    plan = join_by_weight(facts, dim, "k", "n", rows=10, hot_rows=10)._jdf.queryExecution().toString()
    assert "LeftAnti" in plan and "Union" in plan


def test_split_join_makes_its_facts_once(spark):
    made = spark.sparkContext.accumulator(0)
    schema = "id long, k string"

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    facts = skewed(spark).mapInArrow(count, schema)
    dim = skewed(spark).groupBy("k").agg(F.count("*").alias("n"))
    assert join_by_weight(facts, dim, "k", "n", rows=10, hot_rows=10).count() == 900
    assert made.value == 900


def test_join_without_heavy_keys_is_one_pass(spark):
    facts = spark.range(1000).select("id", (F.col("id") % 200).cast("string").alias("k"))
    dim = facts.groupBy("k").agg(F.count("*").alias("n"))
    joined = join_by_weight(facts, dim, "k", "n", rows=10)
    plan = joined._jdf.queryExecution().toString()
    assert "LeftAnti" not in plan and "Union" not in plan
    assert rows(joined) == rows(facts.join(dim, "k"))


def counted_docs(spark):
    """Three documents, one id twice, and the number of texts that were cut so far."""
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    docs = [(1, ["b", "a", "b"]), (2, ["a", "running", "runs"]), (2, ["b", "c"]), (None, ["c"])]
    schema = "doc_id int, tokens array<string>"
    return spark.createDataFrame(docs, schema).mapInArrow(count, schema), made


@pytest.mark.parametrize("l2", [False, True])
def test_corpus_weights_cut_its_texts_once(spark, l2):
    docs, made = counted_docs(spark)

    def weights(df):
        return sorted((str(r["doc_id"]), r["term"], round(r["weight"], 9)) for r in df.collect())

    want = weights(features.fit_idf(docs, "tokens").transform(docs, "smooth", l2=l2))
    before = made.value
    model = features.fit_idf(docs, "tokens", "doc_id")
    assert weights(model.transform(docs, "smooth", l2=l2, rows=0)) == want
    # Once for the terms and once to count the documents.
    assert made.value - before == 2 * 4
    # Other documents, or another key, are counted anew.
    other = docs.filter("doc_id = 1")
    assert {r["doc_id"] for r in model.transform(other).collect()} == {1}


def many_terms(spark, n=12):
    """Documents of over a hundred terms each, most of them rare; an id that comes twice, one that is
    null, null terms and documents without terms."""
    docs = [
        (None if i == 3 else i // 2, [f"w{i * 90 + j}" for j in range(130)] + ["all", "all", None])
        for i in range(n)
    ]
    return spark.createDataFrame([*docs, (n, []), (n + 1, None)], "doc_id int, tokens array<string>")


def shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    names = manager.getAllFiles().mkString("\n").split("\n")
    return {name for name in names if "/shuffle_" in name}


@pytest.mark.parametrize("slice_rows", [1 << 22, 400, 1])
@pytest.mark.parametrize("l2", [False, True])
def test_weights_by_term_are_those_of_a_join(spark, monkeypatch, slice_rows, l2):
    monkeypatch.setattr(features, "SLICE_ROWS", slice_rows)
    docs = many_terms(spark)

    def weights(df):
        return sorted((str(r["doc_id"]), r["term"], round(r["weight"], 9)) for r in df.collect())

    old = features.fit_idf(docs, "tokens", "doc_id")
    new = features.fit_idf(docs, "tokens", "doc_id", by_term=True)
    assert new.by_term and new.n_docs == 14
    found = new.transform(docs, "smooth", l2=l2, rows=0)
    assert weights(found) == weights(old.transform(docs, "smooth", l2=l2, rows=0))
    # The counts come with their frequencies: what a join would shuffle need not lie on the disk.
    assert ("Exchange" in found._jdf.queryExecution().executedPlan().toString()) == l2
    assert Counter(map(tuple, new.table.collect())) == Counter(map(tuple, old.table.collect()))
    other = spark.createDataFrame([(5, ["w95", "no", "all", "w0"])], docs.schema)
    assert weights(new.transform(other, l2=l2)) == weights(old.transform(other, l2=l2))


def test_counts_by_term_leave_no_shuffle_files(spark, monkeypatch):
    monkeypatch.setattr(features, "SLICE_ROWS", 400)
    before = shuffle_files(spark)
    model = features.fit_idf(many_terms(spark), "tokens", "doc_id", by_term=True)
    end = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < end:
        time.sleep(0.2)
    assert not left and model.counts.count() == 12 * 132
    assert spark.conf.get(SHUFFLE_CLEANUP) == "false"


def test_terms_that_may_be_heavy_are_joined(spark):
    """In documents of few terms one term may hold many of the rows, too many for one task."""
    docs = spark.createDataFrame([(i, ["all", f"w{i}"]) for i in range(50)], "doc_id int, tokens array<string>")
    model = features.fit_idf(docs, "tokens", "doc_id", by_term=True)
    assert not model.by_term and model.counts.columns == ["doc_id", "term", "tf"]
    assert rows(model.transform(docs, "log1p", rows=1)) == rows(
        features.fit_idf(docs, "tokens").transform(docs, "log1p")
    )
    for nothing in (docs.limit(0), docs.withColumn("tokens", F.array().cast("array<string>"))):
        empty = features.fit_idf(nothing, "tokens", "doc_id", by_term=True)
        assert empty.transform(nothing).count() == 0 and empty.table.count() == 0


def test_stems_cut_texts_once(spark):
    docs, made = counted_docs(spark)
    got = [tuple(r) for r in features.stemmed_counts(docs, "tokens").collect()]
    assert (2, "running", "run", 1) in got and (2, "runs", "run", 1) in got
    assert made.value == 4


def test_marked_never_loses_a_match(spark):
    facts = spark.range(3000).select(
        F.when(F.col("id") % 7 != 0, F.col("id")).alias("id"), F.lit("x").alias("_row")
    )
    keys = as_table(spark.sql("SELECT id * 50 AS id FROM range(40) UNION ALL SELECT NULL"), "keys")
    marked = joins.marked(facts, keys, ["id"], "mark")
    assert marked.columns == ["id", "_row", "mark"] and marked.count() == 3000
    found = marked.filter("mark")
    assert found.join(keys, "id").count() == facts.join(keys, "id").count()
    assert found.filter("id IS NULL").count() == facts.filter("id IS NULL").count()
    assert found.count() < 1000
    nothing = as_table(keys.limit(0), "keys")
    assert joins.narrowed(facts, nothing, ["id"]).count() == 0


def test_join_by_weight_drops_unknown_keys(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "a"), (3, "no")], "id int, k string")
    dim = spark.createDataFrame([("a", 2)], "k string, n long")
    assert rows(join_by_weight(facts, dim, "k", "n", rows=0, hot_rows=5).select("id")) == [(1,), (2,)]


def test_join_by_weight_with_heavy_keys_too_wide_to_broadcast(spark, monkeypatch):
    monkeypatch.setattr(joins, "fits_broadcast", lambda *args: False)
    facts = spark.createDataFrame([(i, "x" * 2000) for i in range(5)], "id int, k string")
    dim = spark.createDataFrame([("x" * 2000, 5)], "k string, n long")
    joined = join_by_weight(facts, dim, "k", "n", rows=0, hot_rows=5)
    assert "LeftAnti" not in joined._jdf.queryExecution().toString()
    assert joined.count() == 5


def test_fits_broadcast_measures(spark):
    df = spark.range(100)
    assert fits_broadcast(df) and not fits_broadcast(df, rows=99) and not fits_broadcast(df, size=100)
    assert fits_broadcast(df.filter("id < 0"), rows=0)


@pytest.mark.parametrize("slices", [1, 2, 64])
def test_top_per_key(spark, slices):
    df = skewed(spark).repartition(7)
    got = top_per_key(df, "k", [F.desc("id")], 3, slices)
    want = {}
    for r in df.collect():
        want.setdefault(r["k"], []).append(r["id"])
    assert rows(got) == sorted((i, k) for k, v in want.items() for i in sorted(v)[-3:])
    assert "WindowGroupLimit" in got._jdf.queryExecution().toString()


def test_positions_are_dense_and_ordered(spark):
    df = spark.range(500).select(((F.col("id") * 37) % 500).alias("v")).repartition(9)
    got = with_position(df, [F.col("v")], "pos").collect()
    assert sorted((r["v"], r["pos"]) for r in got) == [(i, i) for i in range(500)]
    assert with_position(df.filter("v < 0"), [F.col("v")], "pos").count() == 0


# --- features -----------------------------------------------------------------------------------

CORPUS = [(1, "the cat the hat"), (2, "the dog"), (3, None), (4, "")]


def corpus(spark):
    df = spark.createDataFrame(CORPUS, "doc_id long, article string")
    return df.withColumn("tokens", text.tokens_word("article"))


def counted():
    return {d: Counter((t or "").split()) for d, t in CORPUS}


def test_term_and_document_frequency(spark):
    want = sorted((d, t, n) for d, c in counted().items() for t, n in c.items())
    assert rows(features.term_freq(corpus(spark), "tokens")) == want
    df = Counter(t for c in counted().values() for t in c)
    assert rows(features.doc_freq(corpus(spark), "tokens")) == sorted(df.items())


@pytest.mark.parametrize(
    "formula, idf",
    [
        ("log1p", lambda n, d: math.log(1 + n / (1 + d))),
        ("smooth", lambda n, d: math.log((1 + n) / (1 + d)) + 1),
        ("spark", lambda n, d: math.log((n + 1) / (d + 1))),
    ],
)
@pytest.mark.parametrize("l2", [False, True])
def test_tfidf(spark, formula, idf, l2):
    counts, df = counted(), Counter(t for c in counted().values() for t in c)
    want = {}
    for d, c in counts.items():
        w = {t: n * idf(len(CORPUS), df[t]) for t, n in c.items()}
        norm = math.sqrt(sum(x * x for x in w.values())) if l2 else 1.0
        want.update({(d, t): x / norm for t, x in w.items()})
    model = features.fit_idf(corpus(spark), "tokens")
    got = {(r[0], r[1]): r[2] for r in model.transform(corpus(spark), formula, l2).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_model_ignores_unseen_terms(spark):
    model = features.fit_idf(corpus(spark), "tokens")
    other = spark.createDataFrame([(9, ["cat", "bird"])], "doc_id long, tokens array<string>")
    assert [r["term"] for r in model.transform(other).collect()] == ["cat"]


def test_bag_of_terms_uses_the_alphabetical_train_vocabulary(spark):
    train = spark.createDataFrame([(1, ["b", "a"]), (2, ["c"])], "doc_id long, tokens array<string>")
    other = spark.createDataFrame([(9, ["c", "z", "a", "c"])], "doc_id long, tokens array<string>")
    assert rows(features.bag_of_terms(train, other, "tokens")) == [(9, 0, 1), (9, 2, 2)]


def test_features_join_keeps_articles_without_features(spark):
    base = corpus(spark)
    weights = features.fit_idf(base, "tokens").transform(base)
    joined = features.attach_features(base.select("doc_id"), weights)
    assert {r["doc_id"] for r in joined.filter("term is null").collect()} == {3, 4}


def test_stemmed_counts(spark):
    docs = spark.createDataFrame([(1, ["cats", "cats", "ponies"])], "doc_id long, tokens array<string>")
    assert rows(features.stemmed_counts(docs, "tokens")) == [
        (1, "cats", "cat", 2),
        (1, "ponies", "poni", 1),
    ]


def test_weights_over_stems(spark):
    """Words of one stem count together, in documents and in document frequencies."""
    docs = spark.createDataFrame(
        [(1, ["cats", "cat", "cats", "dog"]), (2, ["cat"]), (3, None)], "doc_id long, tokens array<string>"
    )
    model, counts = features.stemmed_idf(docs, "tokens")
    assert rows(counts) == [(1, "cat", 3), (1, "dog", 1), (2, "cat", 1)]
    got = {r[:2]: r[2] for r in map(tuple, model.weigh(counts, "log1p").collect())}
    assert abs(got[1, "cat"] - 3 * math.log(1 + 3 / 3)) < 1e-12
    assert abs(got[1, "dog"] - math.log(1 + 3 / 2)) < 1e-12
    other = spark.createDataFrame([(9, ["catting", "bird", "cats"])], "doc_id long, tokens array<string>")
    weighed = model.weigh(features.stem_freq(other, "tokens"), "log1p").collect()
    assert [(r["doc_id"], r["term"]) for r in weighed] == [(9, "cat")]


def test_label_index_orders_by_frequency_then_name(spark):
    labels = ["b", "a", "c", "c", None]
    df = spark.createDataFrame(list(enumerate(labels)), "id long, label string")
    got = {(r["label"], r["label_index"]) for r in features.label_index(df, "label").collect()}
    assert got == {("c", 0), ("a", 1), ("b", 2)}


# --- headlines ----------------------------------------------------------------------------------


def headline_frame(spark):
    dates = ["20141231", "20150101", "2015-01-02", "2014-12-31", "junk"]
    cells = ["A1!", None, "Été"] + [None] * 22
    data = [(d, 1, *cells) for d in dates]
    schema = "Date string, Label int, " + ", ".join(f"{c} string" for c in HEADLINE_COLUMNS)
    return spark.createDataFrame(data, schema)


def test_string_dates_overlap_and_typed_dates_do_not(spark):
    train, test = headlines.date_split(headline_frame(spark))
    assert "2015-01-02" in {r["Date"] for r in train.collect()} & {r["Date"] for r in test.collect()}
    train, test = headlines.date_split(headline_frame(spark), typed=True)
    assert {r["Date"] for r in train.collect()} == {"20141231", "2014-12-31"}
    assert {r["Date"] for r in test.collect()} == {"20150101", "2015-01-02"}


def test_headline_texts(spark):
    train, test = headlines.train_and_test_texts(headline_frame(spark), "Date", typed=True)
    tail = " ".join(["nan"] * 22)
    assert {r["article"] for r in train.collect()} == {f"a   nan  t  {tail}"}
    assert {r["article"] for r in test.collect()} == {f"A1! nan Été {tail}"}
    _, cleaned = headlines.train_and_test_texts(headline_frame(spark), clean_test=True, typed=True)
    assert {r["article"] for r in cleaned.collect()} == {f"a   nan  t  {tail}"}
    names = headlines.headline_slice(headline_frame(spark), "Date").columns
    assert names == ["Date", *[str(i) for i in range(25)]]


# --- articles -----------------------------------------------------------------------------------


def page(body):
    return f"<html lang=\"en\"><title>T &amp; U</title><body>{body}</body></html>"


def shop(spark):
    """Five hits: one URL with blanks, one without page, one empty, one without body."""
    bodies = {
        "u1": page("<article>one</article>"),
        "u3": page("<article> </article>"),
        "u4": page("<p>nothing</p>"),
        "u5": page("<article><p>a &lt; b</p><p>two</p></article>"),
    }
    pages = [(i, u, h) for i, (u, h) in enumerate(bodies.items())]
    pages.append((99, "u1", page("<article>one, newer</article>")))
    pages = spark.createDataFrame(pages, "page_id long, url string, html string")
    hits = [(i, "t", f"title {i}", f"u{i}" if i != 1 else " u1 ") for i in range(1, 6)]
    return spark.createDataFrame(hits, "rank long, topic string, title string, url string"), pages


def test_page_text(spark):
    _, pages = shop(spark)
    got = {r["url"]: (r["title"], r["article"]) for r in pg.extract_pages(pages).collect()}
    assert got["u5"] == ("T & U", "a < b two")
    assert got["u3"][1] == "" and got["u4"][1] is None


@pytest.mark.parametrize("fits", [True, False])
def test_lookup_takes_the_newest_copy_and_drops_misses(spark, monkeypatch, fits):
    if not fits:
        monkeypatch.setattr(art, "fits_broadcast", lambda df: False)
    hits, pages = shop(spark)
    got = {r["rank"]: r["article"] for r in art.lookup(hits, pages).collect()}
    assert got == {1: "one, newer", 3: "", 4: None, 5: "a < b two"}


def test_top_articles(spark):
    hits, pages = shop(spark)
    assert [r["rank"] for r in art.top_articles(hits, pages, 4).collect()] == [1, 5]
    assert [r["rank"] for r in art.top_articles(hits, pages, 4, keep_empty=True).collect()] == [1, 3, 5]
    # The cap of int(2 * 1.5) = 3 hits comes first, so only one valid article is left.
    assert [r["rank"] for r in art.top_articles(hits, pages, 2).collect()] == [1]
    per_topic = art.top_articles_per_topic(hits, pages, 2)
    assert [r["rank"] for r in per_topic.collect()] == [1]
    assert art.hit_limit(5) == 7 and art.hit_limit(1000) == 100


def test_search_window_and_language(spark):
    data = [
        (1, "The Stock", "en", "2024-03-10 00:00:00"),
        (2, "the stock", "fr", "2024-03-10 00:00:00"),
        (3, "the stock", "en", "2024-03-01 00:00:00"),
        (4, "other", "en", "2024-03-10 00:00:00"),
        (5, "stock", "en", "2024-03-16 00:00:00"),
    ]
    hits = spark.createDataFrame(data, "rank long, title string, lang string, ts string")
    hits = hits.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    found = pg.matching_hits(hits, "STOCK", "2024-03-15 00:00:00")
    assert [r["rank"] for r in found.collect()] == [1]


# --- evaluation ---------------------------------------------------------------------------------


def test_reports(spark):
    pairs = [(0, 0), (0, 1), (1, 1), (2, 1)]  # class 2 is never predicted
    df = spark.createDataFrame(pairs, "label int, prediction int")
    matrix = {(a, b): n for a, b, n in evaluate.confusion(df).collect()}
    assert len(matrix) == 9 and sum(matrix.values()) == 4 and matrix[(2, 2)] == 0
    assert evaluate.accuracy(df).first()["accuracy"] == 0.5
    report = {r["class"]: r for r in evaluate.report(df).collect()}
    assert report[2]["precision"] == 0 and report[2]["f1"] == 0 and report[2]["support"] == 1
    assert report[1]["precision"] == pytest.approx(1 / 3) and report[1]["recall"] == 1
    average = {r["average"]: r for r in evaluate.report_averages(df).collect()}
    assert average["macro avg"]["recall"] == pytest.approx(0.5)
    assert average["weighted avg"]["precision"] == pytest.approx((2 * 1 + 1 / 3) / 4)
    # A class that is only ever predicted.
    only = spark.createDataFrame([(0, 3)], "label int, prediction int")
    assert {r["class"]: r["support"] for r in evaluate.report(only).collect()} == {0: 1, 3: 0}
