"""Every query takes (session, folder of tables) and runs over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scores, stopwords, text
from ..operators import articles as art
from ..operators import evaluate, features, head, headlines, models, search, sentiment, subwords
from ..schemas import ARTICLE, HEADLINE_COLUMNS, SCORE, WEIGHTS
from ..sources import messages as msg
from ..sources import pages as pg
from ..sources import tables
from ..streaming import jobs, sinks
from ..workspace import scratch_path

NEWEST = "2024-03-15 00:00:00"
TOPIC = "the"
RANKED_TOPIC = "The of and tion"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


# --- messages ---------------------------------------------------------------------------------


def article_messages(spark: SparkSession, folder: str) -> DataFrame:
    return msg.to_messages(
        tables.articles(spark, folder), ["title", "article"], "news", F.col("doc_id")
    )


def mixed_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Messages as the various producers wrote them, one kind per language: plain object,
    object encoded twice, a single character, an array."""
    docs = tables.articles(spark, folder, "lang")
    plain = msg.encode(docs, ["title", "article"])
    array = F.to_json(F.array("title", "article"))
    as_text = F.to_json(F.array(plain))
    value = (
        F.when(F.col("lang") == "en", plain)
        .when(F.col("lang") == "fr", F.substring(as_text, F.lit(2), F.length(as_text) - 2))
        .when(F.col("lang") == "de", F.substring("article", 1, 1))
        .otherwise(array)
    )
    return docs.select("doc_id", value.cast("binary").alias("value"))


def topic_files(spark: SparkSession, messages: DataFrame, label: str) -> dict[str, str]:
    """Store messages as a topic; returns the options to read it."""
    path = scratch_path(spark, label)
    msg.write_messages(messages, {"path": path}, "parquet")
    return {"path": path}


@query
def src_batch_messages(spark: SparkSession, folder: str) -> DataFrame:
    topic = topic_files(spark, article_messages(spark, folder), "topic")
    scan = msg.read_topic(spark, topic, "parquet")
    return scan.select(F.col("offset").alias("doc_id"), msg.text_of().alias("text"))


@query
def json_decode(spark: SparkSession, folder: str) -> DataFrame:
    decoded = msg.decode(mixed_messages(spark, folder), ARTICLE, ["doc_id"])
    return decoded.select("doc_id", "title", "article")


@query
def json_decode_tolerant(spark: SparkSession, folder: str) -> DataFrame:
    decoded = msg.decode(mixed_messages(spark, folder), ARTICLE, ["doc_id"], tolerant=True)
    return decoded.filter(~msg.undecodable()).select("doc_id", "title", "article")


@query
def json_dead_letters(spark: SparkSession, folder: str) -> DataFrame:
    return msg.dead_letters(mixed_messages(spark, folder), ARTICLE, ["doc_id"], tolerant=True)


@query
def json_dead_letter_reasons(spark: SparkSession, folder: str) -> DataFrame:
    """Messages of four kinds: an article, an object of other fields, a single character, and an
    article whose fields are null, which is a message."""
    docs = tables.articles(spark, folder, "lang")
    nothing = F.to_json(
        F.struct(F.lit(None).cast("string").alias("title"), F.lit(None).cast("string").alias("article")),
        {"ignoreNullFields": "false"},
    )
    value = (
        F.when(F.col("lang") == "en", msg.encode(docs, ["title", "article"]))
        .when(F.col("lang") == "fr", F.to_json(F.struct(F.col("article").alias("body"))))
        .when(F.col("lang") == "de", F.substring("article", 1, 1))
        .otherwise(nothing)
    )
    dead = msg.dead_letters(
        docs.select("doc_id", value.cast("binary").alias("value")), ARTICLE, ["doc_id"],
        tolerant=True, with_reason=True,
    )
    return dead.select("doc_id", "reason")


@query
def sink_json_messages(spark: SparkSession, folder: str) -> DataFrame:
    docs = tables.articles(spark, folder)
    topic = topic_files(
        spark, docs.select("doc_id", msg.encode(docs, ["title", "article"]).alias("value")), "out"
    )
    return spark.read.schema("doc_id bigint, value string").parquet(topic["path"])


# --- sources ----------------------------------------------------------------------------------


@query
def src_parquet_articles(spark: SparkSession, folder: str) -> DataFrame:
    return tables.as_articles(
        tables.read_parquet(spark, f"{folder}/documents*.parquet", tables.schemas.DOCUMENTS)
    )


@query
def src_csv_headlines(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "headlines-csv")
    (
        tables.headlines(spark, folder)
        .drop("doc_id")
        .write.option("header", True)
        .option("encoding", "ISO-8859-1")
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    # These cells hold no line break, so the files can be split.
    read = tables.read_headlines_csv(spark, path, multi_line=False)
    return read.select("Date", "Label", headlines.concat_columns(HEADLINE_COLUMNS).alias("article"))


@query
def page_extract(spark: SparkSession, folder: str) -> DataFrame:
    return pg.extract_pages(tables.pages(spark, folder))


@query
def page_body_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Pages whose article elements became plain divisions, so that the blocks must show the body."""
    plain = F.regexp_replace("html", "(?i)<(/?)article", "<$1div")
    pages = tables.pages(spark, folder)
    return pages.select("page_id", pg.page_body(plain).alias("article"))


# --- articles ---------------------------------------------------------------------------------


def hits(spark: SparkSession, folder: str, topic: str | None = None) -> DataFrame:
    found = pg.hits_from_pages(tables.pages(spark, folder), NEWEST)
    return pg.matching_hits(found, topic, NEWEST)


@query
def article_search(spark: SparkSession, folder: str) -> DataFrame:
    found = hits(spark, folder, TOPIC).orderBy("rank").limit(art.hit_limit(40))
    return found.select("rank", "title", "url", "lang")


@query
def article_search_ranked(spark: SparkSession, folder: str) -> DataFrame:
    """Titles of all pages ranked for a topic of several words, from a stored index."""
    titles = pg.extract_titles(tables.pages(spark, folder))
    index = search.build_index(titles, "title", scratch_path(spark, "search-index"), "page_id")
    found = search.search(spark, index, RANKED_TOPIC, 60)
    return found.select(F.col("doc").alias("page_id"), "score")


@query
def article_lookup(spark: SparkSession, folder: str) -> DataFrame:
    found = hits(spark, folder).withColumn("url", F.concat(F.lit(" "), "url", F.lit(" ")))
    return art.lookup(found, tables.pages(spark, folder)).select("rank", "title", "article")


def fetched(spark: SparkSession, folder: str) -> DataFrame:
    """Articles of which some fetches failed (null) and some came back empty, by language."""
    docs = tables.articles(spark, folder, "lang")
    body = F.when(F.col("lang") == "es", "").when(F.col("lang") != "de", F.col("article"))
    return docs.withColumn("article", body)


@query
def article_nonempty(spark: SparkSession, folder: str) -> DataFrame:
    rows = fetched(spark, folder).filter(art.valid_article())
    return rows.select("doc_id", "title", "article")


@query
def article_keep_empty(spark: SparkSession, folder: str) -> DataFrame:
    rows = fetched(spark, folder).filter(art.valid_article(keep_empty=True))
    return rows.select("doc_id", "title", "article")


@query
def article_topn(spark: SparkSession, folder: str) -> DataFrame:
    return art.top_articles(hits(spark, folder, TOPIC), tables.pages(spark, folder), 20)


@query
def article_topn_per_topic(spark: SparkSession, folder: str) -> DataFrame:
    topic = F.lower(F.substring_index("title", " ", 1))
    found = hits(spark, folder).withColumn("topic", topic)
    return art.top_articles_per_topic(found, tables.pages(spark, folder), 5)


@query
def preview_head(spark: SparkSession, folder: str) -> DataFrame:
    return tables.as_articles(tables.documents(spark, folder)).orderBy("doc_id").limit(20)


# --- text -------------------------------------------------------------------------------------


def token_report(spark: SparkSession, folder: str, tokens: Column) -> DataFrame:
    return (
        tables.articles(spark, folder)
        .select("doc_id", tokens.alias("t"))
        .select("doc_id", F.size("t").alias("n"), F.array_join("t", "|").alias("tokens"))
    )


@query
def headline_clean(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = F.lower(text.strip_non_letters("article"))
    return tables.articles(spark, folder).select("doc_id", cleaned.alias("article"))


@query
def text_normalize(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = text.normalize("article")
    return tables.articles(spark, folder).select("doc_id", cleaned.alias("article"))


@query
def tokens_whitespace(spark: SparkSession, folder: str) -> DataFrame:
    return token_report(spark, folder, text.tokens_whitespace("article"))


@query
def tokens_script(spark: SparkSession, folder: str) -> DataFrame:
    return token_report(spark, folder, text.tokens_script("article"))


@query
def tokens_word(spark: SparkSession, folder: str) -> DataFrame:
    return token_report(spark, folder, text.tokens_word("article"))


@query
def tokens_no_stopwords(spark: SparkSession, folder: str) -> DataFrame:
    kept = text.drop_words(text.tokens_whitespace("article"), stopwords.ENGLISH)
    return token_report(spark, folder, kept)


@query
def tokens_custom_stopwords(spark: SparkSession, folder: str) -> DataFrame:
    kept = text.drop_words(
        text.tokens_script("article"), stopwords.SHORT, case_sensitive=True
    )
    return token_report(spark, folder, kept)


@query
def tokens_truncated(spark: SparkSession, folder: str) -> DataFrame:
    return token_report(spark, folder, text.truncate(text.tokens_word("article"), 512))


#: A public vocabulary of byte pieces, and the id it leaves free.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
VOCABULARY_MARK = 50_256


def limited(spark: SparkSession, rows: DataFrame) -> DataFrame:
    return subwords.within_limit(rows, subwords.read_vocabulary(VOCABULARY), VOCABULARY_MARK)


def model_token_report(rows: DataFrame, key: str) -> DataFrame:
    return rows.select(
        F.col(key).alias("doc_id"),
        F.array_join("input_ids", ",").alias("input_ids"),
        F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).cast("long").alias("n_unmasked"),
        "n_pieces",
        "model_text",
    )


@query
def tokens_model(spark: SparkSession, folder: str) -> DataFrame:
    return model_token_report(limited(spark, tables.articles(spark, folder)), "doc_id")


@query
def stream_model_tokens(spark: SparkSession, folder: str) -> DataFrame:
    rows = jobs.parsed_articles(article_stream(spark, folder))
    return through_parquet(model_token_report(limited(spark, rows), "offset"), "model-tokens")


@query
def bigrams(spark: SparkSession, folder: str) -> DataFrame:
    rows = jobs.article_features(tables.articles(spark, folder))
    return rows.select(
        "doc_id", F.size("ngrams").alias("n"), F.array_join("ngrams", "|").alias("tokens")
    )


@query
def tokens_stemmed(spark: SparkSession, folder: str) -> DataFrame:
    rows = jobs.draft_features(tables.articles(spark, folder))
    return rows.select(
        "doc_id",
        F.size("stemmed_tokens").alias("n"),
        F.array_join("stemmed_tokens", "|").alias("tokens"),
    )


# --- features ---------------------------------------------------------------------------------


def word_docs(spark: SparkSession, folder: str) -> DataFrame:
    return tables.articles(spark, folder).select(
        "doc_id", "title", text.tokens_word("article").alias("tokens")
    )


@query
def term_freq(spark: SparkSession, folder: str) -> DataFrame:
    return features.term_freq(word_docs(spark, folder), "tokens")


@query
def doc_freq(spark: SparkSession, folder: str) -> DataFrame:
    return features.doc_freq(word_docs(spark, folder), "tokens")


def bigram_docs(spark: SparkSession, folder: str) -> DataFrame:
    pairs = text.bigrams(text.tokens_word("article"))
    return tables.articles(spark, folder).select("doc_id", pairs.alias("pairs"))


@query
def bigram_counts(spark: SparkSession, folder: str) -> DataFrame:
    return features.term_freq(bigram_docs(spark, folder), "pairs")


@query
def bigram_vocab(spark: SparkSession, folder: str) -> DataFrame:
    return features.vocabulary(bigram_docs(spark, folder), "pairs").select("term", "term_index")


def rounded(weights: DataFrame) -> DataFrame:
    return weights.withColumn("weight", F.round("weight", 6))


@query
def tfidf_log1p(spark: SparkSession, folder: str) -> DataFrame:
    kept = text.drop_words("tokens", stopwords.SHORT)
    docs = word_docs(spark, folder).withColumn("tokens", kept)
    return rounded(features.fit_idf(docs, "tokens", "doc_id").transform(docs, "log1p"))


@query
def tfidf_l2(spark: SparkSession, folder: str) -> DataFrame:
    docs = word_docs(spark, folder)
    return rounded(features.fit_idf(docs, "tokens", "doc_id").transform(docs, "smooth", l2=True))


def normalized_docs(articles: DataFrame) -> DataFrame:
    words = text.tokens_word(text.normalize("article"))
    return articles.select("doc_id", text.drop_words(words, stopwords.ENGLISH).alias("tokens"))


@query
def tfidf_stop_l2(spark: SparkSession, folder: str) -> DataFrame:
    docs = normalized_docs(tables.articles(spark, folder))
    return rounded(features.fit_idf(docs, "tokens", "doc_id").transform(docs, "smooth", l2=True))


@query
def tfidf_spark(spark: SparkSession, folder: str) -> DataFrame:
    docs = word_docs(spark, folder)
    return rounded(features.fit_idf(docs, "tokens", "doc_id").transform(docs, "spark"))


@query
def features_left_join(spark: SparkSession, folder: str) -> DataFrame:
    kept = text.drop_words("tokens", stopwords.SHORT)
    docs = word_docs(spark, folder).withColumn("tokens", kept)
    weights = features.fit_idf(docs, "tokens", "doc_id").transform(docs, "smooth", l2=True)
    joined = features.attach_features(docs.select("doc_id", "title"), weights)
    return rounded(joined.select("doc_id", "title", "term", "weight"))


@query
def tfidf_bigrams(spark: SparkSession, folder: str) -> DataFrame:
    """Bigrams are too many for a broadcast in any real corpus: they are put together by a shuffle,
    also here."""
    docs = bigram_docs(spark, folder)
    model = features.fit_idf(docs, "pairs", "doc_id", by_term=True)
    return rounded(model.transform(docs, "smooth", rows=1_000))


def script_docs(spark: SparkSession, folder: str) -> DataFrame:
    """Lower-cased script tokens without the short stop list, as the draft chain takes them."""
    tokens = text.drop_words(text.tokens_script(F.lower("article")), stopwords.SHORT)
    return tables.articles(spark, folder).select("doc_id", "title", tokens.alias("tokens"))


@query
def tfidf_stemmed_log1p(spark: SparkSession, folder: str) -> DataFrame:
    model, counts = features.stemmed_idf(script_docs(spark, folder), "tokens")
    return rounded(model.weigh(counts, "log1p"))


@query
def tfidf_stemmed_l2(spark: SparkSession, folder: str) -> DataFrame:
    model, counts = features.stemmed_idf(script_docs(spark, folder), "tokens")
    return rounded(model.weigh(counts, "smooth", l2=True))


@query
def features_left_join_stemmed(spark: SparkSession, folder: str) -> DataFrame:
    docs = script_docs(spark, folder)
    model, counts = features.stemmed_idf(docs, "tokens")
    joined = features.attach_features(
        docs.select("doc_id", "title"), model.weigh(counts, "smooth", l2=True)
    )
    return rounded(joined.select("doc_id", "title", "term", "weight"))


@query
def stemmed_terms(spark: SparkSession, folder: str) -> DataFrame:
    kept = text.drop_words("tokens", stopwords.SHORT)
    docs = word_docs(spark, folder).withColumn("tokens", kept)
    return features.stemmed_counts(docs, "tokens")


@query
def label_index(spark: SparkSession, folder: str) -> DataFrame:
    rows = tables.documents(spark, folder).select("doc_id", F.col("source").alias("label"))
    return features.label_index(rows, "label").select("doc_id", "label", "label_index")


# --- headlines --------------------------------------------------------------------------------


@query
def date_split(spark: SparkSession, folder: str) -> DataFrame:
    rows = tables.headlines(spark, folder).select("doc_id", "Date")
    train, test = headlines.date_split(rows)
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )


@query
def headline_concat(spark: SparkSession, folder: str) -> DataFrame:
    train, test = headlines.train_and_test_texts(
        tables.headlines(spark, folder), "doc_id", "Label"
    )
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )


def headline_pairs(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    parts = headlines.train_and_test_texts(tables.headlines(spark, folder), "doc_id", "Label")
    pairs = text.bigrams(text.tokens_word("article")).alias("pairs")
    train, test = (p.select("doc_id", pairs) for p in parts)
    return train, test


@query
def ml_bow(spark: SparkSession, folder: str) -> DataFrame:
    train, test = headline_pairs(spark, folder)
    return features.bag_of_terms(train, test, "pairs")


# --- sentiment and evaluation -----------------------------------------------------------------


@query
def sentiment_scores(spark: SparkSession, folder: str) -> DataFrame:
    rows = tables.logits(spark, folder).withColumn("s", scores.softmax("logits"))
    return rows.select(
        "vec_id", *[F.round(F.get("s", F.lit(i)), 6).alias(f"score_{i}") for i in range(3)]
    )


@query
def sentiment_labels(spark: SparkSession, folder: str) -> DataFrame:
    return tables.logits(spark, folder).select(
        "vec_id",
        scores.argmax("logits").alias("class_index"),
        scores.sentiment("logits").alias("sentiments"),
    )


@query
def udf_registered(spark: SparkSession, folder: str) -> DataFrame:
    sentiment.register_text_function(spark, "predict_sentiment", lambda text: 1, "bigint")
    tables.articles(spark, folder).createOrReplaceTempView("articles_to_score")
    return spark.sql(
        "SELECT doc_id, predict_sentiment(article) AS sentiment_prediction FROM articles_to_score"
    )


@query
def eval_confusion(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.confusion(tables.labelled_predictions(spark, folder))


@query
def eval_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    rows = evaluate.accuracy(tables.labelled_predictions(spark, folder))
    return rows.select(F.round("accuracy", 9).alias("accuracy"))


def rounded_report(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f1")})


@query
def eval_report(spark: SparkSession, folder: str) -> DataFrame:
    return rounded_report(evaluate.report(tables.labelled_predictions(spark, folder)))


@query
def eval_report_avg(spark: SparkSession, folder: str) -> DataFrame:
    return rounded_report(evaluate.report_averages(tables.labelled_predictions(spark, folder)))


# --- streams ----------------------------------------------------------------------------------


def article_stream(spark: SparkSession, folder: str) -> DataFrame:
    topic = topic_files(spark, article_messages(spark, folder), "topic")
    return msg.stream_topic(spark, topic, "parquet")


def prediction_stream(spark: SparkSession, folder: str) -> DataFrame:
    events = tables.spread(tables.predictions(spark, folder), "event_id")
    messages = msg.to_messages(
        events, ["ticker", "sentiment_prediction"], "predictions", F.col("event_id")
    )
    return msg.stream_topic(spark, topic_files(spark, messages, "predictions"), "parquet")


def checkpoint(spark: SparkSession) -> str:
    return scratch_path(spark, "checkpoint")


def through_parquet(stream: DataFrame, label: str) -> DataFrame:
    """Run a bounded stream into Parquet and read the result."""
    spark, path = stream.sparkSession, scratch_path(stream.sparkSession, label)
    sinks.run_bounded(sinks.to_parquet(stream, path, checkpoint(spark)))
    return spark.read.schema(stream.schema).parquet(path)


@query
def src_stream_articles(spark: SparkSession, folder: str) -> DataFrame:
    raw = article_stream(spark, folder).select("offset", "topic", msg.text_of().alias("value"))
    return through_parquet(raw.withColumnRenamed("offset", "doc_id"), "raw")


@query
def stream_parquet_sink(spark: SparkSession, folder: str) -> DataFrame:
    parsed = jobs.parsed_articles(article_stream(spark, folder))
    return through_parquet(parsed.withColumnRenamed("offset", "doc_id"), "articles")


@query
def stream_features(spark: SparkSession, folder: str) -> DataFrame:
    rows = jobs.article_features(jobs.parsed_articles(article_stream(spark, folder)))
    stored = through_parquet(rows.select("offset", "cleaned_tokens", "ngrams"), "features")
    return stored.select(
        F.col("offset").alias("doc_id"),
        F.size("cleaned_tokens").alias("n_tokens"),
        F.array_join("ngrams", "|").alias("ngrams"),
    )


@query
def stream_tfidf(spark: SparkSession, folder: str) -> DataFrame:
    """Frequencies of the stored corpus, applied to every batch of the stream."""
    model = features.fit_idf(normalized_docs(tables.articles(spark, folder)), "tokens")
    parsed = jobs.parsed_articles(article_stream(spark, folder))
    docs = normalized_docs(parsed.withColumnRenamed("offset", "doc_id"))
    path = scratch_path(spark, "tfidf")
    sinks.run_bounded(
        sinks.to_table(
            docs, path, checkpoint(spark), per_batch=lambda b: model.transform(b, "smooth", l2=True)
        )
    )
    return rounded(sinks.read_table(spark, path, WEIGHTS).drop(sinks.QUERY, sinks.BATCH))


@query
def stream_preview(spark: SparkSession, folder: str) -> DataFrame:
    parsed = jobs.parsed_articles(article_stream(spark, folder))
    path = scratch_path(spark, "preview")
    sinks.run_bounded(
        sinks.to_preview_table(parsed, path, checkpoint(spark), [F.col("offset")], 20)
    )
    table = sinks.read_table(spark, path, parsed.schema)
    return table.select(F.col("offset").alias("doc_id"), "title", "article")


def scaled_topic(spark: SparkSession, folder: str) -> dict[str, str]:
    """Run the scaling job from topic to topic."""
    out = {"path": scratch_path(spark, "scaled")}
    scaled = jobs.scaled_scores(prediction_stream(spark, folder))
    sinks.run_bounded(
        sinks.to_topic(scaled, ["ticker", "aggregated_score"], out, checkpoint(spark), "parquet")
    )
    return out


@query
def stream_scaled_scores(spark: SparkSession, folder: str) -> DataFrame:
    out = scaled_topic(spark, folder)
    return jobs.scores(spark.read.schema("value string").parquet(out["path"]))


def score_stream(spark: SparkSession, folder: str) -> DataFrame:
    out = scaled_topic(spark, folder)
    return jobs.scores(spark.readStream.schema("value string").parquet(out["path"]))


@query
def stream_table_sink(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "scores")
    sinks.run_bounded(sinks.to_table(score_stream(spark, folder), path, checkpoint(spark)))
    return sinks.read_table(spark, path, SCORE).select("ticker", "aggregated_score")


@query
def stream_score_count(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "counts")
    rows = jobs.scaled_scores(prediction_stream(spark, folder))
    sinks.run_bounded(sinks.to_running_counts(rows, path, checkpoint(spark)))
    return sinks.latest_counts(spark, path)


def score_table(spark: SparkSession, folder: str) -> DataFrame:
    scaled = scores.scale_score("sentiment_prediction").alias("aggregated_score")
    return tables.predictions(spark, folder).select("ticker", scaled)


@query
def score_count(spark: SparkSession, folder: str) -> DataFrame:
    return jobs.score_count(score_table(spark, folder))


@query
def score_by_ticker(spark: SparkSession, folder: str) -> DataFrame:
    return jobs.score_count_by_ticker(score_table(spark, folder))


# --- models (rows only) -----------------------------------------------------------------------


def labelled_articles(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents with a three-way class: toxic 0, plain 1, good 2."""
    marks = tables.labels(spark, folder)
    group = (
        F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 1, 2).otherwise(1).alias("class")
    )
    docs = tables.articles(spark, folder).join(marks, "doc_id")
    return docs.select("doc_id", "title", "article", "quality", group)


@query
def ml_random_forest(spark: SparkSession, folder: str) -> DataFrame:
    train, test = headlines.train_and_test_texts(
        tables.headlines(spark, folder), "doc_id", "Label"
    )
    forest = models.bigram_forest().fit(train)
    return forest.transform(test).select(
        "doc_id", F.col("Label").alias("label"), F.col("prediction").cast("int")
    )


@query
def ml_sentiment(spark: SparkSession, folder: str) -> DataFrame:
    weights, bias = models.fit_linear_weights(labelled_articles(spark, folder))
    scorer = sentiment.linear_scorer(weights, bias)
    scored = sentiment.with_sentiment(tables.articles(spark, folder), scorer)
    return scored.select("doc_id", "title", "sentiments")


@query
def ml_sentiment_limited(spark: SparkSession, folder: str) -> DataFrame:
    """Scored live within a model's input length of 512 pieces."""
    weights, bias = models.fit_linear_weights(labelled_articles(spark, folder))
    scorer = sentiment.linear_scorer(weights, bias)
    rows = limited(spark, jobs.parsed_articles(article_stream(spark, folder)))
    scored = sentiment.with_sentiment(rows, scorer, "model_text")
    return through_parquet(
        scored.select(F.col("offset").alias("doc_id"), "title", "sentiments"), "limited-sentiment"
    )


@query
def ml_linear_score(spark: SparkSession, folder: str) -> DataFrame:
    model = models.linear_score_model(labelled_articles(spark, folder), "quality")
    return model.transform(tables.articles(spark, folder)).select("doc_id", "sentiment_score")


@query
def ml_embedding_head(spark: SparkSession, folder: str) -> DataFrame:
    rows = tables.embeddings(spark, folder).select(
        "vec_id", "embedding", (F.col("label") >= 5).cast("int").alias("label")
    )
    rows = models.as_vector(rows)
    width = rows.select(F.size("embedding")).first()[0]
    fitted = models.embedding_head(rows, width)
    return fitted.transform(rows).select("vec_id", "label", F.col("prediction").cast("int"))


@query
def ml_trained_head(spark: SparkSession, folder: str) -> DataFrame:
    rows = tables.embeddings(spark, folder).select(
        "vec_id", F.col("embedding").alias("features"), (F.col("label") >= 5).cast("int").alias("label")
    )
    fitted = head.train(rows, "vec_id", "label")
    return fitted.transform(rows, "vec_id").select("vec_id", F.round("probability", 6).alias("probability"), "prediction")


def saved_classifier(spark: SparkSession, folder: str) -> models.PipelineModel:
    path = scratch_path(spark, "model")
    models.save_model(models.text_classifier().fit(labelled_articles(spark, folder)), path)
    return models.load_model(path)


@query
def ml_model_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    model = saved_classifier(spark, folder)
    rows = model.transform(tables.articles(spark, folder))
    return rows.select("doc_id", F.col("prediction").cast("int").alias("class"))


@query
def stream_predictions(spark: SparkSession, folder: str) -> DataFrame:
    model = saved_classifier(spark, folder)
    rows = model.transform(jobs.parsed_articles(article_stream(spark, folder)))
    return through_parquet(
        rows.select(F.col("offset").alias("doc_id"), F.col("prediction").cast("int").alias("class")),
        "predicted",
    )


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """Message to features: decode, keep valid articles, drop stop words, count bigrams."""
    parsed = jobs.parsed_articles(article_messages(spark, folder)).filter(art.valid_article())
    return features.term_freq(jobs.article_features(parsed), "ngrams", "offset")
