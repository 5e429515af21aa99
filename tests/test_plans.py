"""What the physical plans must and must not hold."""

import pytest

import __spark_entry__ as contract
from tickerpulse import schemas
from tickerpulse.functions import text
from tickerpulse.operators import features
from tickerpulse.plans import queries as q
from tickerpulse.sources import tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def raw_docs(spark, folder):
    """Documents as a large table is read: straight from the scan."""
    docs = tables.read_parquet(spark, f"{folder}/documents.parquet", schemas.DOCUMENTS)
    return docs.select("doc_id", text.tokens_word("text").alias("tokens"))


def test_counts_inside_a_document_need_no_shuffle(spark, small):
    docs = raw_docs(spark, small)
    assert "Exchange" not in plan(features.term_freq(docs, "tokens"))
    pairs = docs.withColumn("pairs", text.bigrams("tokens"))
    assert "Exchange" not in plan(features.term_freq(pairs, "pairs"))


def test_document_frequency_is_pre_aggregated(spark, small):
    tree = plan(features.doc_freq(raw_docs(spark, small), "tokens"))
    assert tree.count("Exchange") == 1
    assert tree.index("Exchange") < tree.index("partial_count")


def test_scaled_weights_take_one_shuffle(spark, small):
    docs = raw_docs(spark, small)
    model = features.fit_idf(docs, "tokens")
    assert "Exchange hash" not in plan(model.transform(docs))
    assert plan(model.transform(docs, l2=True)).count("Exchange hash") == 1


def test_scans_read_only_what_is_used(spark, small):
    tree = plan(q.score_by_ticker(spark, small))
    assert "ReadSchema: struct<user_id:bigint>" in tree
    tree = plan(q.eval_accuracy(spark, small))
    assert "ReadSchema: struct<doc_id:bigint,n_chars:bigint>" in tree
    assert "ReadSchema: struct<doc_id:bigint,quality:int>" in tree


def test_filters_reach_the_scan(spark, small):
    docs = tables.as_articles(tables.documents(spark, small), "lang").filter("lang = 'en'")
    assert "EqualTo(lang,en)" in plan(docs)


def test_only_wanted_pages_are_parsed(spark, small):
    """No page's text goes through an aggregate, and a bitmap of wanted pages comes before any join
    or shuffle of texts but the one that spreads a small table."""
    tree = plan(q.article_lookup(spark, small))
    lines = tree.split("\n")
    assert not any("html" in line for line in lines if "Aggregate" in line)
    moved = [line for line in lines if "html" in line and "Exchange" in line]
    assert all("REPARTITION" in line for line in moved)
    # In the printed tree an operator's input follows it.
    bitmap = next(i for i, line in enumerate(lines) if "_bucket" in line and "Join" in line)
    scan = next(i for i, line in enumerate(lines) if "ReadSchema" in line and "html" in line)
    assert bitmap < scan and not any("html" in x for x in lines if "SortMergeJoin" in x)


def test_large_tables_are_not_spread(spark, tmp_path):
    many = tmp_path / "many"
    spark.range(100).repartition(16).write.parquet(str(many))
    table = spark.read.parquet(str(many))
    assert tables.spread(table, "id") is table
    one = tmp_path / "one"
    spark.range(100).coalesce(1).write.parquet(str(one))
    cores = spark.sparkContext.defaultParallelism
    assert tables.spread(spark.read.parquet(str(one)), "id").rdd.getNumPartitions() == cores


PYTHON = {"ml_sentiment", "udf_registered"}


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_no_query_has_a_cross_join_or_needless_python(spark, small, name):
    tree = plan(contract.queries()[name](spark, small))
    assert "CartesianProduct" not in tree and "NestedLoop" not in tree
    assert ("EvalPython" in tree) == (name in PYTHON)


def test_windows_are_cut_before_their_shuffle(spark, small):
    tree = plan(q.article_topn_per_topic(spark, small))
    assert tree.count("WindowGroupLimit") == 4
