import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tickerpulse.operators import search


def plain(docs, topic, count):
    bags = {i: Counter((t or "").lower().split()) for i, t in docs}
    mean = sum(sum(b.values()) for b in bags.values()) / len(bags)
    out = []
    for i, bag in bags.items():
        score = 0.0
        for term in set(topic.lower().split()):
            df = sum(term in b for b in bags.values())
            if bag[term]:
                idf = math.log(1 + (len(bags) - df + 0.5) / (df + 0.5))
                length = sum(bag.values())
                score += idf * bag[term] * 2.2 / (bag[term] + 1.2 * (0.25 + 0.75 * length / mean))
        if any(bag[t] for t in topic.lower().split()):
            out.append((i, round(score, 6)))
    return sorted(out, key=lambda x: (-x[1], x[0]))[:count]


@pytest.fixture(scope="module")
def corpus(spark):
    words = ["market", "bank", "oil", "gold", "rate"]
    docs = [
        (i, " ".join(words[(i * k + k // 3) % 5] for k in range(1, 2 + i % 9)) + (" rare" if i % 41 == 7 else ""))
        for i in range(300)
    ]
    return [*docs, (300, None), (301, ""), (302, "Market MARKET")]


@pytest.fixture(scope="module")
def index(spark, corpus, tmp_path_factory):
    df = spark.createDataFrame(corpus, "doc_id long, text string").repartition(3)
    return search.build_index(df, "text", str(tmp_path_factory.mktemp("index") / "i"), block=16)


@pytest.mark.parametrize("topic", ["rare", "market oil", "Gold rare gold", "bank rate unknown"])
@pytest.mark.parametrize("count", [1, 7, 400])
def test_hits_as_brute_force(spark, corpus, index, topic, count):
    got = [(r["doc"], r["score"]) for r in search.search(spark, index, topic, count).collect()]
    want = plain(corpus, topic, count)
    assert [d for d, _ in got] == [d for d, _ in want]
    assert all(abs(a - b) < 2e-6 for (_, a), (_, b) in zip(got, want, strict=True))


@pytest.mark.parametrize("topic", ["unknown", "", "?!"])
def test_no_hits(spark, index, topic):
    assert search.search(spark, index, topic, 5).count() == 0


def test_blocks_are_skipped_and_terms_pushed_down(spark, index):
    table = index.postings(spark, ["rare", "market"])
    assert "In(term, [market,rare])" in table._jdf.queryExecution().executedPlan().toString()
    assert table.filter(F.size("postings") > 16).isEmpty()


def test_empty_corpus(spark, tmp_path):
    df = spark.createDataFrame([], "doc_id long, text string")
    index = search.build_index(df, "text", str(tmp_path / "i"))
    assert search.search(spark, index, "market", 3).count() == 0
