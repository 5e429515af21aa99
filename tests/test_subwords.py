"""Model tokens: longest pieces, the input length, padding and mask."""

import base64

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickerpulse.__main__ import main
from tickerpulse.operators import subwords
from tickerpulse.schemas import TICKER_ARTICLE

PIECES = [b" ", b" pro", b" prof", b"fit", b"it", b"f", b"i", b"t", b"p", b"r", b"o", b" loss", b"s"]
VOCABULARY = {piece: number for number, piece in enumerate(PIECES)}
MARK = 99


def plain(words, max_length):
    ids, whole, total = [], 0, 0
    for word in words:
        unit = b" " + word.encode()
        own = []
        while unit:
            fits = [p for p in PIECES if unit.startswith(p)]
            best = max(fits, key=len) if fits else unit[:1]
            own.append(VOCABULARY.get(best, MARK))
            unit = unit[len(best):]
        ids += own
        total += len(own)
        whole += total <= max_length - 2
    kept = [MARK, *ids[: max_length - 2], MARK]
    pad = max_length - len(kept)
    return kept + [MARK] * pad, [1] * len(kept) + [0] * pad, total, whole


def encoded(spark, rows, max_length=8):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "id int, words array<string>")
    column = subwords.model_tokens(spark, F.col("words"), VOCABULARY, MARK, max_length)
    return [tuple(r[1]) for r in df.select("id", column.alias("m")).orderBy("id").collect()]


def test_longest_pieces_padding_and_mask(spark):
    rows = [["profit"], ["profits", "loss"], [], ["é"], ["profit", "loss", "fit"], None, ["x" * 9000]]
    got = encoded(spark, rows)
    assert got[:5] == [plain(r, 8) for r in rows[:5]]
    assert got[0] == ([MARK, 2, 4, MARK, MARK, MARK, MARK, MARK], [1] * 4 + [0] * 4, 2, 1)
    assert got[5] == (None, None, None, None)
    # A word that does not fit is cut in the ids, and no whole word of it is left.
    assert got[6] == plain(rows[6], 8) and got[6][2:] == (9001, 0)
    assert encoded(spark, [["loss", None, "loss"]]) == [plain(["loss", "loss"], 8)]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.text("profitls", max_size=9), max_size=6), min_size=1, max_size=20))
def test_against_a_plain_version(spark, rows):
    assert encoded(spark, rows, 6) == [plain(r, 6) for r in rows]


def test_bounds(spark):
    with pytest.raises(ValueError, match="no room"):
        subwords.model_tokens(spark, F.col("words"), VOCABULARY, MARK, 1)
    large = {n.to_bytes(4): n for n in range(subwords.MAX_VOCABULARY + 1)}
    with pytest.raises(ValueError, match="more than"):
        subwords.model_tokens(spark, F.col("words"), large, MARK)


def test_text_within_the_limit(spark):
    rows = [("profit loss profit profit",), ("",), (None,)]
    articles = spark.createDataFrame(rows, "article string")
    got = subwords.within_limit(articles, VOCABULARY, MARK, max_length=6).collect()
    # "profit" is two pieces, "loss" one: the first two words fill three of four places.
    assert [r["model_text"] for r in got] == ["profit loss", "", None]
    assert [r["n_pieces"] for r in got] == [7, 0, None]


def test_label_job_sees_only_what_fits(spark, tmp_path):
    """The second half of the article would turn its label round."""
    text = "profit rise " + "loss drop fall " * 5
    spark.createDataFrame([("t", text, None)], TICKER_ARTICLE).write.parquet(str(tmp_path / "articles"))
    rows = [("profit rise gain", 2), ("loss drop fall", 0), ("plain report", 1)] * 10
    spark.createDataFrame(rows, "article string, class int").write.parquet(str(tmp_path / "labelled"))
    lines = [f"{base64.b64encode(bytes([b])).decode()} {b}" for b in range(256)]
    lines += [f"{base64.b64encode(w).decode()} {256 + n}" for n, w in enumerate([b" profit", b" rise"])]
    (tmp_path / "ranks").write_text("\n".join(lines))

    def run(*words):
        main([str(w) for w in words], spark)

    run("train", "--labelled", tmp_path / "labelled", "--model", tmp_path / "model")
    job = ["label", "--articles", tmp_path / "articles", "--model", tmp_path / "model", "--out"]
    run(*job, tmp_path / "whole")
    run(*job, tmp_path / "cut", "--vocabulary", tmp_path / "ranks", "--max-length", 4)
    whole, cut = (spark.read.parquet(str(tmp_path / n)).first() for n in ("whole", "cut"))
    assert (whole["sentiments"], cut["sentiments"]) == ("negative", "positive")
    assert whole["article"] == cut["article"] == text


def test_only_a_slice_of_a_batch_is_python_objects(spark, monkeypatch):
    rows = [["profit"], None, ["loss", "profits"], [], ["é"]]
    whole = encoded(spark, rows)
    monkeypatch.setattr(subwords, "ROWS_AT_ONCE", 2)
    assert encoded(spark, rows) == whole == [plain(r, 8) if r is not None else (None,) * 4 for r in rows]
    words = spark.createDataFrame([(["profit"],)], "words array<string>")
    column = subwords.model_tokens(spark, F.col("words"), VOCABULARY, MARK)
    tree = words.select(column.alias("m"))._jdf.queryExecution().executedPlan().toString()
    assert "pandas" not in tree.lower() and "ArrowEvalPython" in tree
