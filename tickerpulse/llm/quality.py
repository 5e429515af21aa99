"""Quality rules with thresholds that follow the corpus.

Every text gives a few measures.  For each (lang, source) a mergeable quantile sketch (KLL) of
every measure is built next to the data and merged across tasks, on to languages and to the whole
corpus.  A measure's fence lies at the median plus a multiple of the 90 % quantile's distance from
it (from below, of the 10 % quantile's), and no nearer than a floor.  Where fewer than a quarter of
the texts show a measure at all, sketches of the positive values tell how far off those texts
stand; if half-way to their 10 % quantile is beyond the floor, the fence lies there.  A group's fence is drawn towards its language's, and a language's
towards the corpus's, by the weight of a fixed number of rows, so a fence moves smoothly with the
size of its group.  Texts are then judged by a join with their group's fences.
A group with more than a tenth of junk that does not stand apart widens its own fences.  Groups with a large share of all
rows are no problem: sketches have a fixed size, and the join can be split.

Fixed rules come first: a text fails with fewer than 10 words or with more than 20 % of its
words in repeated five-word windows.

Null and empty texts have no words and fail.  Null languages and sources form groups of their
own.  Repeated rows are judged each by itself; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..workspace import as_table

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: Weight, in rows, of a language's fence in its groups' fences, and of the corpus's in a language's.
PRIOR_ROWS = 40
#: Size parameter of the sketches: rank errors below 1 %.
SKETCH_K = 400
#: The quantile that shows a group's spread; from below, its mirror image.
UPPER = 0.9
#: Distance of a fence from the median, in distances of that quantile.
SPREAD = 4.0
#: Measures with the least distance of their fence from the median, for groups without spread.
FLOORS = {
    "symbol_rate": 0.1,
    "dup_line_rate": 0.2,
    "repeat_rate": 0.05,
    "capital_rate": 0.03,
    "mark_rate": 0.1,
    "word_length": 6.0,
}
#: Measures that most texts may not show at all, and the share below which they count as rare.
RARE_SHARE = 0.25
RARE = [c for c in FLOORS if c != "word_length"]
#: Where a fence lies on the way to the 10 % quantile of the values that are shown.
APART = 0.5
#: Measures that are also fenced from below.
TWO_SIDED = {"word_length": 1.0}

_SPACE = b" \t\n\v\f\r"
_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + _UPPER.lower()
_CONTINUED = bytes(range(0x80, 0xC0))
_MARKS = b"!?~^_=+@"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of five that the text has twice or more."""
    if len(words) < 2 * WINDOW - WINDOW + 1:
        return 0
    windows = list(zip(*(islice(words, k, None) for k in range(WINDOW)), strict=False))
    if len(set(windows)) == len(windows):
        return 0
    seen: dict[tuple, int] = {}
    codes = np.fromiter(
        (seen.setdefault(w, len(seen)) for w in windows), dtype=np.int64, count=len(windows)
    )
    twice = np.bincount(codes)[codes] > 1
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    edge[: len(twice)] += twice
    edge[WINDOW : WINDOW + len(twice)] -= twice
    return int((np.cumsum(edge) > 0).sum())


def measure(text: str) -> list[float]:
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    solid = raw.translate(None, _SPACE)
    chars = len(solid.translate(None, _CONTINUED))
    symbols = len(solid) - len(solid.translate(None, _SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    dup = len(lines) - len(set(lines))
    repeat = repeated_words(words)
    letters = len(solid) - len(solid.translate(None, _LETTERS))
    capitals = len(solid) - len(solid.translate(None, _UPPER))
    marks = len(solid) - len(solid.translate(None, _MARKS))
    per = 1.0 / max(1, n)
    return [
        n,
        chars,
        symbols,
        dup,
        repeat,
        symbols * per,
        dup / max(1, len(lines)),
        repeat * per,
        capitals / max(1, letters),
        marks * per,
        chars * per,
    ]


def measures(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id, lang, source``, the counts and the rates of ``FLOORS``."""
    names = ["doc_id", "lang", "source", *COUNTS, *FLOORS]

    def run(batches):
        for batch in batches:
            rows = [measure(t or "") for t in batch.column("text").to_pylist()]
            table = np.array(rows, dtype=np.float64).reshape(-1, len(COUNTS) + len(FLOORS)).T
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in names[:3]),
                    *(pa.array(c.astype(np.int64)) for c in table[: len(COUNTS)]),
                    *(pa.array(c.copy()) for c in table[len(COUNTS) :]),
                ],
                names=names,
            )

    schema = "doc_id bigint, lang string, source string, " + ", ".join(
        [*(f"{c} bigint" for c in COUNTS), *(f"{c} double" for c in FLOORS)]
    )
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *(F.col(c).cast("string").alias(c) for c in ("lang", "source", "text")),
    ).mapInArrow(run, schema)


def sketches(measured: DataFrame) -> DataFrame:
    """``lang, source, n``, a sketch per measure, and counts and sketches of positive values."""
    shown = {c: F.when(F.col(c) > 0, F.col(c)) for c in RARE}
    return measured.groupBy("lang", "source").agg(
        F.count("*").alias("n"),
        *(F.kll_sketch_agg_double(F.col(c), F.lit(SKETCH_K)).alias(c) for c in FLOORS),
        *(F.count(v).alias(f"{c}_shown") for c, v in shown.items()),
        *(F.kll_sketch_agg_double(v, F.lit(SKETCH_K)).alias(f"{c}_positive") for c, v in shown.items()),
    )


def _merged(sketched: DataFrame, *keys: str) -> DataFrame:
    merged = [*FLOORS, *(f"{c}_positive" for c in RARE)]
    added = ["n", *(f"{c}_shown" for c in RARE)]
    return sketched.groupBy(*keys).agg(
        *(F.sum(c).alias(c) for c in added),
        *(F.kll_merge_agg_double(F.col(c)).alias(c) for c in merged),
    )


def _fences(sketched: DataFrame, prefix: str, *keys: str) -> DataFrame:
    def quantile(c: str, q: float) -> Column:
        return F.kll_sketch_get_quantile_double(F.col(c), F.lit(q))

    out = []
    for c, floor in FLOORS.items():
        middle = quantile(c, 0.5)
        high = middle + F.greatest(F.lit(floor), SPREAD * (quantile(c, UPPER) - middle))
        if c in RARE:
            shown = F.col(f"{c}_shown")
            rare = (shown > 0) & (shown < RARE_SHARE * F.col("n"))
            apart = F.when(rare, APART * quantile(f"{c}_positive", 1 - UPPER))
            high = F.when(apart > floor, apart).otherwise(high)
        out.append(high.alias(f"{prefix}{c}_high"))
        if c in TWO_SIDED:
            near = F.greatest(F.lit(TWO_SIDED[c]), SPREAD * (middle - quantile(c, 1 - UPPER)))
            out.append((middle - near).alias(f"{prefix}{c}_low"))
    return sketched.select(*keys, F.col("n").alias(f"{prefix}n"), *out)


def thresholds(measured: DataFrame) -> DataFrame:
    """Fences of every (lang, source), stored: its own, drawn towards its language's and the corpus's."""
    sketched = as_table(sketches(measured), "quality-sketches")
    by_lang = as_table(_merged(sketched, "lang"), "quality-lang").withColumnRenamed("lang", "_lang")
    whole = as_table(_merged(sketched).filter("n > 0"), "quality-all")
    # One row (none for an empty corpus), and as many as there are languages in the corpus.
    joined = (
        _fences(sketched, "g_", "lang", "source")
        .join(_fences(by_lang, "l_", "_lang"), F.col("lang").eqNullSafe(F.col("_lang")), "left")
        .join(F.broadcast(_fences(whole, "a_")), F.lit(True))
    )

    def drawn(own: Column, rows: Column, towards: Column) -> Column:
        return (rows * own + PRIOR_ROWS * towards) / (rows + PRIOR_ROWS)

    def mix(c: str) -> Column:
        language = drawn(F.col(f"l_{c}"), F.col("l_n"), F.col(f"a_{c}"))
        return drawn(F.col(f"g_{c}"), F.col("g_n"), language).alias(c)

    names = [f"{c}_high" for c in FLOORS] + [f"{c}_low" for c in TWO_SIDED]
    fences = joined.select(F.col("lang").alias("_l"), F.col("source").alias("_s"), *map(mix, names))
    return as_table(fences, "quality-fences")


def judge(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, the counts, ``base_failed, kept``."""
    measured = as_table(measures(docs), "quality-measures")
    fences = thresholds(measured)
    base = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    inside = F.lit(True)
    for c in FLOORS:
        inside &= F.col(c) <= F.col(f"{c}_high")
    for c in TWO_SIDED:
        inside &= F.col(c) >= F.col(f"{c}_low")
    return measured.join(
        fences,
        F.col("lang").eqNullSafe(F.col("_l")) & F.col("source").eqNullSafe(F.col("_s")),
        "left",
    ).select(
        "doc_id", *COUNTS, base.alias("base_failed"), (~base & inside).alias("kept")
    )
