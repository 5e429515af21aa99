"""Toxicity scores: gradient-boosted trees over dense features, calibrated by isotonic regression.

The model is fitted on at most ``sample`` labelled training rows (those with the smallest hash of
their id).  Rows whose crc32(doc_id as text) mod 4 is 2 are held out and never used.  From the
sample come

- the lexicon: words far more frequent in toxic texts, and that after enough different words (an
  insult appears anywhere).  Equal and near-equal texts of a class count once;
- the trees (Spark ML), on three quarters of the sample;
- the calibration, on the last quarter.

A score depends on the text alone: densities of lexicon words, plain and disguised by digits or
signs, how often they stand near a second-person word, capitals, punctuation, marks inside words.

Every row of ``docs`` is scored over its whole text; null and empty texts are scored as texts
without words.  Without training rows of both classes every score is their smoothed share of
toxic rows (0.5 without any).  A label that is null, or of a ``doc_id`` that is null or labelled
both ways, does not count.  Repeated rows are scored each by itself.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..workspace import as_table
from . import near_dedup
from .common import id_and_text

#: Labelled training rows that are used at most.
SAMPLE = 20_000
#: Words of the lexicon at most.
LEXICON = 2_000
#: Different words that a word of the lexicon follows; fewer in small samples.
CONTEXTS = 20
THRESHOLD = 0.3
NEAR = 5

# Words that address the reader, in the four languages.
SECOND_PERSON = (
    "you your yours yourself u ur tu te toi ton ta tes vous votre vos "
    "du dich dir dein deine ihr euch euer sie ihnen usted ustedes ti tus vosotros"
)
FEATURES = [
    "log_words",
    "lexicon_density",
    "lexicon_hits",
    "lexicon_distinct",
    "lexicon_weight",
    "near_second_person",
    "capitals",
    "punctuation",
    "exclamations",
    "disguised_hits",
    "marked_words",
    "word_length",
]

_UPPER = bytes(range(65, 91))
_PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# Words are runs of letters, digits and bytes beyond ASCII; A-Z count as a-z.
_WORD_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)
_MARKED = re.compile(rb"[A-Za-z][0-9@$]+[A-Za-z]")
# Digits and signs that stand for letters become these; the rest as above.
_LEET = dict(zip(b"013457@$", b"oieastas", strict=True))
_PLAIN_TABLE = bytes(_LEET.get(b, _WORD_TABLE[b]) for b in range(256))
_LEET_SIGNS = bytes(_LEET)



def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_WORD_TABLE).split()


def features_of(text: str, lexicon: dict[bytes, float], second: frozenset[bytes]) -> list[float]:
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.translate(_WORD_TABLE).split()
    n = len(words)
    places = [i for i, w in enumerate(words) if w in lexicon]
    hits = [words[i] for i in places]
    near = sum(
        not second.isdisjoint(words[max(0, i - NEAR) : i] + words[i + 1 : i + 1 + NEAR])
        for i in places
    )
    marked = disguised = 0
    if len(raw.translate(None, _LEET_SIGNS)) < len(raw):
        marked = len(_MARKED.findall(raw))
        plain = sum(w in lexicon for w in raw.translate(_PLAIN_TABLE).split())
        disguised = max(0, plain - len(hits))
    size = max(1, len(raw))
    per = 1.0 / max(1, n)
    return [
        math.log1p(n),
        100 * len(hits) * per,
        math.log1p(len(hits)),
        float(len(set(hits))),
        100 * sum(lexicon[w] for w in hits) * per,
        float(near),
        (size - len(raw.translate(None, _UPPER))) / size,
        (size - len(raw.translate(None, _PUNCTUATION))) / size,
        raw.count(b"!") / size,
        float(disguised),
        marked * per,
        len(raw) * per if n else 0.0,
    ]


def featurize(texts: DataFrame, lexicon: dict[bytes, float], keep: list[str]) -> DataFrame:
    """``texts`` (``text`` and the columns ``keep``) with its feature columns."""
    second = frozenset(w.encode() for w in SECOND_PERSON.split())
    fields = [texts.schema[c] for c in keep]
    schema = ", ".join(
        [*(f"{f.name} {f.dataType.simpleString()}" for f in fields), *(f"{c} double" for c in FEATURES)]
    )

    def run(batches):
        for batch in batches:
            table = np.array(
                [features_of(t, lexicon, second) for t in batch.column("text").to_pylist()],
                dtype=np.float64,
            ).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), *(pa.array(c) for c in table.T.copy())],
                names=[*keep, *FEATURES],
            )

    return texts.select(*keep, "text").mapInArrow(run, schema)


def held_out(doc_id="doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, text, label`` of the bounded training sample, stored."""
    chosen = (
        labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int").alias("label"))
        .filter("doc_id IS NOT NULL AND label IS NOT NULL")
        .filter(~held_out())
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .filter("label = other AND label IN (0, 1)")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
        .select("doc_id", "label")
    )
    # At most ``sample`` rows of two numbers.
    rows = id_and_text(docs).join(F.broadcast(as_table(chosen, "toxic-sample")), "doc_id")
    return as_table(rows, "toxic-training")


def _first_of_its_kind(profiles: list) -> list[int]:
    """Ids of the texts whose signature agrees in 80 % with no text before it in a shared band."""
    out, seen = [], {}
    for row in sorted(profiles, key=lambda r: r["doc_id"]):
        if row["sig"] is None:
            out.append(row["doc_id"])
            continue
        sig = np.frombuffer(row["sig"], dtype=np.uint8).reshape(near_dedup.BANDS * near_dedup.ROWS, -1)
        bands = sig.reshape(near_dedup.BANDS, -1)
        keys = [(k, band.tobytes()) for k, band in enumerate(bands)]
        others = {id(x): x for x in (seen.get(key) for key in keys) if x is not None}
        if any((x == sig).all(axis=1).mean() >= 0.8 for x in others.values()):
            continue
        out.append(row["doc_id"])
        for key in keys:
            seen.setdefault(key, sig)
    return out


def distinct_texts(training: DataFrame) -> DataFrame:
    """``text, label``: of equal and near-equal texts of a class one, stored."""
    hashed = training.select(F.xxhash64("text").alias("doc_id"), "text", "label")
    single = as_table(hashed.dropDuplicates(["doc_id", "label"]), "toxic-single")
    # A clean text with an insult put in is no copy of it, so each class is reduced by itself.
    # The driver gets one signature for each row of the bounded sample.
    chosen = [
        (i, x)
        for x in (0, 1)
        for i in _first_of_its_kind(
            near_dedup.profiles(single.filter(F.col("label") == x), 5).collect()
        )
    ]
    ids = training.sparkSession.createDataFrame(chosen, "doc_id long, label int")
    kept = single.join(F.broadcast(ids), ["doc_id", "label"])
    return as_table(kept.select("text", "label"), "toxic-distinct")


def learn_lexicon(training: DataFrame, limit: int = LEXICON) -> dict[bytes, float]:
    """Weights (log odds) of the words that mark toxic texts."""
    training = distinct_texts(training)
    toxic, total = training.agg(F.sum("label"), F.count("*")).first()
    clean = total - (toxic or 0)
    if not toxic or not clean:
        return {}
    support = max(3, math.ceil(0.02 * toxic))

    def distinct_words(batches):
        for batch in batches:
            words, label = [], []
            for text, mark in zip(
                batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True
            ):
                own = set(words_of(text))
                words.extend(own)
                label.extend([mark] * len(own))
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()), pa.array(label, pa.int32())], names=["word", "label"]
            )

    odds = F.log(
        ((F.col("bad") + 0.5) / (toxic + 1)) / ((F.col("good") + 0.5) / (clean + 1))
    )
    candidates = {
        bytes(r["word"]): r["weight"]
        for r in training.select("text", "label")
        .mapInArrow(distinct_words, "word binary, label int")
        .groupBy("word")
        .agg(F.sum("label").alias("bad"), F.sum(1 - F.col("label")).alias("good"))
        .filter(F.col("bad") >= support)
        .withColumn("weight", odds)
        .filter("weight >= 2")
        .orderBy(F.desc("weight"), "word")
        .limit(limit)
        .collect()
    }
    if not candidates:
        return {}

    def neighbours(batches):
        for batch in batches:
            found = []
            for text in batch.column("text").to_pylist():
                words = words_of(text)
                for i, w in enumerate(words):
                    before = words[i - 1] if i else b""
                    if w in candidates and w != before:
                        found.append((w, before))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in found], pa.binary()) for k in (0, 1)],
                names=["word", "before"],
            )

    varied = (
        training.filter("label = 1")
        .select("text")
        .mapInArrow(neighbours, "word binary, before binary")
        .distinct()
        .groupBy("word")
        .agg(F.count("*").alias("kinds"))
        .filter(F.col("kinds") >= min(support, CONTEXTS))
        .collect()
    )
    return {bytes(r["word"]): candidates[bytes(r["word"])] for r in varied}


def score(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, held_out, score, predicted``, and its columns ``carry``."""
    training = training_rows(docs, labels, sample)
    counts = dict(training.groupBy("label").count().collect())
    texts = id_and_text(docs, keep=carry)
    if len(counts) < 2:
        share = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
        scored = texts.select("doc_id", *carry, F.lit(share).alias("score"))
    else:
        scored = _fitted(training, texts, carry)
    return scored.select(
        "doc_id",
        *carry,
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def _fitted(training: DataFrame, texts: DataFrame, carry: tuple[str, ...]) -> DataFrame:
    lexicon = learn_lexicon(training)
    assemble = VectorAssembler(inputCols=FEATURES, outputCol="features").transform
    rows = as_table(featurize(training, lexicon, ["doc_id", "label"]), "toxic-features").withColumn(
        "fold", F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(4))
    )
    # Both parts need both classes; a tiny sample serves for both.
    small = rows.groupBy("label").agg(F.count_if(F.col("fold") == 0).alias("n")).filter("n < 5")
    split = small.isEmpty()
    trees = GBTClassifier(
        labelCol="label", maxIter=30, maxDepth=4, stepSize=0.2, seed=7, checkpointInterval=-1
    ).fit(assemble(rows.filter("fold != 0") if split else rows).select("label", "features"))

    def margin(df: DataFrame) -> DataFrame:
        raw = vector_to_array("rawPrediction")[1]
        return trees.transform(assemble(df)).withColumn("margin", raw)

    calibrated = IsotonicRegression(
        featuresCol="margin", labelCol="label", predictionCol="score"
    ).fit(
        margin(rows.filter("fold = 0") if split else rows).select(
            "margin", F.col("label").cast("double").alias("label")
        )
    )
    scored = calibrated.transform(
        margin(featurize(texts, lexicon, ["doc_id", *carry])).select("doc_id", *carry, "margin")
    )
    return scored.select(
        "doc_id", *carry, F.greatest(F.lit(0.0), F.least(F.lit(1.0), "score")).alias("score")
    )
