"""Model fits on Spark ML.

Feature width is a parameter, so no fit gathers a vocabulary on the driver.  Text stages are SQL
expressions kept inside the saved model: a loaded model takes raw articles, batch or streaming.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    LogisticRegression,
    MultilayerPerceptronClassifier,
)
from pyspark.ml.feature import (
    IDF,
    CountVectorizerModel,
    ElementwiseProduct,
    HashingTF,
    Normalizer,
    SQLTransformer,
    StopWordsRemover,
    VectorAssembler,
)
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import DenseVector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import stopwords
from ..functions.text import bigrams_sql, normalize_sql, words_sql
from ..workspace import as_table
from .forest import SparseForest
from .sentiment import hashed_buckets

# Forest size, and hidden units of the embedding head.
FOREST_TREES = 200
HEAD_UNITS = 64
# Spark's limit; the forest being reproduced grows without one.
MAX_TREE_DEPTH = 30

SENTIMENT_CLASSES = 3


def _add(expression: str, name: str) -> SQLTransformer:
    return SQLTransformer(statement=f"SELECT *, {expression} AS {name} FROM __THIS__")


def _words(text: str = "article", name: str = "words") -> SQLTransformer:
    return _add(words_sql(f"coalesce({text}, '')"), name)


def bigram_forest(
    trees: int = FOREST_TREES,
    depth: int = MAX_TREE_DEPTH,
    features: int = 1 << 18,
    seed: int = 0,
    label: str = "Label",
) -> Pipeline:
    """Bigram counts into a random forest with the entropy criterion."""
    return Pipeline(
        stages=[
            _words(),
            _add(bigrams_sql("words"), "pairs"),
            HashingTF(inputCol="pairs", outputCol="features", numFeatures=features),
            SparseForest(label, trees, depth, features, seed),
        ]
    )


def linear_score_model(
    train: DataFrame,
    label: str,
    features: int = 1 << 18,
    stop: list[str] | None = None,
    max_iter: int = 100,
) -> PipelineModel:
    """Linear regression on length-1 TF-IDF vectors of normalised text without stop words.

    Frequencies come from the whole corpus, once.  Spark's IDF is ln((N+1)/(df+1)); the wanted
    one is that plus 1, applied as a fixed scaling of the counts.
    """
    counts = Pipeline(
        stages=[
            _add(normalize_sql("coalesce(article, '')"), "clean"),
            _words("clean"),
            StopWordsRemover(
                inputCol="words", outputCol="kept", stopWords=stop or stopwords.ENGLISH
            ),
            HashingTF(inputCol="kept", outputCol="counts", numFeatures=features),
        ]
    ).fit(train)
    counted = as_table(counts.transform(train).select("counts", label), "train-counts")
    idf = IDF(inputCol="counts", outputCol="ignored").fit(counted).idf
    scale = ElementwiseProduct(
        scalingVec=DenseVector(idf.toArray() + 1.0), inputCol="counts", outputCol="tfidf"
    )
    unit = Normalizer(p=2.0, inputCol="tfidf", outputCol="features")
    regression = LinearRegression(
        labelCol=label, predictionCol="sentiment_score", regParam=0.1, maxIter=max_iter
    ).fit(unit.transform(scale.transform(counted)))
    return PipelineModel(stages=[*counts.stages, scale, unit, regression])


def embedding_head(
    train: DataFrame, width: int, label: str = "label", max_iter: int = 50, seed: int = 0
) -> PipelineModel:
    """Two-class head with one hidden layer on a dense embedding (column ``vector``)."""
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=["vector"], outputCol="features"),
            MultilayerPerceptronClassifier(
                labelCol=label, layers=[width, HEAD_UNITS, 2], maxIter=max_iter, seed=seed
            ),
        ]
    ).fit(train)


def as_vector(df: DataFrame, embedding: str = "embedding") -> DataFrame:
    return df.withColumn("vector", array_to_vector(F.col(embedding)))


def text_classifier(features: int = 1 << 16, label: str = "class") -> Pipeline:
    """Word counts into a multinomial logistic regression."""
    return Pipeline(
        stages=[
            _words(),
            HashingTF(inputCol="words", outputCol="features", numFeatures=features),
            LogisticRegression(labelCol=label, family="multinomial", maxIter=20, regParam=0.01),
        ]
    )


def fit_linear_weights(
    train: DataFrame, text: str = "article", label: str = "class", buckets: int = 1 << 14
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias of the default three-class scorer: fitted on Spark, small enough to ship
    to every task."""
    hashed = F.transform(hashed_buckets(text, buckets), lambda b: b.cast("string"))
    counter = CountVectorizerModel.from_vocabulary(
        [str(i) for i in range(buckets)], inputCol="hashed", outputCol="features"
    )
    rows = counter.transform(train.select(hashed.alias("hashed"), F.col(label).alias("label")))
    model = LogisticRegression(family="multinomial", maxIter=20, regParam=0.01).fit(
        as_table(rows.select("features", "label"), "train-counts")
    )
    weights = np.zeros((SENTIMENT_CLASSES, buckets))
    # A class the training rows lack never wins.
    bias = np.full(SENTIMENT_CLASSES, -1e9)
    weights[: model.numClasses] = model.coefficientMatrix.toArray()
    bias[: model.numClasses] = model.interceptVector.toArray()
    return weights, bias


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
