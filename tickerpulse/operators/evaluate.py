"""Classification quality.  Each report shrinks the rows to (label, prediction) counts first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pair_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("label", "prediction").agg(F.count("*").alias("n"))


def confusion(rows: DataFrame) -> DataFrame:
    """(label, prediction, n) for every pair of classes seen on either side, zeros included."""
    counts = pair_counts(rows)
    classes = F.array_distinct(
        F.flatten(F.array(F.collect_set("label"), F.collect_set("prediction")))
    )
    grid = (
        counts.agg(classes.alias("c"))
        .select(F.explode("c").alias("label"), "c")
        .select("label", F.explode("c").alias("prediction"))
    )
    return grid.join(counts, ["label", "prediction"], "left").select(
        "label", "prediction", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")
    )


def accuracy(rows: DataFrame) -> DataFrame:
    hit = (F.col("label") == F.col("prediction")).cast("double")
    return rows.agg(F.avg(hit).alias("accuracy"))


def _ratio(top: Column, bottom: Column) -> Column:
    """0 where there is nothing to divide by."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def report(rows: DataFrame) -> DataFrame:
    """Per class: precision, recall, F1 and support."""
    same = F.col("label") == F.col("prediction")
    sides = F.array(
        F.struct(
            F.col("label").alias("class"),
            F.col("n").alias("support"),
            F.lit(0).cast("bigint").alias("predicted"),
            F.when(same, F.col("n")).otherwise(0).alias("hits"),
        ),
        F.struct(
            F.col("prediction").alias("class"),
            F.lit(0).cast("bigint").alias("support"),
            F.col("n").alias("predicted"),
            F.lit(0).cast("bigint").alias("hits"),
        ),
    )
    totals = (
        pair_counts(rows)
        .select(F.inline(sides))
        .groupBy("class")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    )
    hits, support, predicted = F.col("hits"), F.col("support"), F.col("predicted")
    return totals.select(
        "class",
        _ratio(hits, predicted).alias("precision"),
        _ratio(hits, support).alias("recall"),
        _ratio(2 * hits, support + predicted).alias("f1"),
        "support",
    )


def report_averages(rows: DataFrame) -> DataFrame:
    """Macro and support-weighted averages of the per-class report."""
    metrics = ("precision", "recall", "f1")
    support = F.sum("support")

    def weighted(c: str) -> Column:
        return _ratio(F.sum(F.col(c) * F.col("support")), support)

    macro = F.struct(
        F.lit("macro avg").alias("average"),
        *[F.avg(c).alias(c) for c in metrics],
        support.alias("support"),
    )
    by_support = F.struct(
        F.lit("weighted avg").alias("average"),
        *[weighted(c).alias(c) for c in metrics],
        support.alias("support"),
    )
    return report(rows).agg(F.array(macro, by_support).alias("a")).select(F.inline("a"))
