"""A small network over fixed-width features: one relu layer, dropout, a sigmoid unit, Adam.

Training is data-parallel.  The rows are stored once, split into as many batches as an epoch has
steps; a step reads its own batch only.  Every task sums the gradient of its rows, the sums are added
up in two levels on the executors, and the driver, which holds nothing but the weights, makes the
step.  Batches and dropout depend on a row's id, the step and the seed alone, and partial sums are
added in a fixed order, so a task that is run again gives the same weights.  The state is stored after
every epoch, and training with the same path goes on from the last one.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workspace import scratch_path

HIDDEN = 64
DROPOUT = 0.2
# Adam's usual constants.
RATE, BETA_1, BETA_2, EPSILON = 1e-3, 0.9, 0.999, 1e-7
STATE = "epoch int, step int, state string"


@dataclass
class Head:
    """Weights as one flat array: hidden weights, hidden biases, output weights, output bias."""

    width: int
    hidden: int
    flat: np.ndarray

    @classmethod
    def fresh(cls, width: int, hidden: int, seed: int) -> Head:
        rng = np.random.default_rng(seed)
        first = rng.uniform(-1, 1, width * hidden) * np.sqrt(6 / (width + hidden))
        last = rng.uniform(-1, 1, hidden) * np.sqrt(6 / (hidden + 1))
        return cls(width, hidden, np.concatenate([first, np.zeros(hidden), last, [0.0]]))

    def parts(self):
        a, h = self.width * self.hidden, self.hidden
        return (
            self.flat[:a].reshape(self.width, h),
            self.flat[a : a + h],
            self.flat[a + h : a + 2 * h],
            self.flat[-1],
        )

    def probability(self, x: np.ndarray) -> np.ndarray:
        w, b, v, c = self.parts()
        return _sigmoid(np.maximum(x @ w + b, 0) @ v + c)

    def transform(self, rows: DataFrame, key: str, features: str = "features") -> DataFrame:
        """(key, probability, prediction) of rows with an array of features."""
        head = self

        def run(frames):
            for frame in frames:
                p = head.probability(_matrix(frame[features], head.width))
                yield pd.DataFrame({key: frame[key], "probability": p, "prediction": (p >= 0.5).astype("int32")})

        kind = rows.schema[key].dataType.simpleString()
        source = rows.filter(F.col(features).isNotNull()).select(key, features)
        return source.mapInPandas(run, f"{key} {kind}, probability double, prediction int")


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    return np.stack(column.to_list()).astype(float) if len(column) else np.empty((0, width))


def _kept(ids: np.ndarray, step: int, hidden: int, seed: int, dropout: float) -> np.ndarray:
    """Which hidden units a row keeps in a step, as factors."""
    x = ids.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)
    x = x + np.arange(hidden, dtype=np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
    x = x + np.uint64((step * 1_000_003 + seed) & (2**63 - 1))
    for shift in (30, 27, 31):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(0x94D049BB133111EB)
    uniform = (x >> np.uint64(11)) / 2.0**53
    return (uniform >= dropout) / (1 - dropout)


def gradient(head: Head, x: np.ndarray, y: np.ndarray, kept: np.ndarray) -> np.ndarray:
    """Summed gradient of the cross-entropy over the rows."""
    w, b, v, c = head.parts()
    z = x @ w + b
    a = np.maximum(z, 0) * kept
    delta = _sigmoid(a @ v + c) - y
    back = delta[:, None] * v * kept * (z > 0)
    return np.concatenate([(x.T @ back).ravel(), back.sum(0), a.T @ delta, [delta.sum()]])


def _summed(batch: DataFrame, head: Head, step: int, seed: int, dropout: float, fan_in: int):
    """(rows, summed gradient) of a stored batch."""

    def of_task(frames):
        from pyspark import TaskContext

        total, n = np.zeros(len(head.flat)), 0
        for frame in frames:
            if len(frame):
                kept = _kept(frame["id"].to_numpy(), step, head.hidden, seed, dropout)
                x = _matrix(frame["features"], head.width)
                total += gradient(head, x, frame["label"].to_numpy(dtype=float), kept)
                n += len(frame)
        part = TaskContext.get().partitionId()
        yield pd.DataFrame({"part": [part], "n": [n], "total": [total.tobytes()]})

    def of_group(key, frame):
        frame = frame.sort_values("part")
        total = sum(np.frombuffer(t) for t in frame["total"])
        return pd.DataFrame({"part": [frame["part"].min()], "n": [frame["n"].sum()], "total": [total.tobytes()]})

    schema = "part int, n bigint, total binary"
    partial = batch.select("id", "features", "label").mapInPandas(of_task, schema)
    groups = partial.groupBy(F.floor(F.col("part") / fan_in)).applyInPandas(of_group, schema)
    rows = groups.sort("part").collect()
    total = sum((np.frombuffer(r["total"]) for r in rows), np.zeros(len(head.flat)))
    return sum(r["n"] for r in rows), total


def _stored_state(spark: SparkSession, path: str) -> dict | None:
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not root.getFileSystem(spark._jsc.hadoopConfiguration()).exists(root):
        return None
    last = spark.read.schema(STATE).parquet(path).orderBy(F.desc("epoch")).first()
    return None if last is None else {"epoch": last["epoch"], "step": last["step"], **json.loads(last["state"])}


def train(
    rows: DataFrame,
    key: str,
    label: str,
    features: str = "features",
    hidden: int = HIDDEN,
    dropout: float = DROPOUT,
    epochs: int = 5,
    steps: int = 10,
    rate: float = RATE,
    seed: int = 1,
    path: str | None = None,
    fan_in: int = 32,
) -> Head:
    """Fit a head on rows of a whole-number ``key``, an array of features and a label of 0 or 1.

    Rows with a null in any of the three take no part.  ``steps`` is the number of batches of an
    epoch, so a batch grows with the table and is spread over the cluster.  ``path`` is a folder for
    the state; without one training starts afresh.
    """
    spark = rows.sparkSession
    usable = rows.select(
        F.col(key).cast("long").alias("id"),
        F.col(features).cast("array<double>").alias("features"),
        F.col(label).cast("int").alias("label"),
    ).dropna()
    slot = F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(steps)).alias("slot")
    stored = scratch_path(spark, "head-rows")
    usable.select("*", slot).write.partitionBy("slot").parquet(stored)
    table = spark.read.schema("id long, features array<double>, label int, slot int").parquet(stored)
    first = table.select(F.size("features").alias("n")).first()
    if first is None:
        raise ValueError("no row to train on")
    head = Head.fresh(first["n"], hidden, seed)
    mean, spread = np.zeros_like(head.flat), np.zeros_like(head.flat)
    epoch, step = 0, 0
    if path and (state := _stored_state(spark, path)):
        epoch, step = state["epoch"], state["step"]
        head.flat, mean, spread = (np.array(state[k]) for k in ("flat", "mean", "spread"))
    for epoch in range(epoch + 1, epochs + 1):
        for batch in range(steps):
            step += 1
            n, total = _summed(table.filter(F.col("slot") == batch), head, step, seed, dropout, fan_in)
            if not n:
                continue
            g = total / n
            mean = BETA_1 * mean + (1 - BETA_1) * g
            spread = BETA_2 * spread + (1 - BETA_2) * g * g
            move = (mean / (1 - BETA_1**step)) / (np.sqrt(spread / (1 - BETA_2**step)) + EPSILON)
            head.flat = head.flat - rate * move
        if path:
            state = {"flat": head.flat.tolist(), "mean": mean.tolist(), "spread": spread.tolist()}
            spark.createDataFrame([(epoch, step, json.dumps(state))], STATE).coalesce(1).write.mode(
                "append"
            ).parquet(path)
    return head
