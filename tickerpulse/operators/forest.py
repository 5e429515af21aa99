"""A random forest over sparse counts, grown one level of all trees at a time.

Spark's own fit keeps a dense row of bins, one for each feature, for every training row: 1 MB at 2^18
features.  Here a row is its non-zero counts.  The rows are stored once; for each level every task sends its
rows down the trees grown so far and sums, by node, feature, count and class, the weights of the rows
that have one of the node's candidate features.  The sums are shuffled by node, the best split of a node
is found where its sums arrive, and the driver holds the trees alone.  Rows without a feature are the
node's total less those that have it.

As in Spark's forest, a tree takes every row a Poisson(1) number of times, a node looks at sqrt(features)
candidates (one tree: all), and leaves of one parent with the same prediction are merged.  Every count
that occurs in a node is tried as a bound, without bins.  The candidates of a node are one part,
picked at random, of a random division of all features; a level has ``DIVISIONS`` of them, and trees take
turns, so one pass over a row serves many trees.  Null labels are an error; the result is a model of
Spark's, which scores rows and is saved like any other.
"""

from __future__ import annotations

import json
import sys
import time
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import Estimator
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workspace import as_table, scratch_path

# Task functions go to the executors with the job, so these need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DIVISIONS = 4
# Sizes of pieces of work inside a task: they bound its memory and do not affect the result.
BLOCK_ROWS = 1000
BLOCK_COUNTS = 1_000_000
DENSE_CELLS = 1 << 25
HELD_SUMS = 8_000_000
BUCKET_SUMS = 2_000_000

NODES = """treeID int, nodeData struct<id int, prediction double, impurity double,
 impurityStats array<double>, rawCount bigint, gain double, leftChild int, rightChild int,
 split struct<featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int>>"""


class SparseForest(Estimator):
    """Fits ``RandomForestClassificationModel`` on a column of sparse whole-number counts."""

    def __init__(self, label: str, trees: int, depth: int, features: int, seed: int) -> None:
        super().__init__()
        # Spark's own checks of the values, and the parameters that the model shows.
        self.settings = RandomForestClassifier(
            labelCol=label, numTrees=trees, maxDepth=depth, impurity="entropy", seed=seed
        )
        if not 0 <= depth <= 30:
            raise ValueError("a depth is a number from 0 to 30")
        self.label, self.trees, self.depth = label, trees, depth
        self.features, self.seed = features, seed

    def _fit(self, dataset: DataFrame) -> RandomForestClassificationModel:
        rows, classes, values = stored_rows(dataset, self.label)
        levels = grow(rows, self.trees, self.depth, self.features, classes, values, self.seed)
        return as_spark_model(dataset.sparkSession, self, levels, classes)


def stored_rows(dataset: DataFrame, label: str) -> tuple[DataFrame, int, int]:
    """(id, label, idx, val) per row, stored; the number of classes; the largest count plus one."""
    vector = F.unwrap_udt("features")
    rows = dataset.select(
        F.col(label).cast("double").alias("label"),
        vector["indices"].alias("idx"),
        F.transform(vector["values"], lambda v: v.cast("int")).alias("val"),
    ).repartition(2 * dataset.sparkSession.sparkContext.defaultParallelism)
    table = as_table(rows.withColumn("id", F.monotonically_increasing_id()), "forest-rows")
    y = F.col("label")
    seen = table.agg(
        F.count("*").alias("n"),
        F.count_if(y.isNull() | F.isnan(y) | (y < 0) | (y != F.floor(y))).alias("bad"),
        F.max(y).alias("last"),
        F.max(F.array_max("val")).alias("most"),
    ).first()
    if not seen["n"]:
        raise ValueError("no row to train on")
    if seen["bad"]:
        raise ValueError("labels must be whole numbers from 0, without nulls")
    if seen["last"] >= 100:
        raise ValueError("more than 100 classes")
    return table, int(seen["last"]) + 1, (seen["most"] or 0) + 1


def _mixed(x: np.ndarray) -> np.ndarray:
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def bag(ids: np.ndarray, trees: int, seed: int) -> np.ndarray:
    """How often each tree takes each row: rows x trees of Poisson(1) by the row's id alone."""
    step = np.uint64(0x9E3779B97F4A7C15)
    row = _mixed(ids.astype(np.uint64) * step + np.uint64(seed & (2**63 - 1)))
    tree = np.arange(1, trees + 1, dtype=np.uint64) * step
    uniform = (_mixed(row[:, None] + tree) >> np.uint64(11)) / 2.0**53
    chance = np.cumsum(np.exp(-1) / np.cumprod(np.r_[1.0, np.arange(1.0, 18)]))
    return np.searchsorted(chance, uniform, side="right").astype(np.uint8)


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its length, one range after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(lengths.sum())


def blocks(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
    """(ids, labels, offsets, features, counts) of pieces of a batch."""
    ids, labels = batch["id"].to_numpy(), batch["label"].to_numpy().astype(np.int64)
    starts = batch["idx"].offsets.to_numpy().astype(np.int64)
    idx, val = (np.asarray(batch[c].values) for c in ("idx", "val"))
    first = 0
    while first < len(ids):
        last = int(np.searchsorted(starts, starts[first] + BLOCK_COUNTS, side="right")) - 1
        last = min(max(last, first + 1), first + BLOCK_ROWS, len(ids))
        a, b = starts[first], starts[last]
        yield ids[first:last], labels[first:last], starts[first : last + 1] - a, idx[a:b], val[a:b]
        first = last


def routed(grown, starts, idx, val, row, node, features: int) -> tuple[np.ndarray, np.ndarray]:
    """Send (row, root) pairs down all grown levels: indexes of pairs that arrive, and their nodes."""
    pair = np.arange(len(row))
    if not grown:
        return pair, node
    used = np.unique(np.concatenate([f[f >= 0] for f, _, _ in grown]))
    column = np.full(features, -1, np.int32)
    column[used] = np.arange(len(used))
    at = column[idx]
    has = np.flatnonzero(at >= 0)
    at, of = at[has], np.repeat(np.arange(len(starts) - 1), np.diff(starts))[has]
    counts = val[has]
    # Pairs that end in a leaf go on to a node after the level's last; nothing is above its bound.
    kind = np.min_scalar_type(int(val.max(initial=0)))
    never = np.iinfo(kind).max
    steps = []
    for feature, bound, left in grown:
        inner, sink = left >= 0, 2 * np.count_nonzero(left >= 0)
        floor = np.where(inner, np.minimum(bound, never), never).astype(kind)
        steps.append(
            (
                np.r_[np.where(inner, column[feature], 0), 0].astype(np.int32),
                np.r_[floor, never].astype(kind),
                np.r_[np.where(inner, left, sink), sink].astype(np.int32),
            )
        )
    step = max(1, DENSE_CELLS // max(len(used), 1))
    kept, reached = [], []
    for low in range(0, len(starts) - 1, step):
        dense = np.zeros((step, max(len(used), 1)), kind)
        a, b = np.searchsorted(of, (low, low + step))
        dense[of[a:b] - low, at[a:b]] = counts[a:b]
        cells, width = dense.ravel(), dense.shape[1]
        a, b = np.searchsorted(row, (low, low + step))
        here, place = node[a:b], (row[a:b] - low) * width
        for columns, floor, left in steps:
            here = left[here] + (cells[place + columns[here]] > floor[here])
        inner = np.flatnonzero(here < sink)
        kept.append(pair[a:b][inner])
        reached.append(here[inner])
    return np.concatenate(kept), np.concatenate(reached)


def _summed(keys: list[np.ndarray], weights: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, weight = np.concatenate(keys), np.concatenate(weights)
    if not len(key):
        return key, weight
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return key[first], np.add.reduceat(weight[order], first)


def level_sums(state, trees, features, classes, values, seed, buckets):
    """Task: weights of its rows by (node, feature, count, class), packed by bucket of nodes.

    A node's total stands under the feature after the last.
    """

    def run(batches):
        level, grown, part_of = state.value
        part = _part_size(features, trees)
        parts = features // part
        divisions = [
            (np.random.default_rng([seed, level, d]).permutation(features) // part).astype(np.int32)
            if parts > 1
            else np.zeros(features, np.int32)
            for d in range(min(DIVISIONS, trees))
        ]
        held, n_held = ([], []), 0

        def block_sums(ids, y, starts, idx, val):
            n = len(ids)
            taken = bag(ids, trees, seed)
            row, tree = np.nonzero(taken)
            weight = taken[row, tree].astype(np.int64)
            pair, node = routed(grown, starts, idx, val, row, tree, features)
            open_ = part_of[node] >= 0
            pair, node = pair[open_], node[open_].astype(np.int64)
            row, tree, weight = row[pair], tree[pair], weight[pair]
            yield (node * (features + 1) + features) * values * classes + y[row], weight
            of = np.repeat(np.arange(n), np.diff(starts))
            for d, division in enumerate(divisions):
                mine = np.flatnonzero(tree % len(divisions) == d)
                if not len(mine):
                    continue
                group = division[idx]
                order = np.argsort(group.astype(np.uint16) if parts < 65536 else group, kind="stable")
                sizes = np.bincount(group.astype(np.int64) * n + of, minlength=(parts + 1) * n)
                ends = np.cumsum(sizes)
                place = part_of[node[mine]].astype(np.int64) * n + row[mine]
                size = sizes[place]
                at = order[_ranges(ends[place] - size, size)]
                mine = np.repeat(mine, size)
                cell = (node[mine] * (features + 1) + idx[at]) * values + val[at]
                yield cell * classes + y[row[mine]], weight[mine]

        def packed():
            key, weight = _summed(*held)
            bucket = key // (classes * values * (features + 1)) % buckets
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            for b in np.flatnonzero(np.diff(cuts)):
                these = order[cuts[b] : cuts[b + 1]]
                yield int(b), key[these].tobytes(), weight[these].astype(np.uint32).tobytes()

        def flushed():
            found = list(packed())
            names = ("bucket", "keys", "weights")
            kinds = (pa.int32(), pa.binary(), pa.binary())
            columns = zip(*found) if found else ((), (), ())
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds)], names=list(names)
            )

        for batch in batches:
            for block in blocks(batch):
                key, weight = _summed(*map(list, zip(*block_sums(*block))))
                held[0].append(key)
                held[1].append(weight)
                n_held += len(key)
                if n_held > HELD_SUMS:
                    yield flushed()
                    held, n_held = ([], []), 0
        if n_held:
            yield flushed()

    return run


def _part_size(features: int, trees: int) -> int:
    return features if trees == 1 else int(np.ceil(np.sqrt(features)))


def entropy(counts: np.ndarray) -> np.ndarray:
    total = counts.sum(axis=1, keepdims=True)
    share = counts / np.maximum(total, 1)
    return -(share * np.log2(np.where(share > 0, share, 1))).sum(axis=1)


def best_splits(key: np.ndarray, weight: np.ndarray, features: int, classes: int, values: int):
    """(node, feature or -1, bound, gain, counts, counts on the left) from sorted, summed weights.

    Rows whose count is above the bound go right.  Of equal gains, the smallest feature and bound win.
    """
    cell, y = np.divmod(key, classes)
    first = np.r_[True, cell[1:] != cell[:-1]]
    counts = np.zeros((first.sum(), classes))
    counts[np.cumsum(first) - 1, y] = weight
    rest, value = np.divmod(cell[first], values)
    node, feature = np.divmod(rest, features + 1)
    is_total = feature == features
    nodes, totals = node[is_total], counts[is_total]
    feature_, bound = np.full(len(nodes), -1, np.int64), np.zeros(len(nodes))
    gain_, lefts = np.zeros(len(nodes)), np.zeros_like(totals)
    rest, value, feature, counts = (a[~is_total] for a in (rest, value, feature, counts))
    if not len(rest):
        return nodes, feature_, bound, gain_, totals, lefts
    of = np.searchsorted(nodes, node[~is_total])
    new = np.r_[True, rest[1:] != rest[:-1]]
    starts = np.flatnonzero(new)
    segment = np.cumsum(new) - 1
    ends = np.r_[starts[1:], len(rest)] - 1
    upto = np.cumsum(counts, axis=0)
    right = upto[ends[segment]] - upto + counts
    left = totals[of] - right
    n_left, n_right, n = left.sum(axis=1), right.sum(axis=1), totals.sum(axis=1)[of]
    gain = entropy(totals)[of] - n_left / n * entropy(left) - n_right / n * entropy(right)
    gain[n_left < 1] = -np.inf
    cuts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
    most = np.full(len(nodes), -np.inf)
    most[of[cuts]] = np.maximum.reduceat(gain, cuts)
    winners = np.flatnonzero((gain == most[of]) & (gain > 0))
    winners = winners[np.r_[True, of[winners][1:] != of[winners][:-1]]] if len(winners) else winners
    before = np.where(new, 0, np.r_[0, value[:-1]])
    k = of[winners]
    feature_[k], bound[k] = feature[winners], before[winners] + 0.5
    gain_[k], lefts[k] = gain[winners], left[winners]
    return nodes, feature_, bound, gain_, totals, lefts


SPLITS = "nodes binary, features binary, bounds binary, gains binary, totals binary, lefts binary"


def grow(rows, trees, depth, features, classes, values, seed) -> list[dict]:
    """Levels of nodes as arrays: tree, feature (-1: leaf), bound, left (place of the left child in
    the next level, the right one follows; -1: leaf), gain, counts by class."""
    spark = rows.sparkSession
    context = spark.sparkContext
    parts = features // _part_size(features, trees)
    seed_ = seed & (2**63 - 1)

    def of_bucket(frame):
        keys = [np.frombuffer(k, np.int64) for k in frame["keys"]]
        weights = [np.frombuffer(w, np.uint32).astype(np.int64) for w in frame["weights"]]
        found = best_splits(*_summed(keys, weights), features, classes, values)
        return pd.DataFrame([[a.tobytes() for a in found]], columns=[c.split()[0] for c in SPLITS.split(", ")])

    levels, tree = [], np.arange(trees)
    counts, open_ = np.zeros((trees, classes)), np.ones(trees, bool)
    pairs = None
    for at in range(depth + 1):
        k = len(tree)
        level = {
            "tree": tree, "feature": np.full(k, -1, np.int32), "bound": np.zeros(k),
            "left": np.full(k, -1, np.int32), "gain": np.zeros(k), "counts": counts,
        }
        levels.append(level)
        if not open_.any() or (at == depth and at > 0):
            break
        if k * (features + 1) * values * classes >= 2**63:
            raise ValueError("too many nodes, features and counts for one key")
        picked = np.random.default_rng([seed_, at]).integers(0, parts, k).astype(np.int32)
        picked[~open_] = -1
        grown = [(x["feature"], x["bound"], x["left"]) for x in levels[:-1]]
        state = context.broadcast((at, grown, picked))
        buckets = 2 * context.defaultParallelism
        if pairs:
            buckets = max(buckets, int(pairs // BUCKET_SUMS))
        task = level_sums(state, trees, features, classes, values, seed_, buckets)
        sums = rows.mapInArrow(task, "bucket int, keys binary, weights binary")
        for found in sums.groupBy("bucket").applyInPandas(of_bucket, SPLITS).collect():
            nodes, feature, bound, gain, totals, lefts = (
                np.frombuffer(b, kind)
                for b, kind in zip(found, (np.int64, np.int64, float, float, float, float))
            )
            level["feature"][nodes], level["bound"][nodes] = feature, bound
            level["gain"][nodes] = gain
            level["counts"][nodes] = totals.reshape(-1, classes)
            level.setdefault("lefts", np.zeros((k, classes)))[nodes] = lefts.reshape(-1, classes)
        state.destroy()
        pairs = level["counts"][open_].sum()
        split = np.flatnonzero(level["feature"] >= 0) if depth else np.empty(0, np.int64)
        if not len(split):
            level["feature"][:] = -1
            break
        level["left"][split] = 2 * np.arange(len(split))
        tree = np.repeat(level["tree"][split], 2)
        counts = np.empty((2 * len(split), classes))
        counts[0::2] = level["lefts"][split]
        counts[1::2] = level["counts"][split] - level["lefts"][split]
        open_ = np.count_nonzero(counts, axis=1) > 1
    return levels


def merged(levels: list[dict]) -> None:
    """Make a leaf of every node whose children are leaves of one prediction, from below."""
    for level, below in zip(levels[-2::-1], levels[:0:-1]):
        split = np.flatnonzero(level["left"] >= 0)
        left = level["left"][split]
        vote = below["counts"].argmax(axis=1)
        leaf = below["left"] < 0
        same = split[leaf[left] & leaf[left + 1] & (vote[left] == vote[left + 1])]
        level["left"][same] = -1


def _numbered(levels: list[dict]) -> None:
    """Number the nodes of each tree in preorder; those below a merged node get -1."""
    for level, below in zip(levels[::-1], [None, *levels[:0:-1]]):
        level["size"] = np.ones(len(level["tree"]), np.int64)
        if below is not None:
            split = np.flatnonzero(level["left"] >= 0)
            left = level["left"][split]
            level["size"][split] += below["size"][left] + below["size"][left + 1]
    levels[0]["id"] = np.zeros(len(levels[0]["tree"]), np.int64)
    for level, below in zip(levels, levels[1:]):
        below["id"] = np.full(len(below["tree"]), -1, np.int64)
        split = np.flatnonzero((level["left"] >= 0) & (level["id"] >= 0))
        left = level["left"][split]
        below["id"][left] = level["id"][split] + 1
        below["id"][left + 1] = level["id"][split] + 1 + below["size"][left]


def _node_table(level: dict, below: dict | None) -> pa.Table:
    """Nodes of a level in the columns of Spark's stored forests."""
    kept = level["id"] >= 0
    left, counts = level["left"][kept], level["counts"][kept]
    inner = left >= 0
    children = np.full((2, len(left)), -1, np.int64)
    if inner.any():
        children[:, inner] = below["id"][left[inner]], below["id"][left[inner] + 1]
    at = np.r_[0, np.cumsum(inner)].astype(np.int32)
    split = pa.StructArray.from_arrays(
        [
            pa.array(np.where(inner, level["feature"][kept], -1), pa.int32()),
            pa.ListArray.from_arrays(at, pa.array(level["bound"][kept][inner], pa.float64())),
            pa.array(np.full(len(left), -1), pa.int32()),
        ],
        ["featureIndex", "leftCategoriesOrThreshold", "numCategories"],
    )
    width = counts.shape[1]
    node = {
        "id": pa.array(level["id"][kept], pa.int32()),
        "prediction": pa.array(counts.argmax(axis=1), pa.float64()),
        "impurity": pa.array(entropy(counts)),
        "impurityStats": pa.ListArray.from_arrays(
            np.arange(0, counts.size + 1, width, dtype=np.int32), counts.ravel()
        ),
        "rawCount": pa.array(counts.sum(axis=1).astype(np.int64)),
        "gain": pa.array(np.where(inner, level["gain"][kept], -1.0)),
        "leftChild": pa.array(children[0], pa.int32()),
        "rightChild": pa.array(children[1], pa.int32()),
        "split": split,
    }
    return pa.table(
        {
            "treeID": pa.array(level["tree"][kept], pa.int32()),
            "nodeData": pa.StructArray.from_arrays(list(node.values()), list(node)),
        }
    )


def as_spark_model(
    spark: SparkSession, forest: SparseForest, levels: list[dict], classes: int
) -> RandomForestClassificationModel:
    """The trees as a model of Spark's, by way of its stored form."""
    merged(levels)
    _numbered(levels)
    nodes = pa.concat_tables(
        [_node_table(a, b) for a, b in zip(levels, [*levels[1:], None])]
    )
    path = scratch_path(spark, "forest")
    spark.createDataFrame(nodes, NODES).write.parquet(f"{path}/data")

    def described(kind: str, uid: str, **more) -> str:
        plain = {p.name: v for p, v in forest.settings._defaultParamMap.items()}
        given = {p.name: v for p, v in forest.settings._paramMap.items()}
        if kind.startswith("Decision"):
            known = {p.name for p in DecisionTreeClassifier().params}
            plain = {n: v for n, v in plain.items() if n in known}
            given = {n: v for n, v in given.items() if n in known}
        about = {
            "class": f"org.apache.spark.ml.classification.{kind}",
            "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": uid,
            "paramMap": given, "defaultParamMap": plain,
        }
        return json.dumps(about | more)

    trees = [
        (t, described("DecisionTreeClassificationModel", f"dtc_{forest.uid}_{t}"), 1.0)
        for t in range(forest.trees)
    ]
    spark.createDataFrame(trees, "_1 int, _2 string, _3 double").write.parquet(f"{path}/treesMetadata")
    whole = described(
        "RandomForestClassificationModel", forest.settings.uid,
        numFeatures=forest.features, numClasses=classes, numTrees=forest.trees,
    )
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    return RandomForestClassificationModel.load(path)

