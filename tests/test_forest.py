"""The forest over sparse counts: the same splits as a plain search, in memory that counts only what occurs."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from tickerpulse.operators import forest, models


def plain_best(rows, features, classes):
    """(gain, feature, bound) of the best split of (label, weight, counts) rows, by trying all."""
    total = np.zeros((1, classes))
    for y, w, _ in rows:
        total[0, y] += w
    best = (0.0, -1, 0.0)
    for f in features:
        for bound in sorted({c.get(f, 0) + 0.5 for _, _, c in rows}):
            left = np.zeros((1, classes))
            for y, w, c in rows:
                left[0, y] += w * (c.get(f, 0) < bound)
            right = total - left
            if left.sum() and right.sum():
                share = left.sum() / total.sum()
                gain = (
                    forest.entropy(total)
                    - share * forest.entropy(left)
                    - (1 - share) * forest.entropy(right)
                )[0]
                if gain > best[0] + 1e-12:
                    best = (gain, f, bound)
    return best


def sparse_rows(n, features, seed):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(n):
        of = rng.choice(features, 5, replace=False)
        rows.append((int(rng.integers(3)), {int(f): int(rng.integers(1, 4)) for f in of}))
    return rows


def table(spark, rows, features):
    data = [(float(y), Vectors.sparse(features, c)) for y, c in rows]
    return spark.createDataFrame(data, ["Label", "features"])


def test_single_tree_is_grown_by_the_best_split_of_all_features(spark):
    rows = sparse_rows(60, 12, 5)
    stored, classes, values = forest.stored_rows(table(spark, rows, 12), "Label")
    levels = forest.grow(stored, 1, 4, 12, classes, values, 7)
    kept = sorted(stored.collect(), key=lambda r: r["id"])
    taken = forest.bag(np.array([r["id"] for r in kept]), 1, 7)[:, 0]
    at = {0: [(int(r["label"]), int(w), dict(zip(r["idx"], r["val"]))) for r, w in zip(kept, taken) if w]}
    n_split = 0
    for level in levels:
        below = {}
        for node, members in at.items():
            counts = np.bincount([y for y, _, _ in members], [w for _, w, _ in members], classes)
            assert counts.tolist() == level["counts"][node].tolist()
            if level["left"][node] < 0:
                continue
            n_split += 1
            gain, feature, bound = plain_best(members, range(12), classes)
            assert level["gain"][node] == pytest.approx(gain)
            assert (level["feature"][node], level["bound"][node]) == (feature, bound)
            left = level["left"][node]
            below[left] = [m for m in members if m[2].get(feature, 0) < bound]
            below[left + 1] = [m for m in members if m[2].get(feature, 0) > bound]
        at = below
    assert n_split >= 5 and len(levels) == 5


def test_forest_does_not_depend_on_the_pieces_of_work(spark, monkeypatch):
    rows, _, values = forest.stored_rows(table(spark, sparse_rows(80, 30, 3), 30), "Label")
    rows = rows.coalesce(1)

    def grown():
        return [
            {k: v.tolist() for k, v in level.items()} for level in forest.grow(rows, 6, 5, 30, 3, values, 1)
        ]

    want = grown()
    for name, size in (("BLOCK_ROWS", 7), ("BLOCK_COUNTS", 20), ("DENSE_CELLS", 40), ("HELD_SUMS", 50)):
        monkeypatch.setattr(forest, name, size)
    assert grown() == want


def test_forest_needs_no_dense_row(spark):
    """2^25 features: a dense row would take 128 MB, all of them 7.7 GB."""
    words = ("loss drop", "gain rise")
    data = [(f"{words[i % 2]} filler{i}", i % 2) for i in range(60)]
    toy = spark.createDataFrame(data, "article string, Label int")
    model = models.bigram_forest(trees=1, depth=3, features=1 << 25).fit(toy)
    assert model.transform(toy).filter("prediction = Label").count() == 60


def test_odd_labels_are_an_error_and_ends_of_the_range_work(spark):
    good = table(spark, sparse_rows(20, 6, 1), 6)
    for odd in ("cast(null as double)", "-1D", "0.5D", "double('NaN')"):
        with pytest.raises(ValueError):
            forest.SparseForest("Label", 2, 2, 6, 0).fit(good.selectExpr(f"{odd} AS Label", "features"))
    with pytest.raises(ValueError):
        forest.SparseForest("Label", 2, 2, 6, 0).fit(good.limit(0))
    one = forest.SparseForest("Label", 3, 2, 6, 0).fit(good.selectExpr("0D AS Label", "features"))
    assert one.totalNumNodes == 3
    empty = spark.createDataFrame([(float(i % 2), Vectors.sparse(6, {})) for i in range(8)], ["Label", "features"])
    assert forest.SparseForest("Label", 3, 2, 6, 0).fit(empty).totalNumNodes == 3
