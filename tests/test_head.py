import numpy as np
import pytest
from pyspark.sql import functions as F

from tickerpulse.operators import head as heads


@pytest.fixture(scope="module")
def rings(spark):
    """Points inside a ring are 1, outside 0: no straight line parts them."""
    rng = np.random.default_rng(3)
    x = rng.uniform(-2, 2, (600, 2))
    radius = np.hypot(x[:, 0], x[:, 1])
    x, radius = x[np.abs(radius - 1.2) > 0.15], radius[np.abs(radius - 1.2) > 0.15]
    rows = [(i, p.tolist(), int(r < 1.2)) for i, (p, r) in enumerate(zip(x, radius, strict=True))]
    return spark.createDataFrame(rows, "id long, features array<double>, label int")


OPTIONS = {"hidden": 24, "epochs": 12, "steps": 4, "rate": 0.05}


def test_learns_what_no_line_can_part(rings):
    head = heads.train(rings.repartition(3), "id", "label", **OPTIONS)
    scored = head.transform(rings, "id").join(rings, "id")
    right = scored.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    assert right >= 0.97


def test_gradient_is_the_slope(rings):
    head = heads.Head.fresh(2, 5, 1)
    x = np.array([[0.3, -1.0], [1.5, 0.2], [-0.4, 0.9]])
    y, kept = np.array([1.0, 0.0, 1.0]), heads._kept(np.arange(3), 7, 5, 1, 0.4)
    assert set(np.unique(kept)) <= {0.0, 1 / 0.6}

    def loss(flat):
        w, b, v, c = heads.Head(2, 5, flat).parts()
        p = heads._sigmoid((np.maximum(x @ w + b, 0) * kept) @ v + c)
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).sum()

    got = heads.gradient(head, x, y, kept)
    for i in range(len(got)):
        step = np.zeros(len(got))
        step[i] = 1e-6
        assert abs((loss(head.flat + step) - loss(head.flat - step)) / 2e-6 - got[i]) < 1e-5


def test_goes_on_from_the_stored_epoch(rings, tmp_path):
    options = OPTIONS | {"epochs": 3}
    whole = heads.train(rings.coalesce(2), "id", "label", **options)
    path = str(tmp_path / "state")
    heads.train(rings.coalesce(2), "id", "label", **options | {"epochs": 1}, path=path)
    resumed = heads.train(rings.coalesce(2), "id", "label", **options, path=path)
    assert np.allclose(whole.flat, resumed.flat, rtol=0, atol=1e-12)
    again = heads.train(rings.coalesce(2), "id", "label", **options, path=path)
    assert np.array_equal(again.flat, resumed.flat)


def test_nulls_take_no_part(spark, rings):
    bad = spark.createDataFrame(
        [(None, [1.0, 1.0], 1), (9001, None, 1), (9002, [0.0, 0.0], None)],
        "id long, features array<double>, label int",
    )
    options = OPTIONS | {"epochs": 1}
    one = heads.train(rings.coalesce(1), "id", "label", **options)
    two = heads.train(rings.unionByName(bad).coalesce(1), "id", "label", **options)
    assert np.allclose(one.flat, two.flat)
    assert two.transform(bad, "id").count() == 2
    with pytest.raises(ValueError, match="no row"):
        heads.train(bad, "id", "label", **options)
