"""Centroid clustering of integer vectors (Lloyd's rounds), in DataFrame expressions only.

Components become integers, ``floor(scale * x)``, so that every sum, distance and mean is exact and
no result depends on row order or partitioning.  The integer vectors are stored once.  A round is
one scan of them: ``zip_with`` and ``aggregate`` compute the squared distance to every centroid,
which stands in the plan as a constant array; ``array_min`` over structs (distance, number) picks
the nearest one; one sum per component and cluster, pre-aggregated in every task, gives the next
centroids.  Only ``k`` rows of sums come to the driver, however large the table or a cluster is.
A round that changes no centroid ends the search, as all later ones would repeat it.

Vectors that are null, of another width, or hold null or non-finite components take no part.  Seeds
are the vectors with the smallest hash of ``<seed>:<id>``; rows of the same id are told apart by
their components, so equal rows may seed several centroids, of which the first wins every tie.  A
null id is no seed while others are left, and comes out as it is.  With fewer than ``k`` vectors
there are as many clusters as vectors; an empty table gives an empty result.  Other columns do not
matter, whatever their names.  A component beyond 2**27 after scaling would let distances overflow,
which raises an error that says so.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..workspace import as_table

LIMIT = 1 << 27


def integer_vectors(
    vectors: DataFrame, width: int, scale: int, id_column: str, vector: str
) -> DataFrame:
    """``vec_id, v`` (array of long) of the vectors that take part."""
    x = F.col(vector).cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & (F.abs(c) < float("inf")) & ~F.isnan(c))
    # The test comes before the scaling, which would fail on what it rules out.
    whole = F.when((F.size(x) == width) & finite, x)
    scaled = F.transform(whole, lambda c: F.floor(c * F.lit(float(scale))))
    return vectors.select(F.col(id_column).cast("long").alias("vec_id"), scaled.alias("v")).filter(
        "v IS NOT NULL"
    )


def first_centroids(stored: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The ``k`` vectors of smallest hash; every task sends at most ``k`` rows."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = stored.orderBy(key.asc_nulls_last(), "v").limit(k).collect()
    return [list(r["v"]) for r in rows]


def _constant(centroid: list[int]) -> Column:
    # One call instead of one per component.
    return F.expr(f"array({', '.join(f'{c}L' for c in centroid)})")


def nearest(v: Column | str, centroids: list[list[int]]) -> Column:
    """Struct (distance, cluster) of the nearest centroid, the smaller number in a tie."""
    vector = F.col(v) if isinstance(v, str) else v

    def distance(centroid: list[int]) -> Column:
        squares = F.zip_with(vector, _constant(centroid), lambda a, b: (a - b) * (a - b))
        return F.aggregate(squares, F.lit(0).cast("long"), lambda total, x: total + x)

    return F.array_min(
        F.array(
            *[
                F.struct(distance(c).alias("distance"), F.lit(i).alias("cluster"))
                for i, c in enumerate(centroids)
            ]
        )
    )


def assigned(stored: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """``vec_id, v, cluster, distance`` of every vector."""
    return stored.select("vec_id", "v", nearest("v", centroids).alias("best")).select(
        "vec_id", "v", F.col("best.cluster").alias("cluster"), F.col("best.distance").alias("distance")
    )


def next_centroids(stored: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Every centroid that has vectors moves to the floor of their mean, component by component."""
    width = len(centroids[0])
    sums = [F.expr(f"sum(v[{i}]) AS s{i}") for i in range(width)]
    moved = [list(c) for c in centroids]
    for row in assigned(stored, centroids).groupBy("cluster").agg(F.count("*").alias("n"), *sums).collect():
        moved[row["cluster"]] = [row[f"s{i}"] // row["n"] for i in range(width)]
    return moved


def fit(stored: DataFrame, k: int, rounds: int, seed: int) -> list[list[int]]:
    """Centroids after ``rounds`` rounds over the table of ``integer_vectors``."""
    centroids = first_centroids(stored, k, seed)
    for _ in range(rounds if centroids else 0):
        moved = next_centroids(stored, centroids)
        if moved == centroids:
            break
        centroids = moved
    return centroids


def cluster(
    vectors: DataFrame,
    k: int = 8,
    rounds: int = 10,
    width: int = 64,
    scale: int = 1024,
    seed: int = 3,
    id_column: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """Per vector: ``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``."""
    stored = as_table(integer_vectors(vectors, width, scale, id_column, vector), "integer-vectors")
    most = stored.agg(F.max(F.array_max(F.transform("v", F.abs)))).first()[0] or 0
    if most > LIMIT:
        raise ValueError(f"a component of {most} after scaling is beyond {LIMIT}")
    centroids = fit(stored, k, rounds, seed)
    if not centroids:
        return stored.selectExpr(
            "vec_id", "0 AS cluster", "0L AS distance", "0L AS cluster_inertia", "0L AS inertia",
            "'' AS centroid_sha256",
        )
    placed = as_table(assigned(stored, centroids).drop("v"), "assigned-vectors")
    # One row per cluster.
    inertia = {
        r["cluster"]: r["total"]
        for r in placed.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()
    }
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    totals = F.array(*[F.lit(inertia.get(i, 0)).cast("long") for i in range(len(centroids))])
    return placed.select(
        "vec_id",
        "cluster",
        "distance",
        F.get(totals, F.col("cluster")).alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"),
        F.get(F.array(*map(F.lit, digests)), F.col("cluster")).alias("centroid_sha256"),
    )
