"""Exact top-k inner products by KD-trees, one per shard of vectors.

Vectors become integers (floor of 256 times each component), so scores are exact.  Shards of
bounded size are built where the vectors lie: median splits along the widest side of the node's
box give leaves of contiguous rows, kept with their tight boxes.  A query takes nodes best first:
from a queue of opened nodes always that of the largest bound (the largest inner product that any
point of its box could have), until that bound falls short of the query's k-th best score so far.
Bounds are computed for opened nodes only.

The k-th score is propagated: a first pass looks only into each query's best leaf of each shard; the
k-th best score over all shards is a lower bound for the second pass, and within a task every
shard passes its k-th scores on to the next.

Queries are handled in blocks of a fixed number, each block against all shards, because a block
of bounded size can be sent to every task.

Vectors that are null, or hold a null or a non-finite component, take no part, nor do rows with a
null ``vec_id``.  Only vectors of the same length are compared; empty vectors score 0 with each
other.  A candidate with the query's ``vec_id`` counts as the query's own row.  Of queries that
repeat a ``vec_id`` the smallest vector counts.  Ties go to the smaller ``vec_id``.  Components of
2^53 / 256 and more are beyond exact doubles: scores are then computed with unbounded integers and
kept within the range of a long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..workspace import as_table

SCALE = 256
SHARD_ROWS = 8_192
LEAF_ROWS = 128
#: Queries that are sent to all tasks at once (64 components: 2 MB).
QUERY_BLOCK = 4_096

_LONG = 2**63 - 1


def usable_vectors(df: DataFrame, id_column: str, vector: str) -> DataFrame:
    """``vec_id, vec`` (array of double) of the rows that take part."""
    vec = F.col(vector).cast("array<double>")
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return df.select(F.col(id_column).cast("long").alias("vec_id"), vec.alias("vec")).filter(
        F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & ~bad
    )


def leaf_order(points: np.ndarray, ids: np.ndarray, leaf_rows: int = LEAF_ROWS):
    """Rows in the order of a KD-tree's leaves, and the tree's levels.

    A level lists the (start, stop) of its nodes; children follow their parent's order.  Equal
    coordinates are split by id, so a node of equal points is halved like any other.
    """
    order = np.argsort(ids, kind="stable")
    levels = [[(0, len(ids))]]
    while any(stop - start > leaf_rows for start, stop in levels[-1]):
        nodes = []
        for start, stop in levels[-1]:
            if stop - start <= leaf_rows:
                nodes.append((start, stop))
                continue
            own = points[order[start:stop]]
            side = int(np.argmax(own.max(axis=0) - own.min(axis=0))) if points.shape[1] else 0
            if points.shape[1]:
                order[start:stop] = order[start:stop][np.argsort(own[:, side], kind="stable")]
            middle = (start + stop) // 2
            nodes += [(start, middle), (middle, stop)]
        levels.append(nodes)
    for start, stop in levels[-1]:
        order[start:stop] = np.sort(order[start:stop])
    # Rows were in order of id, so sorting positions within a leaf sorts ids again.
    return order, levels


class Tree:
    """A KD-tree over the rows of one shard; nodes are numbered, parents before their children."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, leaf_rows: int = LEAF_ROWS):
        by_id = np.argsort(ids, kind="stable")
        ids, points = ids[by_id], points[by_id]
        order, levels = leaf_order(points, ids, leaf_rows)
        self.ids, self.points = ids[order], points[order]
        self.nodes = list(levels[0])
        self.children: list[tuple[int, int] | None] = [None]
        numbers = [0]
        for above, below in zip(levels, levels[1:], strict=False):
            parents, numbers, rest = numbers, [], iter(below)
            for number, span in zip(parents, above, strict=True):
                first = next(rest)
                if first == span:
                    numbers.append(number)
                    continue
                pair = (len(self.nodes), len(self.nodes) + 1)
                self.nodes += [first, next(rest)]
                self.children[number] = pair
                self.children += [None, None]
                numbers += pair
        self.leaves = levels[-1]
        self.low = np.empty((len(self.nodes), points.shape[1]))
        self.high = np.empty_like(self.low)
        self.least_id = np.empty(len(self.nodes), dtype=np.int64)
        for number in reversed(range(len(self.nodes))):
            pair = self.children[number]
            if pair is None:
                start, stop = self.nodes[number]
                self.low[number] = self.points[start:stop].min(axis=0)
                self.high[number] = self.points[start:stop].max(axis=0)
                self.least_id[number] = self.ids[start]
            else:
                left, right = pair
                self.low[number] = np.minimum(self.low[left], self.low[right])
                self.high[number] = np.maximum(self.high[left], self.high[right])
                self.least_id[number] = min(self.least_id[left], self.least_id[right])

    def bound(self, number: int, up: np.ndarray, down: np.ndarray) -> np.ndarray:
        """Largest inner products that points of a node's box could have."""
        return up @ self.high[number] + down @ self.low[number]


class Best:
    """The k best (score, id) of each query of a block so far."""

    def __init__(self, ids: np.ndarray, k: int, floor: np.ndarray | None = None):
        self.query_ids, self.k = ids, k
        self.scores = np.full((len(ids), k), -np.inf)
        self.ids = np.full((len(ids), k), _LONG)
        self.floor = np.full(len(ids), -np.inf) if floor is None else floor

    def need(self) -> np.ndarray:
        """Scores below these can't be among the best."""
        return np.maximum(self.floor, self.scores[:, -1])

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Scores of the queries ``rows`` (down) with the candidates ``ids`` (across)."""
        scores = np.where(self.query_ids[rows, None] == ids, -np.inf, scores)
        able = (scores >= self.need()[rows, None]) & (scores > -np.inf)
        some = able.any(axis=1)
        for r, row_scores, row_able in zip(rows[some], scores[some], able[some], strict=True):
            s = np.concatenate([self.scores[r], row_scores[row_able]])
            i = np.concatenate([self.ids[r], ids[row_able]])
            top = np.lexsort((i, -s))[: self.k]
            self.scores[r], self.ids[r] = s[top], i[top]


def search(tree: Tree, queries: np.ndarray, best: Best, only_best_leaf: bool = False) -> int:
    """Update ``best`` with a tree's rows; returns the number of leaf visits.

    Best-first: each query takes the node of largest bound from its queue, until that bound falls
    short of its k-th score.  An inner node gives way to its children, whose bounds are computed
    then; a leaf's rows are scored.  All queries take one node a round, and those that took the
    same one are handled together.  The queues are rows of one array, with -inf for what is not
    in them.
    """
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    queue = np.full((len(queries), len(tree.nodes)), -np.inf)
    queue[:, 0] = tree.bound(0, up, down)
    going = np.arange(len(queries))
    visits = 0
    while len(going):
        taken = queue[going].argmax(axis=1)
        reach = queue[going, taken]
        go = (reach >= best.need()[going]) & (reach > -np.inf)
        going, taken, reach = going[go], taken[go], reach[go]
        queue[going, taken] = -np.inf
        # A node that can only tie helps with a smaller id.
        useful = (reach > best.scores[going, -1]) | (tree.least_id[taken] < best.ids[going, -1])
        rows, node = going[useful], taken[useful]
        by_node = np.argsort(node, kind="stable")
        rows, node = rows[by_node], node[by_node]
        cuts = np.flatnonzero(np.append(True, node[1:] != node[:-1])) if len(node) else []
        ended = []
        for at, stop in zip(cuts, [*cuts[1:], len(node)], strict=False):
            group = rows[at:stop]
            pair = tree.children[node[at]]
            if pair is None:
                a, b = tree.nodes[node[at]]
                best.add(group, queries[group] @ tree.points[a:b].T, tree.ids[a:b])
                visits += len(group)
                ended.append(group)
                continue
            for child in pair:
                queue[group, child] = tree.bound(child, up[group], down[group])
        if only_best_leaf and ended:
            going = np.setdiff1d(going, np.concatenate(ended))
    return visits


def _exact(dim: int, *parts: np.ndarray) -> bool:
    """Whether inner products of these integers are exact in doubles."""
    most = [float(np.abs(p).max()) if p.size else 0.0 for p in parts]
    return max(1, dim) * most[0] * most[-1] < 2**52


def _to_integers(vec: pa.Array, dim: int) -> np.ndarray:
    flat = np.asarray(vec.flatten(), dtype=np.float64).reshape(-1, dim) if dim else np.zeros((len(vec), 0))
    return np.floor(SCALE * flat)


def _plain_scores(queries: np.ndarray, points: np.ndarray) -> list[list[int]]:
    """Unbounded integer scores, kept within a long."""
    q = [[int(x) for x in row] for row in queries.tolist()]
    p = [[int(x) for x in row] for row in points.tolist()]
    return [
        [max(-_LONG, min(_LONG, sum(a * b for a, b in zip(x, y, strict=True)))) for y in p] for x in q
    ]


def _shards(batches, rows: int):
    """(ids, vectors) of a task's rows in shards of one length of vector and a bounded size."""
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    count: dict[int, int] = {}

    def taken(dim):
        parts = held.pop(dim)
        count.pop(dim)
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    for batch in batches:
        ids, vec = batch.column("vec_id").to_numpy(), batch.column("vec")
        sizes = vec.value_lengths().to_numpy()
        for dim in np.unique(sizes).tolist():
            chosen = np.flatnonzero(sizes == dim)
            for at in range(0, len(chosen), rows):
                part = chosen[at : at + rows]
                points = _to_integers(vec.take(pa.array(part)), dim)
                held.setdefault(dim, []).append((ids[part], points))
                count[dim] = count.get(dim, 0) + len(part)
                if count[dim] >= rows:
                    yield taken(dim)
    for dim in list(held):
        yield taken(dim)


def _candidates(vectors: DataFrame, block: list, k: int, probe: bool, floors: dict) -> DataFrame:
    """``query_id, vec_id, score``: best candidates of a block's queries in each task."""
    by_dim: dict[int, tuple[list[int], list[list[float]]]] = {}
    for query_id, vec in block:
        ids, rows = by_dim.setdefault(len(vec), ([], []))
        ids.append(query_id)
        rows.append(vec)
    packed = {
        dim: (
            np.array(ids, dtype=np.int64),
            np.floor(SCALE * np.array(rows, dtype=np.float64).reshape(len(ids), dim)),
            np.array([floors.get(i, -np.inf) for i in ids]),
        )
        for dim, (ids, rows) in by_dim.items()
    }
    sent = vectors.sparkSession.sparkContext.broadcast(packed)

    def run(batches):
        blocks = sent.value
        state: dict[int, Best] = {}
        unbounded: list[tuple[int, int, int]] = []
        for ids, points in _shards(batches, SHARD_ROWS):
            dim = points.shape[1]
            if dim not in blocks:
                continue
            query_ids, queries, floor = blocks[dim]
            if not _exact(dim, queries, points):
                for at in range(0, len(ids), 256):
                    scores = _plain_scores(queries, points[at : at + 256])
                    for q, row in zip(query_ids.tolist(), scores, strict=True):
                        pairs = [
                            (-s, i)
                            for s, i in zip(row, ids[at : at + 256].tolist(), strict=True)
                            if i != q
                        ]
                        unbounded += [(q, i, -s) for s, i in sorted(pairs)[:k]]
                continue
            best = state.setdefault(dim, Best(query_ids, k, floor))
            search(Tree(ids, points), queries, best, only_best_leaf=probe)
        for best in state.values():
            at, place = np.nonzero(best.scores > -np.inf)
            unbounded += zip(
                best.query_ids[at].tolist(),
                best.ids[at, place].tolist(),
                best.scores[at, place].astype(np.int64).tolist(),
                strict=True,
            )
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[j] for x in unbounded], pa.int64()) for j in range(3)],
            names=["query_id", "vec_id", "score"],
        )

    return vectors.mapInArrow(run, "query_id bigint, vec_id bigint, score bigint")


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def top_k(
    df: DataFrame,
    is_query: Column,
    k: int = 5,
    id_column: str = "vec_id",
    vector: str = "embedding",
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best candidates of every query row.

    ``is_query`` selects query rows by ``vec_id``.
    """
    spark = df.sparkSession
    vectors = as_table(usable_vectors(df, id_column, vector), "vectors")
    queries = as_table(
        vectors.filter(is_query)
        .groupBy("vec_id")
        .agg(F.min("vec").alias("vec"))
        .repartitionByRange("vec_id"),
        "queries",
    )
    total = queries.count()
    results = []
    last = None
    for _ in range(-(-total // query_block)):
        rest = queries if last is None else queries.filter(F.col("vec_id") > last)
        block = [(r["vec_id"], r["vec"]) for r in rest.orderBy("vec_id").limit(query_block).collect()]
        last = block[-1][0]
        probed = _candidates(vectors, block, k, True, {})
        kth = _top(probed, k).filter(F.col("rank") == k).select("query_id", "score").collect()
        floors = {r["query_id"]: float(r["score"]) for r in kth if abs(r["score"]) < 2**52}
        results.append(as_table(_top(_candidates(vectors, block, k, False, floors), k), "top-k"))
    if not results:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    found = results[0]
    for more in results[1:]:
        found = found.unionByName(more)
    return found
