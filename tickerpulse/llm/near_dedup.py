"""Near-duplicate documents: MinHash with banding, verification, connected components.

1. One pass over the texts gives every document its set of word shingles (64-bit hashes), the
   set's size and fingerprint, and the minima of many universal hashes.
2. Equal sets form a class; its smallest ``doc_id`` stands for it from here on.
3. Bands of minima are bucket keys.  Every class is compared with the smallest class of its
   buckets (first the likeliest of these, then all not yet connected with it).  In buckets whose
   members are then still in several components, those outside the largest of these meet the
   others; exact bounds rule out most of these pairs inside the join (the shingles a text shares
   with any other in such buckets; the bits in which the bitmaps of two sets differ).  So no link
   depends on luck within a bucket, and no bucket emits pairs that are connected already.
4. A candidate must pass the sizes' bound and the signatures' estimate (with a margin of more than
   five standard deviations), then the exact comparison of the full sets.
5. Links become components by alternating large-star and small-star.

With 40 bands of 5 rows a pair of similarity 0.8 shares no bucket with probability 1.3e-7.

Null, empty or blank texts have no shingles and no links.  Rows with a null ``doc_id`` take no
part: null component, kept.  Rows that repeat a ``doc_id`` share its node, so they get the same
component.  An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..workspace import as_table
from .common import id_and_text, worker_store

BANDS = 40
ROWS = 5
SEED = 20_240_601
# Signatures estimate the similarity with a standard deviation of at most 0.036 (200 minima).
SIGNATURE_MARGIN = 0.2
# 64-bit words of a class's bitmap; longer sets fill it, which only weakens its bound.
BITMAP = 32

_UPPER = bytes(range(65, 91))
_LOWER_TABLE = bytes.maketrans(_UPPER, _UPPER.lower())


class _WordHashes(dict):
    """64-bit hashes of words, each computed once while it is kept."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def shingle_set(text: str, width: int, hashes: _WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``width`` words; A-Z count as a-z."""
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER_TABLE).split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    if len(hashes) > 500_000:
        hashes.clear()
    codes = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    size = min(width, len(words))
    total = np.full(len(words) - size + 1, size, dtype=np.uint64)
    for k in range(size):
        total = _mix(total + codes[k : k + len(total)])
    return np.unique(total)


def signatures(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """Minima of ``bands * rows`` multiply-shift hashes, one row for each (not empty) set."""
    rng = np.random.default_rng(SEED)
    n = bands * rows
    a = rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 2**63, n, dtype=np.uint64)
    out = np.empty((len(sets), n), dtype=np.uint32)
    start = 0
    while start < len(sets):
        stop, size = start, 0
        while stop < len(sets) and (stop == start or size + len(sets[stop]) <= 32_768):
            size += len(sets[stop])
            stop += 1
        block = np.concatenate(sets[start:stop]) >> np.uint64(32)
        first = np.cumsum([0, *(len(s) for s in sets[start : stop - 1])])
        work = np.empty_like(block)
        for k in range(n):
            np.multiply(block, a[k], out=work)
            np.add(work, b[k], out=work)
            out[start:stop, k] = np.minimum.reduceat(work, first) >> np.uint64(32)
        start = stop
    return out


def profiles(docs: DataFrame, width: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Per row: ``doc_id, n_shingles, fp, sig`` (the last two null for an empty set)."""

    def run(batches):
        import xxhash

        hashes = worker_store("word-hashes", _WordHashes)
        for batch in batches:
            keys = batch.column("doc_id").to_pylist()
            sets = [shingle_set(t, width, hashes) for t in batch.column("text").to_pylist()]
            full = [s for s in sets if len(s)]
            sigs = iter(signatures(full, bands, rows) if full else [])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(
                        [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                        pa.binary(),
                    ),
                    pa.array([next(sigs).tobytes() if len(s) else None for s in sets], pa.binary()),
                ],
                names=["doc_id", "n_shingles", "fp", "sig"],
            )

    return id_and_text(docs).mapInArrow(
        run, "doc_id bigint, n_shingles bigint, fp binary, sig binary"
    )


def _buckets(classes: DataFrame, bands: int) -> DataFrame:
    """``key, rep, n`` for every band of every class."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            reps = np.array(batch.column("rep"), dtype=np.int64)
            sizes = np.array(batch.column("n"), dtype=np.int64)
            raw = b"".join(batch.column("sig").to_pylist())
            sig = np.frombuffer(raw, dtype=np.uint32).reshape(len(reps), bands, -1)
            key = np.broadcast_to(np.arange(bands, dtype=np.uint64), (len(reps), bands))
            for k in range(sig.shape[2]):
                key = _mix(key + sig[:, :, k].astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key.ravel().view(np.int64)),
                    pa.array(np.repeat(reps, bands)),
                    pa.array(np.repeat(sizes, bands)),
                ],
                names=["key", "rep", "n"],
            )

    return classes.select("rep", "n", "sig").mapInArrow(run, "key bigint, rep bigint, n bigint")


def _similar_signatures(pairs: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """Pairs whose signatures agree in a share of at least ``least``."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            one, two = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint32).reshape(
                    batch.num_rows, -1
                )
                for c in ("sig_a", "sig_b")
            )
            yield batch.select(["a", "b"]).filter(pa.array((one == two).mean(axis=1) >= least))

    return (
        pairs.join(nodes.select(F.col("rep").alias("a"), F.col("sig").alias("sig_a")), "a")
        .join(nodes.select(F.col("rep").alias("b"), F.col("sig").alias("sig_b")), "b")
        .mapInArrow(run, "a bigint, b bigint")
    )


def _verified(pairs: DataFrame, nodes: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs whose full sets reach the similarity."""

    def run(batches):
        hashes = worker_store("word-hashes", _WordHashes)
        recent: dict[str, np.ndarray] = {}

        def set_of(text):
            if text not in recent:
                if len(recent) >= 32:
                    recent.clear()
                recent[text] = shingle_set(text, width, hashes)
            return recent[text]

        for batch in batches:
            keep = []
            x, y = batch.column("text_a"), batch.column("text_b")
            for i in range(batch.num_rows):
                one = set_of(x[i].as_py())
                two = shingle_set(y[i].as_py(), width, hashes)
                both = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(100 * both >= percent * (len(one) + len(two) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return (
        pairs.join(nodes.select(F.col("rep").alias("b"), F.col("text").alias("text_b")), "b")
        .join(nodes.select(F.col("rep").alias("a"), F.col("text").alias("text_a")), "a")
        .select("a", "b", "text_a", "text_b")
        .mapInArrow(run, "a bigint, b bigint")
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return (
        both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(least, "a")
    moved = joined.filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def _state(edges: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), total).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``a, b``: every node with a link and the smallest node of its component (itself left out).

    Each round is written to the shared folder, so a lost executor costs one round at most.
    """
    edges = as_table(edges.filter("a != b").distinct(), "links")
    before = _state(edges)
    while before[0]:
        large = as_table(_large_star(edges).distinct(), "large")
        edges = as_table(_small_star(large).distinct(), "small")
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges


def _with_component(df: DataFrame, node: str, name: str, components: DataFrame) -> DataFrame:
    roots = components.select(F.col("a").alias(node), F.col("b").alias("_root"))
    return df.join(roots, node, "left").withColumn(name, F.coalesce("_root", node)).drop("_root")


def _bounds(mixed: DataFrame, bodies: DataFrame, width: int) -> DataFrame:
    """``rep, own, w0, w1, ...``: what rules out most pairs of these classes exactly.

    ``own`` counts the shingles that no other of the classes has: none of them can be in common.
    The words ``w*`` are a bitmap of the set.  A shingle sets one bit, so at least as many shingles
    are in only one of two sets as bits differ between their bitmaps.
    """
    words = [f"w{i}" for i in range(BITMAP)]

    def sets_of(batch):
        hashes = worker_store("word-hashes", _WordHashes)
        return [shingle_set(t, width, hashes) for t in batch.column("text").to_pylist()]

    def shingles(batches):
        for batch in batches:
            sets = sets_of(batch)
            reps = np.array(batch.column("rep"), dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([*sets, np.empty(0, np.uint64)]).view(np.int64)),
                    pa.array(np.repeat(reps, [len(s) for s in sets])),
                ],
                names=["shingle", "rep"],
            )

    def bitmaps(batches):
        for batch in batches:
            bits = np.zeros((batch.num_rows, 64 * BITMAP), dtype=np.uint8)
            for row, s in zip(bits, sets_of(batch), strict=True):
                row[(_mix(s) >> np.uint64(32)) % np.uint64(64 * BITMAP)] = 1
            packed = np.packbits(bits, axis=1).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), *[pa.array(packed[:, i].copy()) for i in range(BITMAP)]],
                names=["rep", *words],
            )

    # An id that stands before several rows has no single set to count.
    several = bodies.groupBy("rep").count().filter("count > 1").select("rep")
    texts = as_table(
        bodies.join(as_table(mixed.select("rep").distinct(), "mixed-reps"), "rep")
        .join(several, "rep", "left_anti")
        .select("rep", "text"),
        "mixed-texts",
    )
    every = bodies.join(mixed.select("rep").distinct(), "rep").select("rep", "text")
    own = (
        every.mapInArrow(shingles, "shingle bigint, rep bigint")
        .groupBy("shingle")
        .agg(F.count("*").alias("classes"), F.min("rep").alias("rep"))
        .filter("classes = 1")
        .groupBy("rep")
        .agg(F.count("*").alias("own"))
    )
    maps = texts.mapInArrow(bitmaps, ", ".join(f"{c} bigint" for c in ["rep", *words]))
    return maps.join(own, "rep", "left")


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id, kept``."""
    found = as_table(profiles(docs, width, bands, rows), "profiles")
    classes = as_table(
        found.filter("fp IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("fp")
        .agg(
            F.min("doc_id").alias("rep"),
            F.count("*").alias("members"),
            F.first("n_shingles").alias("n"),
            F.first("sig").alias("sig"),
        ),
        "classes",
    )
    buckets = _buckets(classes, bands)
    hubs = as_table(
        buckets.groupBy("key")
        .agg(F.min("rep").alias("hub"), F.max("rep").alias("last"))
        .filter("hub != last")
        .drop("last"),
        "hubs",
    )
    members = as_table(buckets.join(hubs, "key"), "members")
    involved = as_table(members.select("rep").distinct(), "involved")
    texts = id_and_text(docs).select(F.col("doc_id").alias("rep"), "text").join(involved, "rep")
    nodes = as_table(
        classes.join(involved, "rep").select("rep", "sig").distinct(), "signatures"
    )
    bodies = as_table(texts, "texts")
    least = percent / 100 - SIGNATURE_MARGIN

    def check(pairs: DataFrame) -> DataFrame:
        likely = as_table(_similar_signatures(pairs, nodes, least), "likely")
        return _verified(likely, bodies, width, percent)

    star = as_table(
        members.filter("rep != hub")
        .groupBy("rep", "hub")
        .agg(F.count("*").alias("shared"))
        .select(F.col("hub").alias("a"), F.col("rep").alias("b"), "shared"),
        "stars",
    )
    likeliest = star.groupBy("b").agg(F.max(F.struct("shared", -F.col("a"))).alias("best"))
    linked = connected_components(check(likeliest.select((-F.col("best.col2")).alias("a"), "b")))

    def across(pairs: DataFrame) -> DataFrame:
        both = _with_component(_with_component(pairs, "a", "_ca", linked), "b", "_cb", linked)
        return both.filter("_ca != _cb").select("a", "b")

    linked = connected_components(linked.unionByName(check(across(star.select("a", "b")))))

    placed = as_table(_with_component(members, "rep", "root", linked), "placed")
    # A bucket's main component is the one with most members: of two members in different
    # components at least one is not in the main one.  So only these others meet all members.
    open_keys = as_table(
        placed.groupBy("key", "root")
        .agg(F.count("*").alias("members"))
        .groupBy("key")
        .agg(F.count("*").alias("roots"), F.max(F.struct("members", "root")).alias("most"))
        .filter("roots > 1")
        .select("key", F.col("most.root").alias("main")),
        "open",
    )
    # Pairs with the hub have been compared.
    mixed = as_table(placed.filter("rep != hub").join(open_keys, "key"), "mixed")
    bounds = as_table(_bounds(mixed, bodies, width), "bounds")
    mixed = (
        mixed.join(bounds, "rep", "left")
        .withColumn("shared", F.col("n") - F.coalesce("own", F.lit(0)))
        .filter(f"100 * shared >= {percent} * n")
    )
    words = [f"w{i}" for i in range(BITMAP)]
    one, two = (
        mixed.select(
            "key",
            F.col("rep").alias(rep),
            *[F.col(c).alias(f"{c}_{rep}") for c in ["n", "shared", "root", "main", *words]],
        )
        for rep in ("a", "b")
    )
    differ = " + ".join(f"bit_count({w}_a ^ {w}_b)" for w in words)
    rest = (
        one.filter("root_a != main_a")
        .join(two, "key")
        .filter("root_a != root_b AND (root_b = main_b OR a < b)")
        .filter(f"least(shared_a, shared_b) * {100 + percent} >= {percent} * (n_a + n_b)")
        .filter(f"coalesce({differ}, 0) * {100 + percent} <= {100 - percent} * (n_a + n_b)")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    done = star.select("a", "b")
    linked = connected_components(linked.unionByName(check(rest.join(done, ["a", "b"], "left_anti"))))

    grouped = as_table(
        _with_component(classes.select("fp", "rep", "members"), "rep", "component_id", linked)
        .filter("members > 1 OR component_id != rep")
        .select("fp", "component_id"),
        "grouped",
    )
    return (
        found.select("doc_id", "n_shingles", "fp")
        .join(grouped, "fp", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias(
                "component_id"
            ),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Rows of ``docs`` without those near-duplicate of a document with a smaller ``doc_id``."""
    gone = near_duplicates(docs, width, percent).filter("NOT kept").select("doc_id").distinct()
    return docs.join(as_table(gone, "gone"), "doc_id", "left_anti")
