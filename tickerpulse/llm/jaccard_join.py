"""N-gram Jaccard join: exact links of shingle sets by T-occurrence search (DivideSkip).

1. One pass over the texts gives every document its set of word shingles as 64-bit hashes, the
   set's size, a class id (equal sets, equal class) and a sample: the smallest hashes, so many that
   two linked sets have a known number of them in common.
2. Samples are shuffled by shingle.  A streaming pass keeps shingles that two classes or more hold.
   Of each class's sample only as many of the rarest shingles count as two linked sets need to meet
   in one: the longest inverted lists are never opened, as DivideSkip leaves them for last.
3. Of the classes in one list the smallest is the list's hub.  Every class is compared in full with
   its hubs, which gives the links with hubs and, for the rest, the difference of class and hub.
4. All classes of one hub are a group; linked classes share a group.  The difference between two
   sets is that of their differences from the hub, and a link that is not implied by links with the
   hub needs a number of common differing shingles above zero.  So a T-occurrence search over
   inverted lists of differences finds every other link: the short lists are heap-merged, lists
   that cannot reach the number are skipped ahead by binary search, and the long lists are probed
   by binary search for the candidates only.  What is found is an exact overlap.
5. Large groups are cut into bands of similar sizes, as linked sets are, and these into slices of
   bounded size.  A search visits the slices of its own and the next bands that hold a class with
   which it shares a list; each slice gives a spanning forest of the links, not all of them.
6. Links become components by alternating large-star and small-star.

A shingle that very many documents hold (a passage, a group of copies) is dealt over several tasks
as soon as one batch of rows shows it, and joins on it can be split by AQE.  What still grows with
the square of a group is the number of visits, searches times slices of their group, for classes
that share a rare list with a class in most slices.

Null, empty and blank texts have an empty set and no links.  Rows with a null id take no part: their
component is null.  Rows that repeat an id are judged by their own text.  Sets that differ share a
64-bit class id with probability n^2 / 2^65.  An empty table gives an empty result; other columns do
not matter, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import narrowed
from ..workspace import as_table
from .common import id_and_text, worker_store
from .near_dedup import _mix, _WordHashes, connected_components, shingle_set

#: One in so many shingles more than the least go into a sample: the room to leave long lists out.
SLACK = 20
#: Rows of one shingle in a batch from which its rows are dealt over ``SALTS`` tasks.
HOT_ROWS, SALTS = 64, 31
#: Shingles of differences in a slice of a group, and of searches that visit it together.
SLICE = 1 << 20
#: The factor of DivideSkip's rule for the number of long lists.
MU = 0.0085

_TOKENS = pa.schema([("token", pa.int64()), ("salt", pa.int32()), ("cls", pa.int64())])


def least_common(n, percent: int):
    """Shingles that a set of ``n`` has in common with any linked one, at least."""
    return (percent * n + 99) // 100


def room(n):
    return n // SLACK + 1


def sample_size(n: int, percent: int) -> int:
    return min(n, n - least_common(n, percent) + room(n))


def profiles(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Per row: ``doc_id, n_shingles, cls, sample`` (the last two null for an empty set)."""

    def run(batches):
        import xxhash

        hashes = worker_store("word-hashes", _WordHashes)
        for batch in batches:
            sizes, classes, samples = [], [], []
            for text in batch.column("text"):
                s = shingle_set(text.as_py(), width, hashes)
                sizes.append(len(s))
                classes.append(xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) if len(s) else None)
                samples.append(s[: sample_size(len(s), percent)].tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(classes, pa.int64()),
                    pa.array(samples, pa.binary()),
                ],
                names=["doc_id", "n_shingles", "cls", "sample"],
            )

    return id_and_text(docs).mapInArrow(
        run, "doc_id bigint, n_shingles bigint, cls bigint, sample binary"
    )


def _run_lengths(x: np.ndarray) -> np.ndarray:
    """Lengths of the runs of equal values."""
    starts = np.flatnonzero(np.r_[True, x[1:] != x[:-1]]) if len(x) else np.empty(0, dtype=int)
    return np.diff(np.r_[starts, len(x)])


def _sample_rows(batches):
    """(token, salt, cls) of all samples; rows of a token that fills a batch get salts."""
    for batch in batches:
        raw = batch.column("sample").to_pylist()
        tokens = np.frombuffer(b"".join(raw), dtype=np.int64)
        classes = np.repeat(np.array(batch.column("cls"), dtype=np.int64), [len(r) // 8 for r in raw])
        if not len(tokens):
            continue
        order = np.argsort(tokens, kind="stable")
        tokens, classes = tokens[order], classes[order]
        counts = _run_lengths(tokens)
        hot = np.repeat(counts >= HOT_ROWS, counts)
        # Rows of hot tokens once per class; two of different classes stay with the rows that
        # other batches have of the token, the others are dealt out.
        pairs = np.unique(np.stack([tokens[hot], classes[hot]]), axis=1)
        counts = _run_lengths(pairs[0])
        rank = np.arange(pairs.shape[1]) - np.repeat(np.cumsum(counts) - counts, counts)
        dealt = 1 + (pairs[1].view(np.uint64) >> np.uint64(33)) % np.uint64(SALTS)
        salt = np.r_[np.zeros(int((~hot).sum())), np.where(rank < 2, 0, dealt)]
        tokens = np.r_[tokens[~hot], pairs[0]]
        classes = np.r_[classes[~hot], pairs[1]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(tokens), pa.array(salt.astype(np.int32)), pa.array(classes)], schema=_TOKENS
        )


def _shared_rows(batches):
    """(token, cls) for tokens of several classes; rows come sorted by (token, salt).

    A run may go on in the next batch, so its last row is carried over with a mark whether the run
    has several classes.  Salted rows always pass.  Memory is one batch, however long a run is.
    """
    carried = None
    for batch in batches:
        token, salt, cls = (np.array(batch.column(i)) for i in range(3))
        if carried is not None:
            token, salt, cls = (
                np.r_[np.array([x], dtype=a.dtype), a]
                for x, a in zip(carried[:3], (token, salt, cls), strict=True)
            )
        if not len(token):
            continue
        fresh = (token[1:] != token[:-1]) | (salt[1:] != salt[:-1])
        starts = np.flatnonzero(np.r_[True, fresh])
        counts = np.diff(np.r_[starts, len(token)])
        several = np.minimum.reduceat(cls, starts) != np.maximum.reduceat(cls, starts)
        if carried is not None:
            several[0] |= carried[3]
        keep = np.repeat(several, counts) | (salt > 0)
        done = carried is not None and carried[3]
        carried = (token[-1], salt[-1], cls[-1], bool(several[-1]))
        if done:
            keep[0] = False  # It has been passed on.
        yield pa.RecordBatch.from_arrays(
            [pa.array(token[keep]), pa.array(cls[keep])], names=["token", "cls"]
        )


def inverted_lists(found: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """``token, cls``: the lists in which two linked classes meet at least once."""
    rows = found.filter("cls IS NOT NULL AND doc_id IS NOT NULL").select("cls", "sample")
    dealt = rows.mapInArrow(_sample_rows, "token bigint, salt int, cls bigint")
    sorted_rows = dealt.repartition("token", "salt").sortWithinPartitions("token", "salt")
    shared = as_table(
        sorted_rows.mapInArrow(_shared_rows, "token bigint, cls bigint").distinct(), "shared-shingles"
    )
    lengths = shared.groupBy("token").agg(F.count("*").alias("length")).filter("length > 1")
    n = F.col("n")
    least = F.floor((percent * n + 99) / 100)
    # A sample's shingles that no other class has are the rarest; they come first and meet nothing.
    opened = F.size("held") - (F.floor(least / SLACK) + 1) + 1
    return (
        shared.join(lengths, "token")
        .groupBy("cls")
        .agg(F.sort_array(F.collect_list(F.struct("length", "token"))).alias("held"))
        .join(classes.select("cls", "n"), "cls")
        .withColumn("opened", opened.cast("int"))
        .filter("opened > 0")
        .select("cls", F.explode(F.slice("held", F.lit(1), F.col("opened"))).alias("x"))
        .select(F.col("x.token").alias("token"), "cls")
    )


def hub_sets(docs: DataFrame, classes: DataFrame, pairs: DataFrame, width: int) -> DataFrame:
    """``hub, cls, shingles`` (binary) for every pair (hub, cls) and for (hub, hub)."""

    def run(batches):
        import xxhash

        hashes = worker_store("word-hashes", _WordHashes)
        for batch in batches:
            sets = [shingle_set(t.as_py(), width, hashes).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([xxhash.xxh3_64_intdigest(s) - (1 << 63) for s in sets], pa.int64()),
                    pa.array(sets, pa.binary()),
                ],
                names=["cls", "shingles"],
            )

    hubs = pairs.select("hub", F.col("hub").alias("cls")).distinct()
    wanted = as_table(pairs.select("hub", "cls").unionByName(hubs), "wanted-classes")
    reps = as_table(
        classes.join(wanted.select("cls").distinct(), "cls").select(F.col("rep").alias("doc_id")),
        "wanted-ids",
    )
    # The filter leaves a few other texts, and a repeated id brings some along; their classes go in
    # the join, after which a class may still be there twice.
    sets = narrowed(id_and_text(docs), reps, ["doc_id"]).mapInArrow(
        run, "cls bigint, shingles binary"
    )
    return sets.join(wanted, "cls").dropDuplicates(["hub", "cls"])


def hub_differences(sets: DataFrame, percent: int) -> DataFrame:
    """``hub, cls, n, n_diff, linked, diff`` for every pair (hub, cls) of ``hub_sets``."""
    less, more = 100 - percent, 100 + percent

    def run(batches):
        last, hub = None, None
        for batch in batches:
            n, n_diff, linked, diff = [], [], [], []
            for a, b in zip(batch.column("hub_set"), batch.column("own_set"), strict=True):
                raw = a.as_py()
                if raw != last:
                    last, hub = raw, np.frombuffer(raw, dtype=np.uint64)
                own = np.frombuffer(b.as_py(), dtype=np.uint64)
                both = np.sort(np.concatenate([hub, own]))
                once = np.r_[True, both[1:] != both[:-1]] & np.r_[both[1:] != both[:-1], True]
                d = both[once]
                n.append(len(own))
                n_diff.append(len(d))
                linked.append(less * (len(hub) + len(own)) >= more * len(d))
                diff.append(d.tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("hub"),
                    batch.column("cls"),
                    pa.array(n, pa.int64()),
                    pa.array(n_diff, pa.int64()),
                    pa.array(linked, pa.bool_()),
                    pa.array(diff, pa.binary()),
                ],
                names=["hub", "cls", "n", "n_diff", "linked", "diff"],
            )

    own = sets.filter("cls != hub").select("hub", "cls", F.col("shingles").alias("own_set"))
    hubs = sets.filter("cls = hub").select("hub", F.col("shingles").alias("hub_set"))
    return (
        own.join(hubs, "hub")
        .select("hub", "cls", "hub_set", "own_set")
        .mapInArrow(
            run, "hub bigint, cls bigint, n bigint, n_diff bigint, linked boolean, diff binary"
        )
    )


def merge_skip(owners: list[int], spans: list[tuple[int, int]], least: int) -> Iterator[tuple[int, int]]:
    """(owner, lists) for every owner that is in at least ``least`` of the lists.

    A list is a sorted stretch ``[from, to)`` of ``owners``.  When fewer lists than needed stand at
    the smallest owner, the lists behind skip ahead to the first owner that may still reach it.
    """
    at = [a for a, _ in spans]
    heap = [(owners[a], i) for i, a in enumerate(at)]
    heapify(heap)
    while len(heap) >= least:
        top = heap[0][0]
        popped = []
        while heap and heap[0][0] == top:
            popped.append(heappop(heap)[1])
        if len(popped) >= least:
            yield top, len(popped)
            target = top + 1
        else:
            while len(popped) < least - 1:
                popped.append(heappop(heap)[1])
            target = heap[0][0]
        for i in popped:
            stop = spans[i][1]
            at[i] = bisect_left(owners, target, at[i], stop)
            if at[i] < stop:
                heappush(heap, (owners[at[i]], i))


class DifferenceIndex:
    """Inverted lists of the differences of a slice, for searches in the same groups."""

    def __init__(self, groups, hubs, classes, sizes, diffs, linked, percent: int):
        self.less, self.more = 100 - percent, 100 + percent
        self.classes = classes
        self.row = {key: i for i, key in enumerate(zip(groups, classes, strict=True))}
        self.weight = [self._weight(len(d), n) for d, n in zip(diffs, sizes, strict=True)]
        self.least_weight: dict[int, int] = {}
        for group, w in zip(groups, self.weight, strict=True):
            self.least_weight[group] = min(w, self.least_weight.get(group, w))
        tokens = np.concatenate([_in_group(d, g) for d, g in zip(diffs, groups, strict=True)])
        owner = np.repeat(np.arange(len(diffs)), [len(d) for d in diffs])
        order = np.argsort(tokens, kind="stable")
        self.tokens, starts = np.unique(tokens[order], return_index=True)
        self.starts = np.append(starts, len(tokens))
        self.owners = owner[order].tolist()
        # Links between members of a slice: what a class is linked with, in few steps.
        self.leader: dict[tuple, tuple] = {}
        for hub, cls, with_hub in zip(hubs, classes, linked, strict=True):
            if with_hub:
                self.join((hub,), (cls,))

    def _weight(self, n_diff: int, n: int) -> int:
        return self.more * n_diff - self.less * n

    def find(self, x: tuple) -> tuple:
        while (y := self.leader.get(x, x)) != x:
            self.leader[x] = x = self.leader.get(y, y)
        return x

    def join(self, x: tuple, y: tuple) -> bool:
        """False if both were connected before."""
        a, b = self.find(x), self.find(y)
        self.leader[a] = b
        return a != b

    def linked_rows(self, group: int, cls: int, n: int, diff: np.ndarray) -> Iterator[int]:
        """Rows of the index that are linked with the class and not connected with it before."""
        weight = self._weight(len(diff), n)
        # Twice ``more`` times the overlap must reach the sum of both weights.
        least = max(1, -(-(weight + self.least_weight[group]) // (2 * self.more)))
        own = self.row.get((group, cls), -1)
        tokens = _in_group(diff, group)
        place = np.searchsorted(self.tokens, tokens)
        place[place == len(self.tokens)] = 0
        place = place[self.tokens[place] == tokens]
        lengths = self.starts[place + 1] - self.starts[place]
        useful = lengths > (own >= 0)
        place, lengths = place[useful], lengths[useful]
        if len(place) < least:
            return
        place = place[np.argsort(lengths, kind="stable")]
        spans = list(
            zip(self.starts[place].tolist(), self.starts[place + 1].tolist(), strict=True)
        )
        longest = int(lengths.max())
        n_long = min(least - 1, int(least / (MU * log(longest + 1) + 1)))
        short, long = spans[: len(spans) - n_long], spans[len(spans) - n_long :]
        for row, count in merge_skip(self.owners, short, least - n_long):
            if row == own or self.find((self.classes[row],)) == self.find((cls,)):
                continue
            need = -(-(weight + self.weight[row]) // (2 * self.more))
            left = len(long)
            for a, b in long:
                if count + left < need or count >= need:
                    break
                left -= 1
                at = bisect_left(self.owners, row, a, b)
                count += at < b and self.owners[at] == row
            if count >= need:
                yield row


def _in_group(diff: np.ndarray, group: int) -> np.ndarray:
    """The shingles as those of one group, so that groups share an index but no list."""
    return _mix(diff + np.uint64(group & (2**64 - 1)))


def _search(percent: int):
    """Links of one slice as a spanning forest: (a, b)."""

    def run(rows: pa.Table) -> pa.Table:
        found: list[tuple[int, int]] = []

        def columns(part: pa.Table, *names: str):
            diffs = [np.frombuffer(d.as_py(), dtype=np.uint64) for d in part.column("diff")]
            return [*[part.column(c).to_pylist() for c in names], diffs]

        index = rows.filter(rows.column("stands"))
        searches = rows.filter(rows.column("searches"))
        if index.num_rows and searches.num_rows:
            *keys, diffs = columns(index, "group", "hub", "cls", "n")
            slice_ = DifferenceIndex(*keys, diffs, index.column("linked").to_pylist(), percent)
            for group, cls, n, diff in zip(*columns(searches, "group", "cls", "n"), strict=True):
                if group in slice_.least_weight:
                    for row in slice_.linked_rows(group, cls, n, diff):
                        if slice_.join((cls,), (slice_.classes[row],)):
                            found.append((cls, slice_.classes[row]))
        return pa.table(
            [pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["a", "b"]
        )

    return run


def group_links(members: DataFrame, lists: DataFrame, percent: int) -> DataFrame:
    """(a, b): links within the groups of hubs that links with hubs do not imply.

    ``members`` is the stored table of ``hub_differences``, ``lists`` that of (token, hub, cls).
    """
    facts = members.select("hub", "cls", "n", "n_diff", "linked")
    open_groups = (
        facts.groupBy("hub")
        .agg(
            F.sum("n_diff").alias("size"),
            F.count("*").alias("n_members"),
            F.max((~F.col("linked")).cast("int")).alias("open"),
        )
        .filter("n_members > 1 AND open = 1")
        .select("hub", "size")
    )
    # Sizes of linked sets differ by a factor of 100 / percent at most, so a group that is too
    # large for one slice is cut by size first; a search visits the bands beside its own.
    band = F.when(
        F.col("size") > SLICE, F.floor(F.log("n") / log(100 / percent))
    ).otherwise(0).cast("int")
    placed = as_table(facts.join(open_groups, "hub").withColumn("band", band), "group-members")
    slices = placed.groupBy("hub", "band").agg(
        F.sum("n_diff").alias("in_band"), F.ceil(F.sum("n_diff") / SLICE).cast("int").alias("slices")
    )
    total = placed.agg(F.sum("n_diff")).first()[0]
    if not total:
        return members.selectExpr("hub AS a", "cls AS b").limit(0)
    n_blocks = 2 * (total // SLICE) + 8
    places = as_table(
        placed.join(slices, ["hub", "band"]).withColumn(
            "slice", F.pmod(F.xxhash64("cls"), F.greatest("slices", F.lit(1))).cast("int")
        ),
        "group-places",
    )
    large = F.col("size") > SLICE
    # In a group of several slices a search visits those where another class stands in a list of
    # its own.
    held = lists.join(places.filter(large).drop("n", "in_band"), ["hub", "cls"])
    present = held.select("token", "hub", "band", "slice").distinct()
    routed = (
        held.filter("NOT linked")
        .select("token", "hub", "cls", "n_diff", F.explode(F.expr("sequence(band - 1, band + 1)")).alias("band"))
        .join(present, ["token", "hub", "band"])
        .select("hub", "cls", "n_diff", "band", "slice")
        .unionByName(
            places.filter(~large & ~F.col("linked")).select("hub", "cls", "n_diff", "band", "slice")
        )
        .distinct()
    )
    group = F.xxhash64("hub", "band", "slice")
    block = F.pmod(F.col("group"), F.lit(n_blocks))
    visits = as_table(
        routed.select("hub", "cls", "n_diff", group.alias("group")).withColumn("block", block), "visits"
    )
    parts = as_table(
        visits.groupBy("block").agg(
            F.greatest(F.ceil(F.sum("n_diff") / SLICE), F.lit(1)).cast("int").alias("parts")
        ),
        "parts",
    )
    own_part = F.pmod(F.xxhash64("cls", F.lit(7)), F.col("parts")).cast("int")
    searches = visits.join(parts, "block").select(
        "hub", "cls", "group", "block", own_part.alias("part"),
        F.lit(False).alias("stands"), F.lit(True).alias("searches"),
    )
    stands = places.select("hub", "cls", group.alias("group")).withColumn("block", block).join(
        parts, "block"
    ).select(
        "hub", "cls", "group", "block", F.explode(F.expr("sequence(0, parts - 1)")).alias("part"),
        F.lit(True).alias("stands"), F.lit(False).alias("searches"),
    )
    roles = (
        searches.unionByName(stands)
        .groupBy("hub", "cls", "group", "block", "part")
        .agg(F.bool_or("stands").alias("stands"), F.bool_or("searches").alias("searches"))
    )
    return (
        members.select("hub", "cls", "n", "linked", "diff")
        .join(roles, ["hub", "cls"])
        .groupBy("block", "part")
        .applyInArrow(_search(percent), "a bigint, b bigint")
    )


def jaccard_links(docs: DataFrame, width: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """Stored tables: the documents' ``doc_id, n_shingles, cls`` and links (a, b) between classes
    that connect all classes whose sets are linked."""
    found = as_table(profiles(docs, width, percent), "profiles")
    classes = as_table(
        found.filter("cls IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("cls")
        .agg(F.min("doc_id").alias("rep"), F.min("n_shingles").alias("n")),
        "classes",
    )
    lists = as_table(inverted_lists(found, classes, percent), "lists")
    hubs = (
        lists.groupBy("token")
        .agg(F.min("cls").alias("hub"), F.max("cls").alias("last"))
        .filter("hub != last")
        .select("token", "hub")
    )
    lists = as_table(lists.join(hubs, "token").filter("cls != hub"), "hub-lists")
    pairs = as_table(lists.select("hub", "cls").distinct(), "hub-pairs")
    sets = as_table(hub_sets(docs, classes, pairs, width), "hub-sets")
    members = as_table(hub_differences(sets, percent), "members")
    links = members.filter("linked").select(F.col("hub").alias("a"), F.col("cls").alias("b"))
    return found, as_table(links.unionByName(group_links(members, lists, percent)), "class-links")


def components(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id``."""
    found, links = jaccard_links(docs, width, percent)
    roots = connected_components(links).select(F.col("a").alias("cls"), F.col("b").alias("root"))
    known = (
        found.filter("cls IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("cls")
        .agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("last"))
        .join(roots, "cls", "left")
        .withColumn("own", F.coalesce("root", "cls"))
    )
    known = as_table(known, "known-classes")
    together = known.groupBy("own").agg(F.min("least").alias("component_id"), F.count("*").alias("n"))
    named = as_table(
        known.join(together, "own")
        .filter("n > 1 OR least != last")
        .select("cls", "component_id"),
        "named-classes",
    )
    return found.join(named, "cls", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias(
            "component_id"
        ),
    )
