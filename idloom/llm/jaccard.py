"""All pairs of texts whose sets of word shingles have at least a given Jaccard similarity: an exact set-similarity join.

Sets are put in one order of shingles and cut to a prefix: two sets of similarity t or more share a shingle among the
first n - ceil(t * n) + 1 of each, whatever the order is. Shingles that many texts of a sample share come last, so that
prefixes hold rare ones; the sample bears on the work only, never on the result. Pairs that share a shingle of their
prefixes are dropped if sizes, places in the order or the number of prefix shingles that they share rule them out;
the others are compared by their whole sets.

Groups of more than ``WIDE`` texts about one shingle are compared in three rounds: neighbours and the first text; then
some of those that the components found so far leave apart; then all that are still apart. So n copies near each other
don't give n * n pairs. The first round streams through such a group; for the others, groups that lie in one component
are left out and large ones are dealt into cells. Exact copies count once in each task, before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idloom.llm.batches import give_back
from idloom.llm.cells import deal
from idloom.plans.components import connected_components
from idloom.plans.storage import materialize

#: Texts about one shingle that are all compared at once.
WIDE = 32
#: In larger groups: how many texts before each one it is compared with, and how many of other components in the round after.
NEIGHBOURS = 4
PARTNERS = 8
#: Rows of one shingle that a task holds at once, and those that a cell of the later rounds takes.
HELD = 500_000
CELL = 20_000
#: One text in so many is looked at for common shingles; those in ``COMMON`` of them or more, but at most ``KNOWN``, come last.
SAMPLE = 16
COMMON = 3
KNOWN = 100_000
SLACK = 1e-9
#: Keys of the texts to be compared up to which they are broadcast.
BROADCAST_ROWS = 1_000_000
PAIRS = ["a", "b", "n", "least", "near"]
#: Columns of a set's sketch: 256 bits, each the parity of how many of its shingles fall on it.
SKETCH = ["s0", "s1", "s2", "s3"]

Sets = Callable[[DataFrame], DataFrame]


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def common_shingles(docs: DataFrame, sets_of: Sets) -> np.ndarray:
    """Hashes of shingles that are common in a sample of ``docs`` (key, text), the most common last; ``KNOWN`` at most."""

    sample = sets_of(docs.where(F.pmod("key", F.lit(SAMPLE)) == 0).dropDuplicates(["key"])).select(F.explode("hashes").alias("hash"))
    counted = sample.groupBy("hash").count().where(F.col("count") >= COMMON)
    found = counted.orderBy(F.desc("count"), "hash").limit(KNOWN).select("hash").toArrow()
    return found.column("hash").to_numpy()[::-1].copy()


def sketch(own: np.ndarray) -> np.ndarray:
    """The sketch of one set of distinct shingle hashes: two sets' sketches differ in no more bits than the sets in shingles."""
    odd = np.bincount(own & (64 * len(SKETCH) - 1), minlength=64 * len(SKETCH)) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


class Prefix:
    """Cuts sets of shingle hashes to the part that must hold one of any similar set's; ``common`` hashes come last."""

    def __init__(self, common: np.ndarray, threshold: float) -> None:
        self.rank = np.argsort(common)
        self.known = common[self.rank]
        self.threshold = threshold

    def __call__(self, own: np.ndarray) -> np.ndarray:
        """The prefix of one set, whose hashes are distinct and ascend."""
        if len(self.known):
            at = np.minimum(np.searchsorted(self.known, own), len(self.known) - 1)
            seen = self.known[at] == own
            if seen.any():
                late = np.flatnonzero(seen)
                own = np.concatenate([own[~seen], own[late[np.argsort(self.rank[at[late]], kind="stable")]]])
        return own[: len(own) - int(np.ceil(self.threshold * len(own) - SLACK)) + 1]


def _entries(signed: DataFrame) -> DataFrame:
    """(hash, at, set) of the shingles in each prefix; at holds the set's size (upper half) and their place in it."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for begin in range(0, batch.num_rows, 1000):
                part = batch.slice(begin, 1000)
                held, sizes, sets = [], [], []
                for number, size, value in zip(part.column("set").to_pylist(), part.column("size").to_pylist(), part.column("prefix"), strict=True):
                    if size and number not in seen:
                        seen.add(number)
                        held.append(np.frombuffer(value.as_py(), np.int64))
                        sizes.append(size)
                        sets.append(number)
                if len(seen) > 1_000_000:
                    seen.clear()
                if held:
                    counts = np.array([len(x) for x in held])
                    columns = [np.concatenate(held), np.repeat(sizes, counts) << 32 | np.concatenate([np.arange(n) for n in counts]), np.repeat(sets, counts)]
                    yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=["hash", "at", "set"])

    return signed.select("set", "size", "prefix").mapInArrow(spread, "hash long, at long, set long")


def _least(size: np.ndarray, other: np.ndarray, threshold: float) -> np.ndarray:
    """Prefix shingles that similar sets of these sizes must share.

    What they share is at most that and the rest of the set whose prefix ends first in the order of shingles.
    """
    rest = np.ceil(threshold * np.maximum(size, other) - SLACK) - 1
    return np.ceil(threshold / (1 + threshold) * (size + other) - SLACK) - rest


def _sized(table: np.ndarray, i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of rows (hash, at, set) with one shingle are of unlike sets whose sizes don't rule them out; size[i] <= size[j]."""
    return (table[2, i] != table[2, j]) & ((table[1, i] >> 32) >= threshold * (table[1, j] >> 32) - SLACK)


def _placed(table: np.ndarray, i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs may be similar if this shingle is the first that they share, going by its places."""
    size_i, size_j = table[1, i] >> 32, table[1, j] >> 32
    most = np.minimum(size_i - (table[1, i] & 0xFFFFFFFF), size_j - (table[1, j] & 0xFFFFFFFF))
    return most * (1 + threshold) >= threshold * (size_i + size_j) - SLACK


def _unlike(table: np.ndarray, i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of rows (hash, at, set, label, own, sketch) differ in more shingles than similar sets of their sizes may."""
    sketches = table[5:].view(np.uint64)  # of signed numbers, numpy counts the bits of the absolute value
    differ = np.bitwise_count(sketches[:, i] ^ sketches[:, j]).sum(axis=0, dtype=np.int64)
    return differ > (1 - threshold) / (1 + threshold) * ((table[1, i] >> 32) + (table[1, j] >> 32)) + 1e-6


def _batch(a: np.ndarray, b: np.ndarray, least: np.ndarray, near: np.ndarray) -> pa.RecordBatch:
    """Pairs with how often each comes, the least number of times that it must, and whether places ever allow it."""
    low, high = np.minimum(a, b), np.maximum(a, b)
    order = np.lexsort((high, low))
    low, high, least, near = low[order], high[order], least[order], near[order]
    starts = np.flatnonzero(np.r_[True, (low[1:] != low[:-1]) | (high[1:] != high[:-1])])
    counts = np.diff(np.r_[starts, len(low)])
    columns = [low[starts], high[starts], counts.astype(np.int64), least[starts].astype(np.int64), np.logical_or.reduceat(near, starts)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=PAIRS)


def _wide(table: np.ndarray) -> pa.RecordBatch:
    """Rows of a wide group, kept for the later rounds."""
    n = table.shape[1]
    columns = [pa.array(table[2]), pa.nulls(n, pa.int64()), pa.array(table[0]), pa.array(table[1]), pa.nulls(n, pa.bool_())]
    return pa.RecordBatch.from_arrays(columns, names=PAIRS)


def _first_round(entries: DataFrame, threshold: float) -> DataFrame:
    """(a, b, n, least, near): pairs that share n prefix shingles in some task; those of wide groups have ``least`` 0.

    ``near`` is whether some shingle's places allow the pair: those of the first one that it shares must. Rows of wide groups come too: set, null, hash and at.
    """

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(table: np.ndarray, going: bool) -> Iterator[pa.RecordBatch]:
            """Pairs of whole groups; with ``going`` the only group is a wide one's part, its first row at the front."""
            fresh = np.r_[True, (table[0, 1:] != table[0, :-1]) | (table[2, 1:] != table[2, :-1])]
            table = table[:, fresh]  # exact copies
            starts = np.flatnonzero(np.r_[True, table[0, 1:] != table[0, :-1]])
            sizes = np.diff(np.r_[starts, table.shape[1]])
            wide = np.repeat((sizes > WIDE) | going, sizes)
            first = np.repeat(starts, sizes)
            narrow = np.flatnonzero(~wide)
            for step in range(1, min(WIDE, int(sizes.max()))):
                i, j = narrow[:-step], narrow[step:]
                same = first[i] == first[j]
                if not same.any():
                    break
                i, j = i[same], j[same]
                go = _sized(table, i, j, threshold)
                if go.any():
                    i, j = i[go], j[go]
                    yield _batch(table[2, i], table[2, j], _least(table[1, i] >> 32, table[1, j] >> 32, threshold), _placed(table, i, j, threshold))
            at = np.flatnonzero(wide)
            if len(at):
                yield _wide(table[:, at])
                later = at[first[at] != at]
                pairs = [np.stack([first[later], later])]
                for step in range(1, NEIGHBOURS + 1):
                    near = at[at - step > first[at]]
                    pairs.append(np.stack([near - step, near]))
                i, j = np.concatenate(pairs, axis=1)
                go = _sized(table, i, j, threshold) & _placed(table, i, j, threshold)
                if go.any():
                    yield _batch(table[2, i[go]], table[2, j[go]], np.zeros(int(go.sum()), np.int64), np.ones(int(go.sum()), bool))

        held: list[np.ndarray] = []
        going = False
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(np.stack([_column(batch, c) for c in ("hash", "at", "set")]))
            if held[-1][0, -1] != held[0][0, 0]:
                table = np.concatenate(held, axis=1)
                if going:  # the rest of a wide group
                    cut = int(np.searchsorted(table[0], table[0, 0], side="right"))
                    yield from done(table[:, :cut], True)
                    table, going = table[:, cut:], False
                cut = int(np.searchsorted(table[0], table[0, -1]))
                if cut:
                    yield from done(table[:, :cut], False)
                held = [table[:, cut:]]
            elif sum(x.shape[1] for x in held) > HELD:
                table = np.concatenate(held, axis=1)
                yield from done(table, True)
                held, going = [table[:, [0, -1]]], True
        if held:
            table = np.concatenate(held, axis=1)
            if going:
                cut = int(np.searchsorted(table[0], table[0, 0], side="right"))
                yield from done(table[:, :cut], True)
                table = table[:, cut:]
            if table.shape[1]:
                yield from done(table, False)
        held = table = None
        give_back()

    # By size and set, so that neighbours in the groups of many shingles are the same pairs.
    ordered = entries.repartition("hash").sortWithinPartitions("hash", F.shiftright("at", 32), "set")
    return ordered.mapInArrow(paired, "a long, b long, n long, least long, near boolean")


def _across(wide: DataFrame, threshold: float, partners: int | None) -> DataFrame:
    """(a, b) of rows (hash, at, set, label, sketch) that share a shingle, lie in two components and may be similar.

    Sizes, places and sketches rule out, before a pair is made, all that can't be. With ``partners`` only rows outside of a group's largest component are looked at, with so many others each.
    """
    apart = wide.groupBy("hash").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("hash")
    dealt = deal(wide.join(apart, "hash", "left_semi"), ["hash"], ["set"], CELL)
    own_part = F.when(F.col("cell_i") == F.col("cell_j"), -1).otherwise(F.col("own")).cast("long").alias("own")
    cells = dealt.select(F.xxhash64("hash", "cell_i", "cell_j").alias("cell"), "at", "set", "label", own_part, *SKETCH)

    def sampled(own: np.ndarray) -> Iterator[pa.RecordBatch]:
        labels, counts = np.unique(own[3], return_counts=True)
        out = []
        for i in np.flatnonzero(own[3] != labels[counts.argmax()]):
            j = np.flatnonzero((own[3] != own[3, i]) & ((own[4, i] < 0) | (own[4] != own[4, i])))
            low, high = np.minimum(i, j), np.maximum(i, j)
            go = np.flatnonzero(_sized(own, low, high, threshold) & _placed(own, low, high, threshold))
            go = go[~_unlike(own, low[go], high[go], threshold)]
            if len(go):  # spread over the group, from a place that differs by shingle
                at = go[(int(own[0, i]) % len(go) + np.arange(min(partners, len(go))) * max(1, len(go) // partners)) % len(go)]
                out.append((own[2, low[at]], own[2, high[at]]))
        if out:
            yield _pairs(out)

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(table: np.ndarray) -> Iterator[pa.RecordBatch]:
            starts = np.flatnonzero(np.r_[True, table[0, 1:] != table[0, :-1]])
            for lo, hi in zip(starts, np.r_[starts[1:], table.shape[1]], strict=True):
                own = table[:, lo:hi]
                if partners:
                    yield from sampled(own)
                    continue
                size = own[1] >> 32
                # The largest partner that places allow each row; sizes ascend, so later rows are too large from there on.
                limit = np.minimum(size / threshold, (1 + threshold) / threshold * (size - (own[1] & 0xFFFFFFFF)) - size) + 1e-6
                ends = np.searchsorted(size, limit, side="right")
                out, waiting = [], 0
                for i in np.flatnonzero(ends > np.arange(len(size)) + 1):
                    j = np.arange(i + 1, ends[i])
                    j = j[(own[3, j] != own[3, i]) & ((own[4, i] < 0) | (own[4, j] != own[4, i]))]
                    k = np.full(len(j), i)
                    j = j[_sized(own, k, j, threshold) & _placed(own, k, j, threshold)]
                    j = j[~_unlike(own, np.full(len(j), i), j, threshold)]
                    if len(j):
                        out.append((own[2, np.full(len(j), i)], own[2, j]))
                        waiting += len(out[-1][0])
                    if waiting > 100_000:
                        yield _pairs(out)
                        out, waiting = [], 0
                if out:
                    yield _pairs(out)

        held: list[np.ndarray] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(np.stack([_column(batch, c) for c in ("cell", "at", "set", "label", "own", *SKETCH)]))
            if held[-1][0, -1] != held[0][0, 0]:
                table = np.concatenate(held, axis=1)
                cut = int(np.searchsorted(table[0], table[0, -1]))
                yield from done(table[:, :cut])
                held = [table[:, cut:]]
        if held:
            yield from done(np.concatenate(held, axis=1))
        held = table = None
        give_back()

    return cells.repartition("cell").sortWithinPartitions("cell", "at", "set").mapInArrow(paired, "a long, b long").distinct()


def _pairs(out: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    a, b = (np.concatenate([x[k] for x in out]) for k in (0, 1))
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
    return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])


def _verified(pairs: DataFrame, docs: DataFrame, known: DataFrame, sets_of: Sets, threshold: float) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""
    named = pairs.select(F.explode(F.array("a", "b")).alias("set")).distinct()
    keys, _ = materialize(known.join(named, "set").select("key"), "compared")
    small = keys.count() <= BROADCAST_ROWS
    texts = docs.join(F.broadcast(keys) if small else keys, "key", "left_semi")
    once, _ = materialize(sets_of(texts).select("set", "hashes"), "compared-sets")
    wanted = once.groupBy("set").agg(F.first("hashes").alias("hashes"))
    left = wanted.select(F.col("set").alias("a"), F.col("hashes").alias("left"))
    right = wanted.select(F.col("set").alias("b"), F.col("hashes").alias("right"))

    joined = pairs.join(left, "a").join(right, "b")
    both = F.size(F.array_intersect("left", "right"))
    return joined.where(both >= threshold * (F.size("left") + F.size("right") - both) - SLACK).select("a", "b")


def similar(docs: DataFrame, signed: DataFrame, sets_of: Sets, threshold: float) -> DataFrame:
    """(a, b): links that join the same sets as all pairs of similarity ``threshold`` or more do.

    ``signed`` is a written table with, for each text, its hash ``key``, a ``set`` that is equal for equal sets, the
    set's ``size``, its ``prefix`` (see :class:`Prefix`) and its sketch in the columns ``SKETCH``. ``sets_of`` gives for rows of ``docs`` (key, text) the set
    and ``hashes``, the distinct shingles' 64-bit hashes, ascending. These would fill the disk and are made
    anew where they are compared. Sets without shingles have no links.
    """
    known, _ = materialize(signed.where("size > 0").groupBy("set").agg(F.min("key").alias("key"), *[F.min(c).alias(c) for c in SKETCH]), "sets")
    found, _ = materialize(_first_round(_entries(signed), threshold), "candidates")
    counted = found.where("b is not null").groupBy("a", "b").agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("near").alias("near"))
    pairs, _ = materialize(counted.where("n >= least and near").select("a", "b"), "pairs")
    links, _ = materialize(_verified(pairs, docs, known, sets_of, threshold), "similar")
    wide = found.where("b is null").select(F.col("n").alias("hash"), F.col("least").alias("at"), F.col("a").alias("set"))
    if wide.isEmpty():
        return links
    sketched = wide.join(known.drop("key"), "set")
    for partners in (PARTNERS, None):
        component = connected_components(links, "a", "b").select(F.col("node").alias("set"), F.col("component").alias("label"))
        labelled, _ = materialize(sketched.join(component, "set", "left").withColumn("label", F.coalesce("label", "set")), "labelled")
        more, _ = materialize(_across(labelled, threshold, partners), "pairs")
        if not more.isEmpty():
            found, _ = materialize(_verified(more, docs, known, sets_of, threshold), "similar")
            links = links.unionByName(found)
    return links
