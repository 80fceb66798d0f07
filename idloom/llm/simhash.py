"""SimHash near-duplicates by a self-join of binary tries.

Fingerprints: texts are lower-cased (A-Z), split into words at ASCII white space and cut into shingles; each shingle's
XXH64 (seed 42) votes on 64 bits. Equal fingerprints are joined first by an aggregation. Two fingerprints that differ
in at most three of 64 bits agree in one of four 16-bit blocks, so every distinct fingerprint goes to four groups, one
for each block value, and each group is a binary trie over its fingerprints. The self-join walks pairs of trie nodes
together, level by level, adds up the bits in which their paths differ and drops a pair as soon as the budget is
exceeded. It also drops pairs whose leaves are all in one component already, so a cluster of n near copies gives a
spanning forest and not its n * n links. Groups above ``HOT_GROUP`` are dealt into cells of salted halves, each pair of
halves in one cell, so no group is ever too large for one task and no pair is lost.

For the corpus pipeline :func:`keep_first` adds links of texts whose shingle sets are similar, found exactly, since at a
similarity of 0.8 fingerprints differ in about ten bits.

Nulls and texts without words have fingerprint zero and link like any other. Repeated rows and ties have equal
fingerprints. A text of fewer words than a shingle is one shingle. An empty table gives an empty result. Other columns
pass through untouched; a column that clashes with an added one is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idloom.llm.batches import runs
from idloom.llm.cells import deal
from idloom.llm.jaccard import BROADCAST_ROWS, SKETCH, Prefix, common_shingles, similar, sketch
from idloom.plans.components import connected_components
from idloom.plans.storage import materialize

BITS = 64
BLOCKS = 4
SEED = 42
#: Distinct fingerprints in one group that a single cell takes.
HOT_GROUP = 20_000
#: Node pairs that are expanded at once.
FRONTIER = 100_000


def shingle_hashes(text: str, shingle: int) -> bytes:
    """The hashes of a text's shingles, 8 bytes each, in the text's order."""
    from xxhash import xxh64_digest

    words = text.encode().lower().split()
    if not words:
        return b""
    line = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda a, b: a + b + 1))
    width = min(shingle, len(words))
    return b"".join([xxh64_digest(line[i:j], SEED) for i, j in zip([0, *(e + 1 for e in ends)], ends[width - 1 :], strict=False)])


def fingerprint(text: str, shingle: int) -> int:
    """The unsigned SimHash of one text."""
    return _voted(shingle_hashes(text, shingle))


def _voted(hashes: bytes) -> int:
    if not hashes:
        return 0
    votes = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
    ones = sum(votes[i : i + 255].sum(axis=0, dtype=np.uint8).astype(np.int64) for i in range(0, len(votes), 255))
    return int.from_bytes(np.packbits(2 * ones > len(votes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id and fingerprint (long: the 64 bits, signed) of every row of ``docs``."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in runs(batches):
            found = np.array([fingerprint(x, shingle) for x in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], names=["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(hashed, "doc_id long, fingerprint long")


def shingle_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """key, ``hashes`` (the distinct shingles' hashes, ascending) and ``set``, their hash, of rows (key, text); once a task for each key."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch, texts in runs(batches):
            keys, sets = [], []
            for key, text in zip(batch.column("key").to_pylist(), texts, strict=True):
                if key not in seen:
                    seen.add(key)
                    keys.append(key)
                    sets.append(_distinct(shingle_hashes(text, shingle)))
            if len(seen) > 1_000_000:
                seen.clear()
            if keys:
                ends = np.cumsum([0, *map(len, sets)], dtype=np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets)))
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(_set_keys([x.tobytes() for x in sets])), lists], names=["key", "set", "hashes"])

    return docs.select("key", "text").mapInArrow(hashed, "key long, set long, hashes array<long>")


def _distinct(hashes: bytes) -> np.ndarray:
    return np.unique(np.frombuffer(hashes, np.int64))


def _set_keys(sets: list[bytes]) -> np.ndarray:
    from xxhash import xxh3_64_intdigest

    return np.array([xxh3_64_intdigest(x) for x in sets], dtype=np.uint64).view(np.int64)


def signatures(docs: DataFrame, shingle: int, prefix: Prefix) -> DataFrame:
    """doc_id, key, fingerprint, and the shingles' ``set``, ``size``, ``prefix`` and sketch of rows (doc_id, key, text)."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in runs(batches):
            voted, sets, sizes, cut, sketches = [], [], [], [], []
            for text in texts:
                hashes = shingle_hashes(text, shingle)
                own = _distinct(hashes)
                voted.append(_voted(hashes))
                sets.append(own.tobytes())
                sizes.append(len(own))
                cut.append(prefix(own).tobytes() if len(own) else b"")
                sketches.append(sketch(own))
            found = [pa.array(np.array(voted, dtype=np.uint64).view(np.int64)), pa.array(_set_keys(sets)), pa.array(sizes, pa.int64()), pa.array(cut, pa.binary())]
            found += [pa.array(x) for x in np.stack(sketches, axis=1)] if sketches else [pa.array([], pa.int64())] * len(SKETCH)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), *found], names=["doc_id", "key", "fingerprint", "set", "size", "prefix", *SKETCH])

    columns = ", ".join(f"{c} long" for c in SKETCH)
    return docs.select("doc_id", "key", "text").mapInArrow(hashed, f"doc_id long, key long, fingerprint long, set long, size long, prefix binary, {columns}")


def similar_links(docs: DataFrame, signed: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """(left, right) links among fingerprints whose texts' shingle sets are equal or have that Jaccard similarity."""
    known, _ = materialize(signed.select("set", F.col("fingerprint").alias("fp")).distinct(), "set-fingerprints")
    least = known.groupBy("set").agg(F.min("fp").alias("least"))
    equal = known.join(least, "set").where("fp <> least").select(F.col("least").alias("left"), F.col("fp").alias("right"))
    found = similar(docs, signed, lambda rows: shingle_sets(rows, shingle), similarity)
    named = found.join(least.select(F.col("set").alias("a"), F.col("least").alias("left")), "a").join(least.select(F.col("set").alias("b"), F.col("least").alias("right")), "b")
    return named.where("left <> right").select("left", "right").unionByName(equal)


def _merge(label: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Give linked places the least label of their component; labels are places and point at roots."""
    while True:
        a, b = label[left], label[right]
        apart = a != b
        if not apart.any():
            return
        np.minimum.at(label, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def trie_self_join(group: np.ndarray, key: np.ndarray, budget: int) -> np.ndarray:
    """Least place of each place's component, links being pairs in one group at Hamming distance ``budget`` or less.

    Rows are in order of (group, key); key is unsigned. A trie node is a range of places with a common prefix.
    """
    n = len(key)
    label = np.arange(n)
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if n else np.zeros(0, int)
    sizes = np.diff(np.r_[starts, n])
    alone = sizes < 2
    roots = starts[~alone], (starts + sizes)[~alone]
    zeros: dict[int, np.ndarray] = {}

    def before(bit: int) -> np.ndarray:
        """How many of the places before each have 0 in this bit, counted from the top."""
        if bit not in zeros:
            zeros[bit] = np.r_[0, np.cumsum((key >> np.uint64(BITS - 1 - bit)) & np.uint64(1) == 0)]
        return zeros[bit]

    # A frontier: depth, and for each node pair the two ranges and the bits that differ so far.
    todo = [(0, roots[0][i : i + FRONTIER], roots[1][i : i + FRONTIER], roots[0][i : i + FRONTIER], roots[1][i : i + FRONTIER], np.zeros(len(roots[0][i : i + FRONTIER]), np.int8)) for i in range(0, len(roots[0]), FRONTIER)]
    while todo:
        depth, a, b, c, d, error = todo.pop()
        if len(a) > FRONTIER:
            half = len(a) // 2
            todo += [(depth, *(x[half:] for x in (a, b, c, d, error))), (depth, *(x[:half] for x in (a, b, c, d, error)))]
            continue
        # Both nodes wholly inside one component: nothing to gain.
        change = np.r_[0, np.cumsum(label[1:] != label[:-1])]
        live = (change[b - 1] != change[a]) | (change[d - 1] != change[c]) | (label[a] != label[c])
        a, b, c, d, error = (x[live] for x in (a, b, c, d, error))
        leaf = (b - a == 1) & (d - c == 1)
        if leaf.any():
            i, j = a[leaf], c[leaf]
            near = np.bitwise_count(key[i] ^ key[j]) <= budget
            _merge(label, i[near], j[near])
            a, b, c, d, error = (x[~leaf] for x in (a, b, c, d, error))
        if not len(a):
            continue
        if depth == BITS:  # equal keys
            _merge(label, np.repeat(a, b - a), np.concatenate([np.arange(x, y) for x, y in zip(a, b, strict=True)]))
            _merge(label, np.repeat(c, d - c), np.concatenate([np.arange(x, y) for x, y in zip(c, d, strict=True)]))
            _merge(label, a, c)
            continue
        count = before(depth)
        left, right = a + count[b] - count[a], c + count[d] - count[c]
        same = (a == c) & (b == d)
        children = []
        for lo1, hi1, lo2, hi2, differs, once in ((a, left, c, right, 0, False), (left, b, right, d, 0, False), (a, left, right, d, 1, False), (left, b, c, right, 1, True)):
            go = (hi1 > lo1) & (hi2 > lo2) & (error + differs <= budget) & ~((lo1 == lo2) & (hi1 - lo1 == 1) & (hi1 == hi2))
            if once:  # of a node with itself the mixed pair comes once
                go &= ~same
            children.append((lo1[go], hi1[go], lo2[go], hi2[go], (error[go] + differs).astype(np.int8)))
        todo.append((depth + 1, *(np.concatenate(x) for x in zip(*children, strict=True))))
    return label


def _cells(distinct: DataFrame) -> DataFrame:
    """(cell, key, fp): every distinct fingerprint once for each block, or for each cell of a large group."""
    width = BITS // BLOCKS
    rotated = [
        F.struct(F.lit(k).alias("block"), F.shiftright(F.shiftleft("fp", k * width), BITS - width).cast("int").alias("value"))
        for k in range(BLOCKS)
    ]
    spread = distinct.select("fp", F.explode(F.array(*rotated)).alias("g")).select("fp", "g.block", "g.value")
    dealt = deal(spread, ["block", "value"], ["fp"], HOT_GROUP)
    return dealt.select(F.struct("block", "value", "cell_i", "cell_j").alias("cell"), "fp")


def links(distinct: DataFrame, budget: int = 3) -> DataFrame:
    """(left, right) spanning links among the distinct fingerprints in column ``fp``."""
    if budget >= BLOCKS:
        raise ValueError("the budget must be below the number of blocks")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def done(group: np.ndarray, key: np.ndarray) -> pa.RecordBatch:
            label = trie_self_join(group, key.view(np.uint64), budget)
            linked = np.flatnonzero(label != np.arange(len(label)))
            return pa.RecordBatch.from_arrays([pa.array(key[linked]), pa.array(key[label[linked]])], names=["left", "right"])

        for batch in batches:
            held.append((batch.column("cell").to_numpy(zero_copy_only=False), batch.column("fp").to_numpy(zero_copy_only=False)))
            if sum(len(k) for _, k in held) >= 4 * HOT_GROUP:
                group, key = (np.concatenate(x) for x in zip(*held, strict=True))
                cut = int(np.searchsorted(group, group[-1]))  # the last group may go on
                if cut:
                    yield done(group[:cut], _ordered(group[:cut], key[:cut]))
                held = [(group[cut:], key[cut:])]
        if held:
            group, key = (np.concatenate(x) for x in zip(*held, strict=True))
            yield done(group, _ordered(group, key))

    cells = _cells(distinct).select(F.xxhash64("cell").alias("cell"), "fp")
    return cells.repartition("cell").sortWithinPartitions("cell").mapInArrow(joined, "left long, right long")


def _ordered(group: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Keys in unsigned order inside each group; rows are in order of group already."""
    return key[np.lexsort((key.view(np.uint64), group))]


def near_duplicates(docs: DataFrame, shingle: int = 3, budget: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (least doc_id reachable) of every row of ``docs``."""
    hashed, _ = materialize(fingerprints(docs, shingle), "fingerprints")
    first = hashed.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("doc_id").alias("first"))
    edges, _ = materialize(links(first.select("fp"), budget), "links")
    known = _components(first, edges).withColumnRenamed("fp", "fingerprint").withColumnRenamed("least", "component_id")
    return hashed.join(known, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _components(first: DataFrame, edges: DataFrame) -> DataFrame:
    """(fp, least) for every fingerprint of ``first`` (fp, first): the least ``first`` of its component.

    It is a written table: then adaptive execution can split the rows of a fingerprint that very many documents share.
    """
    least = component_minimum(connected_components(edges, "left", "right"), first)
    return materialize(first.join(least, "fp", "left").select("fp", F.coalesce("least", "first").alias("least")), "fingerprint-components")[0]


def component_minimum(components: DataFrame, first: DataFrame) -> DataFrame:
    """(fp, least): the least ``first`` of each fingerprint's component, for fingerprints that have links."""
    member = components.select(F.col("node").alias("fp"), "component").join(first, "fp")
    least = member.groupBy("component").agg(F.min("first").alias("least"))
    return member.select("fp", "component").join(least, "component").select("fp", "least")


def keep_first(docs: DataFrame, shingle: int = 5, budget: int = 3, similarity: float = 0.8) -> DataFrame:
    """``docs`` with one row for each group of near-duplicates: the one of the least doc_id, then of the least text hash.

    Documents link if their shingle sets have a Jaccard similarity of ``similarity`` or more (see
    :mod:`idloom.llm.jaccard`) or their fingerprints differ in ``budget`` bits or fewer. A row is told by doc_id and
    text, so unlike texts under one doc_id both stay. Rows without a doc_id come after all others; of rows with one
    doc_id and text the least by the other columns stays. Null and empty texts are one group. What goes is told by
    (doc_id, hash of the text), so texts are not shuffled unless more than ``BROADCAST_ROWS`` such keys go.
    """
    key = F.xxhash64("text")
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", key.alias("key"))
    prefix = Prefix(common_shingles(keyed, lambda rows: shingle_sets(rows, shingle)), similarity)
    signed, _ = materialize(signatures(keyed, shingle, prefix), "signatures")
    rows = signed.groupBy("doc_id", "key", F.col("fingerprint").alias("fp")).agg(F.count("*").alias("n"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    told, _ = materialize(rows.withColumn("first", order), "rows")
    first = told.groupBy("fp").agg(F.min("first").alias("first"))
    edges, _ = materialize(links(first.select("fp"), budget).unionByName(similar_links(keyed, signed, shingle, similarity)), "links")
    placed = told.join(_components(first, edges), "fp")
    goes = placed.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), (F.col("first") == F.col("least")).alias("_stays"), "n")
    # What isn't named here stays: the first of a group, if there is but one such row.
    named, _ = materialize(goes.where("not _stays or n > 1").drop("n"), "gone")
    small = named.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    judged = docs.withColumns({"_own": F.col("doc_id").cast("long"), "_hash": key})
    on = F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_key"))
    judged = judged.join(F.broadcast(named) if small else named, on, "left")
    single = judged.where("_stays is null").select(docs.columns)
    if named.where("_stays").isEmpty():
        return single
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    whole = F.struct(*[F.col(c) for c in docs.columns])
    least = F.min_by(whole, F.to_json(F.struct(*others))) if others else F.first(whole)
    repeated = judged.where("_stays").groupBy("_id", "_key").agg(least.alias("_row")).select("_row.*")
    return single.unionByName(repeated)
