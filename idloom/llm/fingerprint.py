"""Document fingerprints by order MinHash.

Every k-mer of code points is numbered by its earlier occurrences in the text, so that repeats count. Hashes of (k-mer,
number) deal them into ``SLOTS`` slots; in each slot the ``TUPLE`` least are selected, put back into text order and
hashed as one tuple. So a slot of two texts agrees only if the same k-mers were selected and stand in the same order,
which makes the share of equal slots follow the edit distance and not only the sets.

One hash function is dealt into all slots, so a long text costs one pass. A slot that gets fewer than ``TUPLE`` k-mers,
as in short texts, goes on to the next level: there twice as many functions serve half as many slots each, so that it is
chosen from twice as many k-mers, up to the level at which each slot has a function of its own over the whole text. So
every slot holds a tuple in order, by one rule for all lengths; only a text of a single k-mer has tuples of one.

Likeness is 1 for two texts without characters and 0 for one of them. Null texts count as empty. Documents are in order
of doc_id downwards, null ids last, ties by text; the next of the last is the first. Repeated rows are documents of
their own. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K = 8
SLOTS = 64
TUPLE = 2
#: k-mers that a slot is expected to keep before the least are chosen; slots that get too few take all.
SPARE = 12

_odd = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
_base = 0x100000001B3
_full = 2**64 - 1


def _mix(x: np.ndarray) -> np.ndarray:
    """A finalizer that spreads 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * _odd[1]
    x = (x ^ (x >> np.uint64(27))) * _odd[2]
    return x ^ (x >> np.uint64(31))


def kmers(points: np.ndarray) -> np.ndarray:
    """Hashes of the k-mers of a text's code points; a shorter text is one k-mer."""
    if not len(points):
        return np.zeros(0, np.uint64)
    if len(points) < K:
        points = np.r_[points, np.zeros(K - len(points), points.dtype)]
    rolled, width, power = points.astype(np.uint64) + np.uint64(1), 1, _base
    while width < K:  # K is a power of two
        rolled = rolled[:-width] * np.uint64(power) + rolled[width:]
        width, power = 2 * width, power * power & _full
    return _mix(rolled)


def _order(values: np.ndarray) -> np.ndarray:
    """Places in order of value, ties in order of place."""
    low = np.uint64((1 << len(values).bit_length()) - 1)
    packed = np.sort((values & ~low) | np.arange(len(values), dtype=np.uint64))
    order = (packed & low).astype(np.int64)
    tied = np.flatnonzero((packed[1:] | low) == (packed[:-1] | low))
    if len(tied) and (values[order[tied]] != values[order[tied + 1]]).any():  # equal but for the bits that the places took
        return np.argsort(values, kind="stable")
    return order


def numbered(grams: np.ndarray) -> np.ndarray:
    """Hashes of (k-mer, how often it came before)."""
    order = _order(grams)
    ordered = grams[order]
    fresh = ordered[1:] != ordered[:-1]
    if fresh.all():
        return grams
    begins = np.flatnonzero(np.r_[True, fresh])
    number = np.arange(len(grams)) - np.repeat(begins, np.diff(np.r_[begins, len(grams)]))
    again = np.flatnonzero(number)
    rank = grams.copy()
    rank[order[again]] = _mix(grams[order[again]] + number[again].astype(np.uint64) * _odd[0])
    return rank


def _least(rank: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets (the top ``bits`` of the hash) of ``TUPLE`` k-mers or more, and the places of the least in text order."""
    places = None
    if len(rank) > 2 * SPARE << bits:  # few enough k-mers hold the least of every bucket, as a rule
        few = np.flatnonzero((rank << np.uint64(bits)) < np.uint64((SPARE << 64 + bits) // len(rank)))
        if (np.bincount(_bucket(rank[few], bits), minlength=1 << bits) >= TUPLE).all():
            places = few
    places = _order(rank) if places is None else places[_order(rank[places])]
    bucket = _bucket(rank[places], bits)
    begins = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    begins = begins[np.diff(np.r_[begins, len(bucket)]) >= TUPLE]
    return bucket[begins], np.sort(places[begins[:, None] + np.arange(TUPLE)], axis=1)


def _bucket(rank: np.ndarray, bits: int) -> np.ndarray:
    return (rank >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(rank), np.int64)


def function(level: int, number: int) -> np.uint64:
    """What tells one hash function from the others; the first one is the k-mers' own hash."""
    return np.uint64((level * SLOTS + number) * int(_odd[2]) & _full)


def sketch(grams: np.ndarray) -> np.ndarray:
    """The slots of a text from its k-mers in text order; all are 0 without any."""
    slots = np.zeros(SLOTS, np.uint32)
    if not len(grams):
        return slots
    rank = numbered(grams)
    if len(grams) < TUPLE:
        return np.full(SLOTS, max(1, int(_tuples(grams, np.zeros((1, len(grams)), np.int64), 0)[0])), np.uint32)
    whole = SLOTS.bit_length() - 1
    waiting = np.ones(SLOTS, bool)
    for level in range(whole + 1):
        bits = whole - level
        for number in range(1 << level):
            own = slice(number << bits, (number + 1) << bits)
            if waiting[own].any():
                buckets, chosen = _least(rank if not level else _mix(rank ^ function(level, number)), bits)
                fresh = waiting[own][buckets]
                at = (number << bits) + buckets[fresh]
                slots[at] = _tuples(grams, chosen[fresh], level)
                waiting[at] = False
        if not waiting.any():
            break
    return slots


def _tuples(grams: np.ndarray, chosen: np.ndarray, level: int) -> np.ndarray:
    """Hashes of k-mers in their order, 32 bits, never 0."""
    value = np.full(len(chosen), level, np.uint64)
    for i in range(chosen.shape[1]):
        value = _mix(value + grams[chosen[:, i]] + np.uint64((i + 1) * int(_odd[0]) & _full))
    return np.maximum(value >> np.uint64(32), np.uint64(1)).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal slots among those that either text fills; 1 if neither fills any."""
    either = (a > 0) | (b > 0)
    n = int(either.sum())
    return float((a[either] == b[either]).sum() / n) if n else 1.0


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def hexed(slots: np.ndarray) -> str:
    return slots.astype(">u4").tobytes().hex()


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the beginning of ``following``."""
    cut = len(text) // 2
    return text[: len(text) - cut] + following[:cut]


def _joined(own: np.ndarray, own_grams: np.ndarray, following: np.ndarray, following_grams: np.ndarray) -> np.ndarray:
    """k-mers of the edited text, from those of the two texts; only those across the seam are hashed."""
    cut = len(own) // 2
    left, right = len(own) - cut, min(cut, len(following))
    if min(left, right) < K:
        return kmers(np.r_[own[:left], following[:right]])
    seam = kmers(np.r_[own[left - K + 1 : left], following[: K - 1]])
    return np.concatenate([own_grams[: left - K + 1], seam, following_grams[: right - K + 1]])


def _in_ranges(docs: DataFrame) -> DataFrame:
    """Rows by ranges of doc_id, each range with the first row of the one that follows it (``tail``) at its end.

    Range bounds are approximate quantiles, and the largest id of each range is looked up: as many numbers as there
    are ranges, four for each shuffle partition.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    asked = 4 * parts
    ids = docs.select(F.col("doc_id").cast("double").alias("doc_id"))
    bounds = sorted({int(x) for x in ids.approxQuantile("doc_id", [i / asked for i in range(1, asked)], 1 / (2 * asked))})
    listed = f"array({', '.join(f'{b}L' for b in bounds)})" if bounds else "cast(array() as array<bigint>)"
    middle = "cast((s.lo + s.hi) div 2 as int)"
    ranged = F.expr(
        f"""if(doc_id is null, 0, aggregate(sequence(0, {max(1, len(bounds)).bit_length()}), named_struct('lo', 0, 'hi', {len(bounds)}),
            (s, i) -> case when s.lo >= s.hi then s when element_at({listed}, {middle} + 1) < doc_id
                      then named_struct('lo', {middle} + 1, 'hi', s.hi) else named_struct('lo', s.lo, 'hi', {middle}) end, s -> s.lo))"""
    )
    placed = rows.withColumn("range", ranged)
    heads = sorted((r[0], r[1]) for r in placed.groupBy("range").agg(F.max("doc_id")).collect())
    if not heads:
        return placed.withColumn("tail", F.lit(0))
    # The head of a range ends the next higher one; the highest's ends the lowest.
    goes = {number: heads[(i + 1) % len(heads)][0] for i, (number, _) in enumerate(heads)}
    most = dict(heads)
    spots = range(len(bounds) + 1)
    head = f"array({', '.join('cast(null as bigint)' if most.get(i) is None else f'{most[i]}L' for i in spots)})"
    goal = f"array({', '.join(str(goes.get(i, 0)) for i in spots)})"
    own = "named_struct('range', range, 'tail', 0)"
    copy = f"named_struct('range', element_at({goal}, range + 1), 'tail', 1)"
    spread = F.expr(f"explode(if(doc_id <=> element_at({head}, range + 1), array({own}, {copy}), array({own})))")
    dealt = placed.withColumn("_to", spread).select("doc_id", "text", "_to.range", "_to.tail")
    return dealt.repartition(parts, "range").sortWithinPartitions("range", "tail", F.col("doc_id").desc_nulls_last(), "text")


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how like they are to it and to the next document."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        last = None  # range, tail, doc_id, text, its slots, code points and k-mers
        for batch in batches:
            out = []
            for number, tail, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("range", "tail", "doc_id", "text")), strict=True):
                if last and last[0] == number and last[1]:
                    continue  # a further tie of the range's tail
                own_points = points(text)
                grams = kmers(own_points)
                slots = sketch(grams)
                if last and last[0] == number:
                    changed = edited(last[3], text)
                    own = sketch(_joined(last[5], last[6], own_points, grams))
                    out.append((last[2], len(last[3]), hashlib.sha256(changed.encode()).hexdigest(), hexed(last[4]), hexed(own), likeness(last[4], own), likeness(last[4], slots)))
                last = (number, tail, doc_id, text, slots, own_points, grams)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return _in_ranges(docs).mapInArrow(compare, SCHEMA)
