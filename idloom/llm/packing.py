"""Best-fit packing of token sequences: large items are matched two to a bin, small ones fill the gaps.

Only the histogram of piece lengths, at most ``capacity`` numbers, is needed to decide the bins. The plan is computed
from it on the driver: items above a third of the capacity (at most two fit a bin) are matched greedily, the largest
with the largest that fits; every smaller item goes to the tightest gap that takes it. Bins with equal contents are
one pattern with a multiplicity, so plan and histogram are bounded by the capacity and not by the corpus. Pieces then
find their bin by their rank among the pieces of equal length. The rank comes from counts for each (salt, length)
and a row number inside that cell, so no length gathers in one task however frequent it is.

Nulls and empty texts make one piece that holds the end token alone. Repeated rows are separate documents. An empty
table gives an empty result. Columns besides ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import bisect
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from unicodedata import is_normalized

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from idloom.llm.batches import runs
from idloom.plans.storage import materialize

CAPACITY = 4096
END_ID = 1
#: Chunks and words that a Python worker remembers with their ids. Chunks are quickly put together again.
CACHE_CHUNKS = 100_000
CACHE_WORDS = 200_000
#: Counts are kept for each (salt, length); this bounds what the driver reads to SALTS * CAPACITY small rows.
SALTS = 64


class WordEncoder(dict):
    """Encodes by the ``tokenizers`` library; as a dict it remembers the ids of white-space separated chunks.

    The tokenizer's pattern never joins text across white space and its normalizer maps chunks alone as it maps them
    in context, so a text's ids are its chunks' ids in order. A chunk of letters goes straight to the library's BPE
    model; other chunks, and marks that follow letters, go through the whole library, and so do texts with the
    strings of special tokens or with separators that Python counts as white space and the tokenizer does not.
    Values are little-endian 32-bit ids.
    """

    odd = "\x1c\x1d\x1e\x1f"
    marks = ".,!?;:)\"#$%&*"

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model.tokenize
        self.known: dict[str, bytes] = {}
        self.normal = self.tokenizer.normalizer.normalize_str
        self.special = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        # The byte-level alphabet: printable bytes stand for themselves, the others for code points from 256 on.
        plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
        self.letters = {b: 256 + i for i, b in enumerate(x for x in range(256) if x not in plain)}

    def __missing__(self, chunk: str) -> bytes:
        word = chunk.rstrip(self.marks)
        if word.isalpha():
            if word.isascii():
                low = letters = word.lower()
            else:
                low = word.lower() if is_normalized("NFC", word) and "\u03a3" not in word else self.normal(word)
                letters = low.encode().decode("latin-1").translate(self.letters)
            if low.isalpha():
                if (ids := self.known.get(low)) is None:
                    ids = self.known[low] = array("I", [x.id for x in self.model(letters)]).tobytes()
                if len(word) < len(chunk):
                    ids += self[chunk[len(word) :]]
                self[chunk] = ids
                return ids
        ids = self[chunk] = self.whole(chunk)
        return ids

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        out = []
        for text in texts:
            if len(self) > CACHE_CHUNKS:
                self.clear()
            if len(self.known) > CACHE_WORDS:
                self.known.clear()
            if any(x in text for x in self.special) or any(x in text for x in self.odd):
                out.append(self.whole(text))
            else:
                out.append(b"".join(map(self.__getitem__, text.split())))
        return out


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The worker's encoder for this file; its cache lives as long as the worker."""
    if path not in _encoders:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


PIECES = "doc_id long, piece int, start long, length long, ids binary"


def tokenize_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Token ids of each document and its end token, cut into pieces of at most ``capacity`` ids.

    Columns: doc_id, piece, start, length and ids (binary, little-endian unsigned 32 bits each).
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, width, end = encoder(tokenizer), 4 * capacity, np.array([end_id], dtype="<u4").tobytes()
        schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())])
        for batch, texts in runs(batches):
            rows: tuple[list, ...] = ([], [], [], [], [])
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), code.encode(texts), strict=True):
                ids += end
                for piece, at in enumerate(range(0, len(ids), width)):
                    part = ids[at : at + width]
                    for column, value in zip(rows, (doc_id, piece, at // 4, len(part) // 4, part), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, schema.types, strict=True)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES)


@dataclass
class Plan:
    """Bins as patterns. Row i says: ranks from ``rank[i]`` of pieces of ``length[i]`` fill bins from ``bin[i]`` on,
    ``each[i]`` to a bin, from ``offset[i]`` on. Rows are in order of (length, rank)."""

    length: np.ndarray
    rank: np.ndarray
    bin: np.ndarray
    each: np.ndarray
    offset: np.ndarray
    bins: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bin and offset of pieces."""
        at = np.searchsorted(self.length * (1 << 44) + self.rank, length * (1 << 44) + rank, side="right") - 1
        past = rank - self.rank[at]
        return self.bin[at] + past // self.each[at], self.offset[at] + past % self.each[at] * length


@dataclass
class _Gap:
    """Bins with equal contents: how many, and (length, how many in each bin) in order."""

    bins: int
    items: list[tuple[int, int]] = field(default_factory=list)


def plan_bins(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Pack so many pieces of each length."""
    left = {n: c for n, c in histogram.items() if c}
    if any(n < 1 or n > capacity for n in left):
        raise ValueError("lengths must lie between 1 and the capacity")
    gaps: dict[int, list[_Gap]] = {}
    large = sorted(n for n in left if 3 * n > capacity)
    while large:  # the largest with the largest that still fits beside it
        n = large[-1]
        at = bisect.bisect_right(large, capacity - n) - 1
        if at < 0:
            gaps.setdefault(capacity - n, []).append(_Gap(left.pop(n), [(n, 1)]))
            large.pop()
            continue
        m = large[at]
        if m == n:
            if left[n] > 1:
                gaps.setdefault(capacity - 2 * n, []).append(_Gap(left[n] // 2, [(n, 2)]))
            left[n] %= 2
            if left[n]:
                lower = large[at - 1] if at else 0
                if lower:
                    gaps.setdefault(capacity - n - lower, []).append(_Gap(1, [(n, 1), (lower, 1)]))
                    left[lower] -= 1
                else:
                    gaps.setdefault(capacity - n, []).append(_Gap(1, [(n, 1)]))
                left[n] = 0
        else:
            pairs = min(left[n], left[m])
            gaps.setdefault(capacity - n - m, []).append(_Gap(pairs, [(n, 1), (m, 1)]))
            left[n] -= pairs
            left[m] -= pairs
        for x in {n, m, large[at - 1] if at else n}:
            if x in left and not left[x]:
                del left[x]
                large.remove(x)
    sizes = sorted(gaps)
    for n in sorted((x for x in left if 3 * x <= capacity), reverse=True):
        count = left[n]
        while count:  # the tightest gap that takes it
            at = bisect.bisect_left(sizes, n)
            if at < len(sizes):
                size = sizes[at]
                gap = gaps[size].pop()
                if not gaps[size]:
                    del gaps[size], sizes[at]
            else:
                size, gap = capacity, _Gap((count + capacity // n - 1) // (capacity // n))
            each = size // n
            full = min(gap.bins, count // each)
            rest = min(count - full * each, each - 1) if full < gap.bins else 0
            for bins, k in ((full, each), (1 if rest else 0, rest), (gap.bins - full - (rest > 0), 0)):
                if bins:
                    new = size - k * n
                    if new not in gaps:
                        bisect.insort(sizes, new)
                    gaps.setdefault(new, []).append(_Gap(bins, gap.items + [(n, k)] if k else gap.items))
            count -= full * each + rest
    rows, used, bins = [], {}, 0
    for size in sorted(gaps):
        for gap in gaps[size]:
            if not gap.items:
                continue
            offset = 0
            for n, k in gap.items:
                rows.append((n, used.get(n, 0), bins, k, offset))
                used[n] = used.get(n, 0) + gap.bins * k
                offset += n * k
            bins += gap.bins
    rows.sort()
    columns = np.array(rows, dtype=np.int64).reshape(-1, 5).T
    return Plan(*columns, bins=bins)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces that have doc_id, piece, start and length.

    ``pieces`` is read more than once and must be cheap and give the same rows each time, as a written table does.
    """
    spark = pieces.sparkSession
    carried = [c for c in pieces.columns if c not in ("doc_id", "piece", "start", "length", "sequence_id", "offset")]
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece", "start"), F.lit(SALTS)).cast("int"))
    counts = salted.groupBy("length", "_salt").count().toPandas()  # SALTS * capacity rows at most
    counts = counts.sort_values(["length", "_salt"])
    counts["base"] = counts.groupby("length")["count"].cumsum() - counts["count"]
    plan = plan_bins({int(n): int(c) for n, c in counts.groupby("length")["count"].sum().items()}, capacity)
    bases = {(int(n), int(s)): int(b) for n, s, b in zip(counts["length"], counts["_salt"], counts["base"], strict=True)}
    table = np.zeros((capacity + 1, SALTS), dtype=np.int64)
    for (n, s), b in bases.items():
        table[n, s] = b
    shared = spark.sparkContext.broadcast((plan, table))
    cell = Window.partitionBy("_salt", "length").orderBy("doc_id", "piece", "start", *[F.xxhash64(c) for c in carried])
    ranked = salted.withColumn("_nth", F.row_number().over(cell))

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        plan, table = shared.value
        for frame in frames:
            length = frame["length"].to_numpy(np.int64)
            rank = table[length, frame.pop("_salt").to_numpy()] + frame.pop("_nth").to_numpy() - 1
            frame["sequence_id"], frame["offset"] = plan.place(length, rank)
            yield frame

    kept = ["doc_id", "piece", "start", "length", *carried]
    ddl = ", ".join(f"`{c}` {pieces.schema[c].dataType.simpleString()}" for c in kept)
    return ranked.select(*kept, "_salt", "_nth").mapInPandas(assign, f"{ddl}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their place and the CRC-32 of their ids; the ids are not kept."""
    pieces = tokenize_pieces(docs, tokenizer, capacity).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    written, _ = materialize(pieces, "pieces")
    return pack(written, capacity)


def sequences(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Packed training sequences: sequence_id, ids (binary, 32 bits each), doc_ids and lengths in order."""
    written, _ = materialize(tokenize_pieces(docs, tokenizer, capacity), "pieces")
    placed = pack(written, capacity)
    part = F.struct("offset", "ids", "doc_id", "length")
    grouped = placed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(part)).alias("parts"))  # one bin: bounded
    return grouped.select(
        "sequence_id",
        F.aggregate("parts", F.lit(b"").cast("binary"), lambda a, p: F.concat(a, p["ids"])).alias("ids"),
        F.col("parts.doc_id").alias("doc_ids"),
        F.col("parts.length").alias("lengths"),
    )
