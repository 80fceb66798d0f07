"""Near-duplicate embeddings by cross-polytope hashing after fast Hadamard rotations.

Equal vectors of a label are joined first. Each distinct vector is rotated by three rounds of random signs and a fast
Hadamard transform; the nearest of the 2d signed axes is its hash. ``HASHES`` such hashes make a table's bucket, and
each vector goes to its ``PROBES`` likeliest buckets in each of ``TABLES`` tables. Two vectors at cosine 0.93 in 64
dimensions share a bucket with a probability above 0.999; tests ask for 0.97 at 2 to 512. Every pair that shares one is verified by
its cosine in double precision, so no link is false. A pair that shares several buckets counts in the first of them
only, which both rows can tell from the buckets they carry; so pairs are counted where they meet and never leave the
task: it returns each vector's number of links and a spanning forest. Buckets above ``HOT_BUCKET`` are dealt into cells.

Vectors that are null, zero or hold null, NaN or infinite components, and those without a label, link with nothing.
Vectors of different lengths don't link. Repeated rows are vectors of their own and link with each other, even under
one vec_id. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from idloom.llm.cells import deal
from idloom.llm.simhash import component_minimum
from idloom.plans.components import connected_components
from idloom.plans.storage import materialize

TABLES = 8
HASHES = 2
PROBES = 2
ROUNDS = 3
SEED = 20_240_501
#: Rows of one bucket that a single cell takes.
HOT_BUCKET = 2_000


def hadamard(rows: np.ndarray) -> np.ndarray:
    """Fast Hadamard transform of each row; their length is a power of two."""
    n, d = rows.shape
    half = 1
    while half < d:
        split = rows.reshape(n, d // (2 * half), 2, half)
        rows = np.stack([split[:, :, 0] + split[:, :, 1], split[:, :, 0] - split[:, :, 1]], axis=2).reshape(n, d)
        half *= 2
    return rows


def buckets(vectors: np.ndarray) -> np.ndarray:
    """Buckets of each unit vector: one row each, table after table, ``PROBES`` to a table, unlike across tables."""
    n, dim = vectors.shape
    width = 1 << max(0, dim - 1).bit_length()
    padded = np.zeros((n, width))
    padded[:, :dim] = vectors
    probes = min(PROBES, width)
    kept = probes if width > 2 else probes**HASHES  # in two dimensions all, so that no near pair is ever apart
    found = []
    for table in range(TABLES):
        code, loss = np.zeros((n, 1), np.int64), np.zeros((n, 1))
        for number in range(HASHES):
            signs = np.random.default_rng([SEED, width, table, number])
            turned = padded
            for _ in range(ROUNDS):
                turned = hadamard(turned * signs.choice([-1.0, 1.0], width)) / np.sqrt(width)
            size = np.abs(turned)
            axis = np.argsort(-size, axis=1, kind="stable")[:, :probes]
            best = np.take_along_axis(size, axis, 1)
            own = 2 * axis + (np.take_along_axis(turned, axis, 1) < 0)
            code = (code[:, :, None] * (2 * width) + own[:, None, :]).reshape(n, -1)
            loss = (loss[:, :, None] + (best[:, :1] - best)[:, None, :] ** 2).reshape(n, -1)
            order = np.argsort(loss, axis=1, kind="stable")[:, :kept]
            code, loss = np.take_along_axis(code, order, 1), np.take_along_axis(loss, order, 1)
        found.append(table * (2 * width) ** HASHES + code)
    return np.concatenate(found, axis=1)


def usable(vector: Column) -> Column:
    """Whether a vector can link: not null, and finite components not all of which are zero."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~odd & F.exists(vector, lambda x: x != 0), F.lit(False))


def _hashed(distinct: DataFrame) -> DataFrame:
    """Rows of ``distinct`` (uid, label, vector, copies) once for each bucket, with all of the row's buckets.

    The buckets are written once: they are read to count the large ones and again to deal the rows.
    """

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sizes = frame["vector"].map(len)
            for _, part in frame.groupby(sizes):
                rows = np.stack(part["vector"].to_numpy()).astype(np.float64)
                yield part.assign(codes=list(buckets(rows / np.linalg.norm(rows, axis=1)[:, None])))

    schema = f"uid long, label {distinct.schema['label'].dataType.simpleString()}, vector array<{distinct.schema['vector'].dataType.elementType.simpleString()}>, copies long, codes array<long>"
    placed = distinct.select("uid", "label", "vector", "copies").mapInPandas(place, schema)
    written, _ = materialize(placed, "buckets")
    return written.withColumn("size", F.size("vector")).withColumn("code", F.explode("codes"))


def _verified(dealt: DataFrame, threshold: float) -> DataFrame:
    """(uid, links, parent): for every bucket and every vector with links counted there, how many and its root."""

    def bucket(code: int, uid: np.ndarray, vectors: np.ndarray, copies: np.ndarray, codes: np.ndarray, part: np.ndarray):
        rows = vectors.astype(np.float64)
        rows /= np.linalg.norm(rows, axis=1)[:, None]
        i, j = np.nonzero(np.triu(rows @ rows.T >= threshold, 1))
        if part[0] != part[-1] or (part != part[0]).any():  # a cell of two parts: pairs across them only
            across = part[i] != part[j]
            i, j = i[across], j[across]
        step = 200_000
        first = []
        for at in range(0, len(i), step):  # the first bucket that both share
            a, b = codes[i[at : at + step]], codes[j[at : at + step]]
            shared = np.full(len(a), np.iinfo(np.int64).max)
            for t in range(0, codes.shape[1], codes.shape[1] // TABLES):
                for p in range(t, t + codes.shape[1] // TABLES):
                    equal = (a[:, p : p + 1] == b[:, t : t + codes.shape[1] // TABLES]).any(axis=1)
                    shared = np.where(equal, np.minimum(shared, a[:, p]), shared)
            first.append(shared == code)
        if not len(i):
            return None
        here = np.concatenate(first)
        i, j = i[here], j[here]
        if not len(i):
            return None
        links = np.bincount(i, copies[j], len(uid)) + np.bincount(j, copies[i], len(uid))
        parent = np.arange(len(uid))
        while True:  # least place of each component
            low = np.minimum(parent[i], parent[j])
            moved = parent.copy()
            np.minimum.at(moved, parent[i], low)
            np.minimum.at(moved, parent[j], low)
            moved = moved[moved]
            if np.array_equal(moved, parent):
                break
            parent = moved
        linked = links > 0
        return uid[linked], links[linked].astype(np.int64), uid[parent[linked]]

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(table: pa.Table) -> Iterator[pa.RecordBatch]:
            cell = table.column("cell").to_numpy()
            ends = np.r_[np.flatnonzero(cell[1:] != cell[:-1]) + 1, len(cell)]
            columns = {c: table.column(c).to_numpy() for c in ("code", "uid", "copies", "own")}
            begin = 0
            for end in ends:
                if end - begin > 1:
                    part = table.slice(begin, end - begin).combine_chunks()
                    vectors, codes = (part.column(c).chunk(0).flatten().to_numpy().reshape(end - begin, -1) for c in ("vector", "codes"))
                    x = slice(begin, end)
                    found = bucket(columns["code"][begin], columns["uid"][x], vectors, columns["copies"][x], codes, columns["own"][x])
                    if found:
                        yield pa.RecordBatch.from_arrays(list(map(pa.array, found)), names=["uid", "links", "parent"])
                begin = end

        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            table = pa.Table.from_batches(held)
            cell = table.column("cell").to_numpy()
            cut = int(np.flatnonzero(cell == cell[-1])[0])  # the last cell may go on
            if cut:
                yield from done(table.slice(0, cut))
                held = table.slice(cut).to_batches()
        if held:
            yield from done(pa.Table.from_batches(held))

    keyed = dealt.select(F.xxhash64("label", "size", "code", "cell_i", "cell_j").alias("cell"), "code", "uid", "vector", "copies", "codes", "own")
    return keyed.repartition("cell").sortWithinPartitions("cell", "uid").mapInArrow(verify, "uid long, links long, parent long")


def near_duplicates(vectors: DataFrame, threshold: float = 0.93) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``vectors`` (vec_id, embedding, label)."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector"), "label")
    can = usable(F.col("vector")) & F.col("label").isNotNull()
    equal = rows.where(can).groupBy("label", "vector").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
    distinct, _ = materialize(equal.withColumn("uid", F.monotonically_increasing_id()), "vectors")
    hashed = _hashed(distinct)
    found, _ = materialize(_verified(deal(hashed, ["label", "size", "code"], ["uid"], HOT_BUCKET), threshold), "vector-links")
    links = found.groupBy("uid").agg(F.sum("links").alias("links"))
    components = connected_components(found.where("uid <> parent"), "uid", "parent")
    least = component_minimum(components, distinct.select(F.col("uid").alias("fp"), "first")).withColumnRenamed("fp", "uid")
    known = distinct.join(links, "uid", "left").join(least, "uid", "left").select(
        "label", "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("least", "first").alias("component_id")
    )
    linked = rows.where(can).join(known, ["label", "vector"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~can).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
