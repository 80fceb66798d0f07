"""Dealing groups whose pairs are to be compared, so that no task gets a large group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def deal(rows: DataFrame, key: list[str], identity: list[str], limit: int) -> DataFrame:
    """``rows`` with ``cell_i``, ``cell_j`` and ``own``: groups by ``key`` above ``limit`` rows are cut into cells.

    A group of more than ``limit`` rows is split by a hash of ``identity`` into parts of about ``limit`` rows. Each pair
    of parts is a cell, and a row goes to every cell with its part, which ``own`` names. So every pair of rows of a
    group meets: in the one cell of its parts if they differ, else in each cell with its part, of which (own, own) is one.
    """
    hot = rows.groupBy(*key).count().where(F.col("count") > limit)
    if hot.isEmpty():
        zero = F.lit(0)
        return rows.select("*", zero.alias("cell_i"), zero.alias("cell_j"), zero.alias("own"))
    parts = F.ceil(F.coalesce("count", F.lit(1)) / limit).cast("int")
    split = rows.join(hot, key, "left").withColumn("_parts", parts)
    own = F.pmod(F.xxhash64(*identity), F.col("_parts")).cast("int")
    dealt = split.withColumn("own", own).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    return dealt.select(*rows.columns, F.least("own", "_other").alias("cell_i"), F.greatest("own", "_other").alias("cell_j"), "own")
