"""Identifiers from contents.

``native`` ids are SHA-256 prefixes, built by Spark alone. ``portable`` ids are BLAKE2b-80, for files that other tools
compare; they need Python and are computed on distinct keys only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

SEPARATOR = "\x1f"

Identify = Callable[..., Column]


def _joined(kind: str, parts: tuple[Column, ...]) -> Column:
    return F.concat_ws(SEPARATOR, F.lit(kind), *[F.coalesce(p, F.lit("")) for p in parts])


@F.pandas_udf(StringType())
def _blake2b(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: hashlib.blake2b(t.encode(), digest_size=10).hexdigest())


@F.pandas_udf(StringType())
def casefold(texts: pd.Series) -> pd.Series:
    """Full Unicode case folding, where ``lower`` is not enough."""
    return texts.map(lambda t: None if t is None else t.casefold())


def native(kind: str, *parts: Column) -> Column:
    return F.substring(F.sha2(_joined(kind, parts), 256), 1, 20)


def portable(kind: str, *parts: Column) -> Column:
    return _blake2b(_joined(kind, parts))


def entity_id(identify: Identify, *key: Column) -> Column:
    return F.concat(F.lit("canon_"), identify("entity", *key))


def edge_id(identify: Identify, subject: Column, predicate: Column, target: Column, value: Column) -> Column:
    return F.concat(F.lit("cedge_"), identify("edge", subject, predicate, target, value))
