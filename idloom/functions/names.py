"""Names as columns: tokens, persons, block localities, pair confidences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A token: letters, digits and underscores, joined by single hyphens or apostrophes.
TOKEN = r"[\p{L}\p{N}_]+(?:[-'][\p{L}\p{N}_]+)*"


def tokens(name: Column) -> Column:
    return F.regexp_extract_all(name, F.lit(TOKEN), F.lit(0))


def token_count(name: Column) -> Column:
    return F.regexp_count(name, F.lit(TOKEN))


def first_text(*values: Column) -> Column:
    """The first value that is neither null nor empty, else an empty string."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values], F.lit(""))


def is_person(kind: Column) -> Column:
    return F.lower(kind) == "person"


def is_one_token_person(kind: Column, name: Column) -> Column:
    return is_person(kind) & (token_count(name) == 1)


def locality(kind: Column, name: Column, event: Column, scope: str) -> Column:
    """What confines a name: its source event for one-token persons, if the policy says so, else nothing."""
    return F.when(is_one_token_person(kind, name), event).otherwise("") if scope == "source_event" else F.lit("")


def pair_confidence(events: Column) -> Column:
    """Confidence that two of so many one-token persons of a name are one: 1 / (1 + log2 n) between 0.05 and 0.5."""
    n = events.cast("double")
    return F.when(events < 2, 0.5).otherwise(F.round(F.least(F.lit(0.5), F.greatest(F.lit(0.05), 1 / (1 + F.log2(n)))), 4))


def rate(part: Column, whole: Column) -> Column:
    """Share rounded to six places; 1 where there is nothing to share."""
    return F.when(whole == 0, 1.0).otherwise(F.round(part / whole, 6))
