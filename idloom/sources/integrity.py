"""Input checks as queries for offending rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from idloom.sources.tables import Inputs

ENTITY_ID = r"^cent_[0-9A-Za-z._:-]+$"
FACT_ID = r"^cfact_[0-9A-Za-z._:-]+$"


def _found(file: str, check: str, rows: DataFrame, key: Column | str) -> DataFrame:
    value = F.col(key) if isinstance(key, str) else key
    return rows.select(F.lit(file).alias("file"), F.lit(check).alias("check"), F.coalesce(value.cast("string"), F.lit("")).alias("key"))


def _repeated(rows: DataFrame, key: str) -> DataFrame:
    return rows.where(F.coalesce(key, F.lit("")) != "").groupBy(key).count().where("count > 1")


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def orphan_occurrences(inputs: Inputs) -> DataFrame:
    """Occurrences whose source event the ledger doesn't have."""
    return inputs.occurrences.join(inputs.ledger, "source_event_id", "left_anti")


def load_violations(inputs: Inputs) -> DataFrame:
    """(file, check, key) of everything that makes a package unusable."""
    blank = lambda c: F.coalesce(c, F.lit("")) == ""
    ledger, occurrences, facts = inputs.ledger, inputs.occurrences, inputs.facts
    parts = [
        _found("source_ledger", "incomplete row", ledger.where(blank("source_event_id") | blank("org_id") | blank("workspace_id")), "source_event_id"),
        _found("source_ledger", "duplicate source_event_id", _repeated(ledger, "source_event_id"), "source_event_id"),
        _found("source_ledger", "empty", ledger.agg(F.count("*").alias("n")).where("n = 0"), F.lit("")),
        _found("candidate_entities", "missing or malformed id", occurrences.where(~F.coalesce(F.col("candidate_entity_id").rlike(ENTITY_ID), F.lit(False))), "candidate_entity_id"),
        _found("candidate_entities", "duplicate id", _repeated(occurrences, "candidate_entity_id"), "candidate_entity_id"),
        _found("candidate_entities", "unknown source event", orphan_occurrences(inputs), "candidate_entity_id"),
        _found("candidate_facts", "missing or malformed id", facts.where(~F.coalesce(F.col("candidate_fact_id").rlike(FACT_ID), F.lit(False))), "candidate_fact_id"),
        _found("candidate_facts", "duplicate id", _repeated(facts, "candidate_fact_id"), "candidate_fact_id"),
    ]
    if "org_id" in occurrences.columns:
        declared = occurrences.withColumnRenamed("org_id", "declared").join(ledger, "source_event_id").where(~blank("declared") & (F.col("declared") != F.col("org_id")))
        parts.append(_found("candidate_entities", "organization contradicts the ledger", declared, "candidate_entity_id"))
    return _union(parts)


def lineage_violations(inputs: Inputs) -> DataFrame:
    """(file, check, key) of broken lineage between events, chunks, occurrences and facts."""
    events = inputs.ledger.select("source_event_id")
    artifacts = inputs.artifacts
    chunks = artifacts.select(F.col("source_event_id").alias("event"), F.explode("chunks").alias("c")).select("event", "c.chunk_id", "c.source_event_id")
    lineage = chunks.select("chunk_id", F.col("event").alias("source_event_id")).distinct()
    ids = inputs.occurrences.select("candidate_entity_id")
    both = ["source_event_id", "chunk_id"]
    facts = inputs.facts
    no_subject = facts.join(ids, F.col("subject_candidate_id") == F.col("candidate_entity_id"), "left_anti")
    no_object = facts.where("object_candidate_id is not null").join(ids, F.col("object_candidate_id") == F.col("candidate_entity_id"), "left_anti")
    parts = [
        _found("source_ledger", "duplicate source_event_id", _repeated(inputs.ledger, "source_event_id"), "source_event_id"),
        _found("extraction_artifacts", "unknown source event", artifacts.join(events, "source_event_id", "left_anti"), "source_event_id"),
        _found("extraction_artifacts", "missing chunk_id", chunks.where("coalesce(chunk_id, '') = ''"), "event"),
        _found("extraction_artifacts", "duplicate chunk_id", _repeated(chunks, "chunk_id"), "chunk_id"),
        _found("extraction_artifacts", "chunk of another event", chunks.where("not (event <=> source_event_id)"), "chunk_id"),
        _found("candidate_entities", "duplicate id", _repeated(ids, "candidate_entity_id"), "candidate_entity_id"),
        _found("candidate_entities", "broken event or chunk lineage", inputs.occurrences.join(lineage, both, "left_anti"), "candidate_entity_id"),
        _found("candidate_facts", "broken event or chunk lineage", facts.join(lineage, both, "left_anti"), "candidate_fact_id"),
        _found("candidate_facts", "unknown subject", no_subject, "candidate_fact_id"),
        _found("candidate_facts", "unknown object", no_object, "candidate_fact_id"),
    ]
    if "org_id" in inputs.occurrences.columns:
        other = inputs.occurrences.withColumnRenamed("org_id", "declared").join(inputs.ledger, "source_event_id").where("not (declared <=> org_id)")
        parts.append(_found("candidate_entities", "organization contradicts the ledger", other, "candidate_entity_id"))
    return _union(parts)


def chunk_count(artifacts: DataFrame) -> DataFrame:
    """One row: how many chunks the artifacts list; missing lists count as empty."""
    return artifacts.agg(F.coalesce(F.sum(F.size(F.coalesce("chunks", F.array().cast(artifacts.schema["chunks"].dataType)))), F.lit(0)).cast("long").alias("chunks"))


def input_counts(inputs: Inputs) -> DataFrame:
    """One row of input sizes."""
    one = inputs.occurrences.agg(F.count("*").alias("candidate_entities"), F.count_distinct("source_event_id").alias("distinct_source_events_referenced"))
    sizes = {"candidate_facts": inputs.facts, "source_ledger_rows": inputs.ledger, "extraction_artifacts": inputs.artifacts}
    for part in [*(rows.agg(F.count("*").alias(name)) for name, rows in sizes.items()), chunk_count(inputs.artifacts)]:
        one = one.join(F.broadcast(part), F.lit(True))  # one row each
    return one
