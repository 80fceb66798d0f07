"""Facts to canonical edges, or to a reason why not."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idloom import vocabulary as V
from idloom.functions import ids
from idloom.policy import Policy


@dataclass(frozen=True)
class Projection:
    """Judged facts, assignments and edges, all of them lazy."""

    judged: DataFrame
    assignments: DataFrame
    edges: DataFrame


def project(facts: DataFrame, assigned: DataFrame, policy: Policy = Policy(), identify: ids.Identify = ids.native) -> Projection:
    """Judge every fact and gather those that are sound into edges.

    ``facts``: candidate_fact_id, subject_candidate_id, predicate, object_candidate_id, object_value (text; null: none),
    source_event_id, chunk_id, confidence. ``assigned``: assignments with their scope. The first reason that applies
    counts; facts with a value instead of an object have no scope or loop to check.
    """

    def side(prefix: str) -> DataFrame:
        return assigned.select(
            F.col("candidate_entity_id").alias(f"{prefix}_candidate_id"),
            F.col("canonical_entity_id").alias(f"{prefix}_entity"),
            F.struct("org_id", "workspace_id").alias(f"{prefix}_scope"),
        )

    joined = facts.join(side("subject"), "subject_candidate_id", "left").join(side("object"), "object_candidate_id", "left")
    literal = F.col("object_candidate_id").isNull()
    reason = (
        F.when(F.coalesce("predicate", F.lit("")) == "", V.MISSING_PREDICATE)
        .when(F.col("subject_entity").isNull(), V.UNRESOLVED_SUBJECT)
        .when(~literal & F.col("object_entity").isNull(), V.UNRESOLVED_OBJECT)
        .when(literal & F.col("object_value").isNull(), V.UNRESOLVED_OBJECT)
        .when(~literal & (F.col("subject_scope") != F.col("object_scope")), V.CROSS_SCOPE_ENDPOINTS)
    )
    if policy.drop_self_loops:
        reason = reason.when(~literal & (F.col("subject_entity") == F.col("object_entity")), V.SELF_LOOP)
    judged = joined.withColumn("reason", reason.otherwise(V.ENDPOINTS_RESOLVED)).withColumn("projected", F.col("reason") == V.ENDPOINTS_RESOLVED)
    identity = F.when(F.col("object_entity").isNull(), F.coalesce("object_value", F.lit(""))).otherwise("")
    judged = judged.withColumn("target", F.coalesce("object_entity", F.lit(""))).withColumn("value_text", identity)
    key = ["subject_entity", "predicate", "target", "value_text"]
    edge = ids.edge_id(identify, *[F.col(c) for c in key])
    sound = judged.where("projected")
    typed = [F.min("object_json").alias("object_json")] if "object_json" in facts.columns else []
    gathered = sound.groupBy(*key).agg(
        *typed,
        F.array_sort(F.collect_set("candidate_fact_id")).alias("source_candidate_fact_ids"),
        F.array_sort(F.collect_set(F.nullif("source_event_id", F.lit("")))).alias("source_event_ids"),
        F.array_sort(F.collect_set(F.nullif("chunk_id", F.lit("")))).alias("chunk_ids"),
        F.round(F.max("confidence"), 6).alias("confidence"),
        F.count("*").alias("contributing_fact_count"),
        F.round(F.avg(F.col("confidence").cast("decimal(20,10)")), 6).cast("double").alias("confidence_mean"),
        F.min("object_value").alias("object_value"),
    )
    edges = gathered.select(
        edge.alias("canonical_edge_id"), F.col("subject_entity").alias("subject_canonical_entity_id"), "predicate",
        F.nullif("target", F.lit("")).alias("object_canonical_entity_id"),
        F.when(F.col("target") == "", F.col("object_value")).alias("object_value"),
        "source_candidate_fact_ids", "source_event_ids", "chunk_ids", "confidence", "contributing_fact_count", "confidence_mean",
        *([F.when(F.col("target") == "", F.col("object_json")).alias("object_value_json")] if typed else []),
    )
    if identify is ids.native:
        named = judged.withColumn("canonical_edge_id", F.when(F.col("projected"), edge))
    else:  # Python ids: one for each edge, joined back by the key
        listed = gathered.select(*key, F.lit(True).alias("projected"), edge.alias("canonical_edge_id"))
        named = judged.join(listed, [*key, "projected"], "left")
    assignments = named.select(
        "candidate_fact_id",
        F.when(F.col("projected"), V.PROJECTED).otherwise(V.DROPPED_INVALID).alias("disposition"),
        "canonical_edge_id", F.array("reason").alias("reason_codes"),
    )
    return Projection(judged, assignments, edges)


def rejected_by_reason(assignments: DataFrame) -> DataFrame:
    dropped = assignments.where(F.col("disposition") == V.DROPPED_INVALID)
    return dropped.select(F.explode("reason_codes").alias("reason")).groupBy("reason").agg(F.count("*").alias("facts"))


def consolidation(assignments: DataFrame) -> DataFrame:
    """One row: facts, projected, edges and 1 - edges / projected (0 if none)."""
    counted = assignments.agg(
        F.count("*").alias("facts"), F.count_if(F.col("disposition") == V.PROJECTED).alias("projected"), F.count_distinct("canonical_edge_id").alias("edges")
    )
    return counted.withColumn("consolidation_rate", F.when(F.col("projected") == 0, 0.0).otherwise(F.round(1 - F.col("edges") / F.col("projected"), 6)))


