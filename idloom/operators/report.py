"""Coverage, shape and quality of a result, as small tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from idloom import vocabulary as V
from idloom.functions import names
from idloom.operators.project import Projection
from idloom.operators.resolve import Resolution

TOP_COMPONENTS = 20
TOP_PREDICATES = 15
PERCENTILES = (50, 90, 95, 99)


def tally(rows: DataFrame, value: Column | str, name: str, count: str = "n") -> DataFrame:
    """How often each value occurs."""
    return rows.groupBy((F.col(value) if isinstance(value, str) else value).alias(name)).agg(F.count("*").alias(count))


def reason_code_counts(assignments: DataFrame) -> DataFrame:
    return tally(assignments.select(F.explode("reason_codes").alias("code")), "code", "reason_code")


def confidence_histogram(assignments: DataFrame) -> DataFrame:
    return tally(assignments, F.format_string("%.2f", "confidence"), "confidence")


def entities_by(entities: DataFrame) -> DataFrame:
    """Entities by type and by scope, in one pass: (grouping, value, n)."""
    scope = F.concat_ws("/", "org_id", "workspace_id")
    grouped = entities.select("entity_type", scope.alias("scope")).groupingSets([["entity_type"], ["scope"]], "entity_type", "scope")
    counted = grouped.agg(F.count("*").alias("n"), F.grouping("scope").alias("by_type"))
    return counted.select(F.when(F.col("by_type") == 1, "type").otherwise("scope").alias("grouping"), F.coalesce("entity_type", "scope").alias("value"), "n")


def isolated(entities: DataFrame, edges: DataFrame) -> DataFrame:
    """Entities that no edge touches."""
    touched = edges.select(F.explode(F.array_compact(F.array("subject_canonical_entity_id", "object_canonical_entity_id"))).alias("canonical_entity_id"))
    return entities.join(touched, "canonical_entity_id", "left_anti")


def largest_components(entities: DataFrame, n: int = TOP_COMPONENTS) -> DataFrame:
    quality = F.col("component_quality")
    shape = [quality[c].alias(c) for c in ("member_count", "source_event_count", "chunk_count")]
    return entities.select("canonical_entity_id", "canonical_name", "entity_type", *shape).orderBy(F.desc("member_count"), "canonical_entity_id").limit(n)


def size_percentiles(entities: DataFrame) -> DataFrame:
    """Nearest-rank percentiles of member counts, and their maximum; zeros for none.

    Sizes are counted first, so the ranks come from a table of distinct sizes.
    """
    size = F.col("component_quality.member_count").cast("long")
    sizes = entities.groupBy(size.alias("size")).agg(F.count("*").alias("weight"))
    weighted = [F.coalesce(_weighted(p), F.lit(0)).cast("long").alias(f"p{p}") for p in PERCENTILES]
    return sizes.agg(F.sort_array(F.collect_list(F.struct("size", "weight"))).alias("s")).select(*weighted, F.coalesce(F.element_at("s", -1)["size"], F.lit(0)).alias("max"))


def _weighted(percent: int) -> Column:
    """The least size that ``percent`` of the weight does not exceed; ``s`` has (size, weight) in order of size."""
    total = F.aggregate("s", F.lit(0).cast("long"), lambda a, x: a + x["weight"])
    rank = F.greatest(F.lit(1), F.ceil(F.lit(percent) * total / 100))
    start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("long").alias("found"))
    step = lambda a, x: F.struct((a["seen"] + x["weight"]).alias("seen"), F.coalesce(a["found"], F.when(a["seen"] + x["weight"] >= rank, x["size"])).alias("found"))
    return F.aggregate("s", start, step)["found"]


def coverage(occurrences: DataFrame, facts: DataFrame, result: Resolution, projection: Projection) -> DataFrame:
    """(metric, numerator, denominator, rate) for what must be covered."""
    bare = (F.size("source_event_ids") > 0) & (F.size("chunk_ids") > 0)
    members = result.entities.select(F.explode("member_candidate_entity_ids").alias("m"))
    ids = result.entities.select("canonical_entity_id")
    valid = projection.edges.join(ids, F.col("subject_canonical_entity_id") == F.col("canonical_entity_id"), "left_semi")
    valid = valid.where("object_canonical_entity_id is null").unionByName(valid.where("object_canonical_entity_id is not null").join(ids, F.col("object_canonical_entity_id") == F.col("canonical_entity_id"), "left_semi"))
    reasoned = (F.col("disposition") == V.PROJECTED) | F.arrays_overlap("reason_codes", F.array(*map(F.lit, V.VALID_REJECTIONS)))
    one = lambda rows, what, name: rows.agg(what.cast("long").alias(name))
    counts = one(occurrences, F.count("*"), "occurrences")
    for part in (
        one(facts, F.count("*"), "facts"),
        one(result.assignments, F.count("*"), "assigned"),
        members.agg(F.count("*").alias("members"), F.count_distinct("m").alias("distinct_members")),
        projection.assignments.agg(F.count("*").alias("judged"), F.count_if(reasoned).alias("reasoned")),
        one(valid, F.count("*"), "valid_edges"),
        projection.edges.agg(F.count("*").alias("edges"), F.count_if(bare & (F.size("source_candidate_fact_ids") > 0)).alias("sourced_edges")),
        result.entities.agg(F.count("*").alias("entities"), F.count_if(bare).alias("sourced_entities")),
    ):
        counts = counts.join(F.broadcast(part), F.lit(True))  # one row each
    metrics = {
        "entity_assignment_coverage": ("assigned", "occurrences"),
        "canonical_membership_coverage": ("distinct_members", "occurrences"),
        "membership_uniqueness": ("members", "occurrences"),
        "fact_disposition_coverage": ("judged", "facts"),
        "endpoint_validity": ("valid_edges", "edges"),
        "reasoned_fact_coverage": ("reasoned", "facts"),
        "provenance_coverage": ("sourced_entities + sourced_edges", "entities + edges"),
    }
    rows = [F.struct(F.lit(k).alias("metric"), F.expr(a).alias("numerator"), F.expr(b).alias("denominator")) for k, (a, b) in metrics.items()]
    return counts.select(F.inline(F.array(*rows))).withColumn("rate", names.rate(F.col("numerator"), F.col("denominator")))


def predict(labels: DataFrame, assignments: DataFrame, emitted: DataFrame) -> DataFrame:
    """``labels`` (left, right, label) with ``predicted``, ``missing`` and the left assignment's confidence.

    ``emitted``: (left, right) evidence pairs that were really written, each in order.
    """
    side = lambda c: assignments.select(F.col("candidate_entity_id").alias(c), F.col("canonical_entity_id").alias(f"{c}_entity"), F.col("confidence").alias(f"{c}_confidence"))
    pair = [F.least("left", "right").alias("a"), F.greatest("left", "right").alias("b")]
    written = emitted.select(*pair).distinct().withColumn("written", F.lit(True))
    joined = labels.join(side("left"), "left", "left").join(side("right"), "right", "left").withColumn("a", pair[0]).withColumn("b", pair[1]).join(written, ["a", "b"], "left")
    missing = F.col("left_entity").isNull() | F.col("right_entity").isNull()
    predicted = F.when(missing, "NO_MERGE").when(F.col("left_entity") == F.col("right_entity"), "MERGE").when(F.col("written"), "POSSIBLE_DUPLICATE").otherwise("NO_MERGE")
    return joined.select("left", "right", "label", predicted.alias("predicted"), missing.alias("missing"), F.col("left_confidence").alias("confidence"))


def pair_scores(predicted: DataFrame) -> DataFrame:
    """(label, true_positive, false_positive, false_negative, precision, recall, f1), a row for each of the labels."""
    matrix = predicted.groupBy("label", "predicted").agg(F.count("*").alias("n"))
    hit = lambda label, how: F.coalesce(F.sum(F.when(how(F.lit(label)), F.col("n"))), F.lit(0)).cast("long")
    rows = [
        F.struct(
            F.lit(label).alias("label"),
            hit(label, lambda x: (F.col("label") == x) & (F.col("predicted") == x)).alias("true_positive"),
            hit(label, lambda x: (F.col("label") != x) & (F.col("predicted") == x)).alias("false_positive"),
            hit(label, lambda x: (F.col("label") == x) & (F.col("predicted") != x)).alias("false_negative"),
        )
        for label in V.LABELS
    ]
    counted = matrix.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))
    share = lambda a, b: F.when(b == 0, 0.0).otherwise(a / b)
    tp, fp, fn = F.col("true_positive"), F.col("false_positive"), F.col("false_negative")
    scored = counted.withColumns({"precision": share(tp, tp + fp), "recall": share(tp, tp + fn)})
    both = F.col("precision") + F.col("recall")
    return scored.withColumn("f1", F.round(share(2 * F.col("precision") * F.col("recall"), both), 6)).withColumns({"precision": F.round("precision", 6), "recall": F.round("recall", 6)})


def profile_summary(keyed: DataFrame, facts: DataFrame, ledger: DataFrame) -> DataFrame:
    """One row about the input: sizes, repetition, one-token persons."""
    otp = F.col("otp")
    seen = keyed.agg(
        F.count("*").alias("occurrences"),
        F.count_distinct("source_event_id").alias("source_events_referenced_by_occurrences"),
        F.count_distinct("chunk_id").alias("chunks_referenced_by_occurrences"),
        F.count_distinct("org_id", "workspace_id", "type", "name_key").alias("distinct_scope_type_name_keys"),
        F.count_if(F.size("aliases") > 0).alias("occurrences_with_aliases"),
        F.count_if(otp).alias("one_token_person_occurrences"),
        F.count_distinct(F.when(otp, F.col("name_key"))).alias("one_token_person_distinct_names"),
        F.count_distinct(F.when(otp, F.struct("name_key", "source_event_id"))).alias("one_token_person_source_scoped_components"),
    )
    said = facts.agg(F.count("*").alias("facts"), F.count_distinct("predicate").alias("distinct_predicates"), F.count_if(F.expr("object_candidate_id is null")).alias("facts_without_object_entity"))
    scopes = ledger.agg(
        F.count("*").alias("ledger_rows"), F.count_distinct("org_id", "workspace_id").alias("distinct_scopes"),
        F.count_distinct("org_id").alias("distinct_organizations"), F.count_distinct("workspace_id").alias("distinct_workspaces"),
    )
    one = seen.join(F.broadcast(said), F.lit(True)).join(F.broadcast(scopes), F.lit(True))  # one row each
    repeated = F.round(1 - F.col("distinct_scope_type_name_keys") / F.col("occurrences"), 4)
    return one.withColumn("repetition_ratio", F.when(F.col("occurrences") == 0, 0.0).otherwise(repeated))


def top_predicates(facts: DataFrame, n: int = TOP_PREDICATES) -> DataFrame:
    return tally(facts, "predicate", "predicate", "facts").orderBy(F.desc("facts"), "predicate").limit(n)
