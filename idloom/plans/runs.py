"""A whole run: package in, six artifacts out."""

from __future__ import annotations

import dataclasses
import resource
import time
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from idloom import vocabulary as V
from idloom.functions import ids, names
from idloom.operators import hygiene, invariants, pairs, report
from idloom.operators.project import Projection, consolidation, project, rejected_by_reason
from idloom.operators.resolve import Resolution, block_keys, reread, resolution_stats, resolve
from idloom.plans.storage import materialize
from idloom.policy import Settings
from idloom.sources import files, integrity, jsonl, tables

STAGING = ".staging"


class Stages:
    """Wall-clock seconds of a run's stages, and the driver's peak memory."""

    def __init__(self) -> None:
        self.began, self.seconds = time.perf_counter(), {}

    @contextmanager
    def stage(self, name: str):
        at = time.perf_counter()
        try:
            yield
        finally:
            self.seconds[name] = round(time.perf_counter() - at, 3)

    def summary(self) -> dict:
        peak = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024
        return {"stages_sec": dict(self.seconds), "wall_clock_sec": round(time.perf_counter() - self.began, 3), "peak_memory_mib": round(peak, 1), "peak_memory_source": "getrusage, driver's Python"}


def _one(rows: DataFrame) -> dict:
    return rows.first().asDict()


def _pairs(rows: DataFrame, key: str, value: str) -> dict:
    return {str(r[key]): r[value] for r in rows.collect()}  # small tables only


def _violations(rows: DataFrame) -> dict[str, int]:
    return {r["invariant"]: r["violations"] for r in rows.where("violations > 0").orderBy("invariant").collect()}


def _kept(df: DataFrame, name: str) -> DataFrame:
    return materialize(df, name)[0]


def _entity_rows(entities: DataFrame) -> DataFrame:
    quality = entities.schema["component_quality"].dataType.names
    ordered = F.struct(*[F.col(f"component_quality.{c}").alias(c) for c in sorted(quality)])
    shape = ["canonical_entity_id", "canonical_name", "entity_type", "org_id", "workspace_id", "aliases", "member_candidate_entity_ids", "source_event_ids", "chunk_ids"]
    return entities.select(*shape, ordered.alias("component_quality"))


def _edge_rows(edges: DataFrame) -> DataFrame:
    shown = edges.drop("object_value") if "object_value_json" in edges.columns else edges
    return shown


def identity_quality(labels: DataFrame, assignments: DataFrame, emitted: DataFrame, source: str) -> dict:
    """The three-class confusion matrix of labelled pairs against what was written."""
    predicted = report.predict(labels, assignments, emitted).cache()
    scores = {r["label"]: r.asDict() for r in report.pair_scores(predicted).collect()}
    matrix = {(r["label"], r["predicted"]): r["n"] for r in predicted.groupBy("label", "predicted").agg(F.count("*").alias("n")).collect()}
    macro = round(sum(s["f1"] for s in scores.values()) / len(V.LABELS), 6)
    tiers = [r["confidence"] for r in predicted.where("predicted = 'MERGE'").select("confidence").orderBy("confidence").collect()]
    merged = {"count": len(tiers)} | ({"min": tiers[0], "max": tiers[-1], "mean": round(sum(tiers) / len(tiers), 6), "histogram": {f"{t:.2f}": sum(f"{x:.2f}" == f"{t:.2f}" for x in tiers) for t in sorted(set(tiers))}} if tiers else {})
    per_class = {k: {x: v for x, v in s.items() if x != "label"} | {"support": s["true_positive"] + s["false_negative"]} for k, s in scores.items()}
    return {
        "source": source, "macro_f1": macro, "threshold": 0.80, "pass": macro >= 0.80,
        "hard_merge_precision": scores["MERGE"]["precision"], "hard_merge_precision_threshold": 0.97,
        "missing_assignments": predicted.where("missing").count(), "per_class": per_class,
        "confusion_matrix": {t: {p: matrix.get((t, p), 0) for p in V.LABELS} for t in V.LABELS},
        "predicted_class_counts": {p: sum(matrix.get((t, p), 0) for t in V.LABELS) for p in V.LABELS},
        "predicted_class_confidence": {"MERGE": merged, "NO_MERGE": {"count": 0}, "POSSIBLE_DUPLICATE": {"count": 0}},
    }


def build_report(settings: Settings, inputs: tables.Inputs, result: Resolution, projection: Projection, plan: DataFrame, rows: DataFrame, written: dict, violations: dict[str, int], stages: Stages) -> dict:
    policy = settings.policy
    budget = policy.possible_duplicate_pair_budget
    stats = _one(pairs.enumeration_stats(rows, plan, result.links, budget))
    group_rows = stats["alias_group_rows"] + stats["truncated_groups"]
    folded = _one(consolidation(projection.assignments))
    coverage = {r["metric"]: {k: r[k] for k in ("numerator", "denominator", "rate")} for r in report.coverage(inputs.occurrences, inputs.facts, result, projection).collect()}
    entities, edges = coverage["provenance_coverage"]["denominator"] - coverage["endpoint_validity"]["denominator"], coverage["endpoint_validity"]["denominator"]
    loops = projection.edges.where("subject_canonical_entity_id = object_canonical_entity_id").count()
    isolated = report.isolated(result.entities.select("canonical_entity_id"), projection.edges).count()
    share = lambda a, b: {"numerator": a, "denominator": b, "rate": round(a / b, 6) if b else 1.0}
    grouped = report.entities_by(result.entities).collect()
    dangling = violations.get("edges_with_unknown_subject", 0) + violations.get("edges_with_unknown_object", 0)
    crossing = ("cross_organization_components", "cross_workspace_components", "cross_type_components")
    return {
        **{k: v for k, v in policy.describe().items() if k != "policy"},
        "configuration": policy.settings(),
        "input_counts": _one(integrity.input_counts(inputs)),
        "output_counts": {
            "entity_assignments": coverage["entity_assignment_coverage"]["numerator"], "canonical_entities": entities, "canonical_edges": edges, "fact_assignments": folded["facts"],
            "possible_duplicates": stats["pairwise_rows"] + group_rows, "possible_duplicates_pairwise": stats["pairwise_rows"], "possible_duplicates_group_level": group_rows,
            "facts_projected": folded["projected"], "facts_rejected": folded["facts"] - folded["projected"],
        },
        "coverage": coverage,
        "determinism": {"deterministic_hash_agreement": {"compared_files": sorted(written), "sha256": {k: v["sha256"] for k, v in written.items()}, "note": "one run can't observe agreement between two; compare these"}},
        "safety": {
            "boundary_violations": sum(violations.get(k, 0) for k in crossing), **{k: violations.get(k, 0) for k in (*crossing, "prohibited_one_token_person_components", "facts_on_multiple_edges")},
            "dangling_edge_endpoints": dangling, "self_loop_edges": loops, "invariant_violations": violations, "invariant_violations_total": sum(violations.values()),
            "external_services_used": [], "network_access": False, "remote_model_calls": 0, "estimated_cost_usd": 0.0,
        },
        "components": {
            "canonical_entities_by_type": {r["value"]: r["n"] for r in sorted(grouped, key=lambda r: r["value"]) if r["grouping"] == "type"},
            "canonical_entities_by_scope": {r["value"]: r["n"] for r in sorted(grouped, key=lambda r: r["value"]) if r["grouping"] == "scope"},
            "size_percentiles": _one(report.size_percentiles(result.entities)), "size_percentile_method": "nearest-rank over member counts",
            "largest_components": [r.asDict() for r in report.largest_components(result.entities).collect()],
            "isolated_canonical_entities": share(isolated, entities),
            "edges": {"count": edges, "consolidation_rate": folded["consolidation_rate"], "self_loop_rate": share(loops, edges), "orphan_edges": dangling, "predicates": projection.edges.agg(F.count_distinct("predicate")).first()[0]},
            "facts_rejected_by_reason": _pairs(rejected_by_reason(projection.assignments), "reason", "facts"),
            "entity_decisions": _pairs(report.tally(result.assignments, "decision", "decision"), "decision", "n"),
            "entity_reason_codes": _pairs(report.reason_code_counts(result.assignments), "reason_code", "n"),
            "assignment_confidence_histogram": _pairs(report.confidence_histogram(result.assignments), "confidence", "n"),
            "unresolved_pairs": stats | {"group_rows": group_rows, "budget": budget, "allocation": "complete enumeration" if budget is None or not stats["unresolved_groups"] else "whole groups in descending occurrences-per-pair order", "confidence_histogram": _pairs(pairs.confidence_histogram(plan), "confidence", "pairs")},
            "resolution_stats": _one(resolution_stats(result, policy)),
        },
        "runtime": stages.summary(),
        "outputs": written,
    }


def _shared_id(entities: DataFrame) -> str | None:
    """An id that several entities have, if any: their content hashes collide."""
    found = entities.groupBy("canonical_entity_id").count().where("count > 1").first()
    return found and found["canonical_entity_id"]


def run(spark: SparkSession, settings: Settings, labels: str | None = None) -> dict:
    """Read a package, resolve, project, verify, and write the artifacts; all six appear at once or none."""
    policy, stages = settings.policy, Stages()
    with stages.stage("load"):
        inputs = jsonl.load_package(spark, settings.input_dir)
        scoped = _kept(tables.scoped(inputs.occurrences, inputs.ledger), "scoped")
    with stages.stage("resolve"):
        lazy = resolve(scoped, policy, ids.portable, ids.casefold)
        entities = _kept(lazy.entities, "entities")
        lazy = dataclasses.replace(reread(lazy, entities, _kept(lazy.assignments, "assignments")), links=_kept(lazy.links, "alias-links"), edges=_kept(lazy.edges, "alias-edges"))
    if shared := _shared_id(lazy.entities):
        raise RuntimeError(f"two entities have the id {shared}")
    with stages.stage("verify_entities"):
        violations = _violations(invariants.entity_invariants(lazy.entities, lazy.assignments, lazy.keyed))
    with stages.stage("project"):
        projected = project(inputs.facts, lazy.assignments, policy, ids.portable)
        projected = dataclasses.replace(projected, assignments=_kept(projected.assignments, "fact-assignments"), edges=_kept(projected.edges, "edges"))
    with stages.stage("verify_edges"):
        violations |= _violations(invariants.edge_invariants(projected.edges, projected.assignments, lazy.entities))
    rows = pairs.members(lazy)
    plan = _kept(pairs.budget_plan(pairs.pair_counts(rows), policy.possible_duplicate_pair_budget), "plan")
    staging = files.join(settings.output_dir, STAGING)
    files.remove(spark, staging)
    files.make_folder(spark, staging)
    try:
        with stages.stage("write"):
            duplicates = pairs.possible_duplicates(lazy, policy.possible_duplicate_pair_budget).withColumnsRenamed({"level": "_level", "pair_order": "_pair_order"})
            artifacts = {
                "entity_assignments.jsonl": (lazy.assignments.select("candidate_entity_id", "canonical_entity_id", "decision", "confidence", "reason_codes"), ["candidate_entity_id"], ()),
                "canonical_entities.jsonl": (_entity_rows(lazy.entities), ["canonical_entity_id"], ()),
                "possible_duplicates.jsonl": (duplicates, ["_level", "_pair_order", "left_canonical_entity_id", "right_canonical_entity_id", "evidence_candidate_entity_ids"], ()),
                "fact_assignments.jsonl": (projected.assignments, ["candidate_fact_id"], ("canonical_edge_id",)),
                "canonical_edges.jsonl": (_edge_rows(projected.edges), ["canonical_edge_id"], ("object_canonical_entity_id",)),
            }
            counts = {name: jsonl.write_sorted(table, order, staging, name, always) for name, (table, order, always) in artifacts.items()}
        with stages.stage("report"):
            written = {n: {"rows": counts[n], "bytes": files.size(spark, files.join(staging, n)), "sha256": files.sha256(spark, files.join(staging, n))} for n in counts}
            document = build_report(settings, inputs, lazy, projected, plan, rows, written, violations, stages)
            if labels and files.is_file(spark, labels):
                asked = jsonl.read(spark, labels, jsonl.SCHEMAS["public_labeled_pairs.jsonl"]).select(F.col("left_candidate_entity_id").alias("left"), F.col("right_candidate_entity_id").alias("right"), "label")
                grouped = pairs.alias_questions(lazy).select("evidence_candidate_entity_ids").unionByName(pairs.truncated_groups(rows, plan).select("evidence_candidate_entity_ids"))
                two = grouped.select(F.array_distinct("evidence_candidate_entity_ids").alias("e")).where(F.size("e") == 2).select(F.get("e", F.lit(0)).alias("left"), F.get("e", F.lit(1)).alias("right"))
                emitted = pairs.asked_pairs(asked, rows, plan).unionByName(two)
                document["identity_quality"] = identity_quality(asked, lazy.assignments, emitted, labels)
            jsonl.write_json(spark, files.join(staging, "quality_report.json"), document)
        jsonl.publish(spark, staging, settings.output_dir, [*counts, "quality_report.json"])
    finally:
        files.remove(spark, staging)
    return {"counts": counts, "violations": violations, "sha256": {n: w["sha256"] for n, w in written.items()}, "report": document}


def profile(spark: SparkSession, settings: Settings) -> dict:
    """What an input package holds."""
    inputs = jsonl.load_package(spark, settings.input_dir)
    keyed = block_keys(tables.scoped(inputs.occurrences, inputs.ledger), settings.policy)
    people = keyed.where(names.is_person(F.col("type")))
    return _one(report.profile_summary(keyed, inputs.facts, inputs.ledger)) | {
        "occurrences_by_type": _pairs(report.tally(keyed, "type", "type").orderBy("type"), "type", "n"),
        "person_name_token_counts": _pairs(report.tally(people, names.token_count(F.col("name_key")), "tokens").orderBy("tokens"), "tokens", "n"),
        "top_predicates": _pairs(report.top_predicates(inputs.facts), "predicate", "facts"),
    }


def validate(spark: SparkSession, folder: str) -> dict:
    """Lineage of a package: counts and status, with the first broken rows."""
    inputs = jsonl.load_package(spark, folder, check=False)
    found = integrity.lineage_violations(inputs).orderBy("file", "check", "key").limit(20).collect()
    return _one(integrity.input_counts(inputs)) | {"status": "FAIL" if found else "PASS", "violations": [r.asDict() for r in found]}


def hygiene_check(spark: SparkSession, folder: str) -> dict:
    """Text hygiene of a package: every string of every file but technical fields, ids, hashes and dates."""
    strings = None
    for name in jsonl.FILES:
        lines = spark.read.text(f"{folder.rstrip('/')}/{name}").where("trim(value) <> ''")
        part = lines.mapInPandas(_strings, "key string, text string")
        strings = part if strings is None else strings.union(part)
    hits = hygiene.text_hits(strings)
    kinds = [c for c in hits.columns if c.endswith("_hits")]
    found = _one(hits.agg(F.count("*").alias("text_values_scanned"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in kinds]))
    inputs = jsonl.load_package(spark, folder, check=False)
    found |= _one(hygiene.type_hits(inputs.occurrences, ids.casefold))
    wrong = sum(v for k, v in found.items() if k != "text_values_scanned")
    return found | {"status": "FAIL" if wrong else "PASS"}


def _strings(frames):
    """Every string in JSON lines that hygiene is to read, with the key that it stands under."""
    import json
    import re

    import pandas as pd

    dated = re.compile(r"^\d{4}-\d{2}-\d{2}(?:[T\s].*)?$")

    def walk(value, key):
        if isinstance(value, dict):
            for k, v in value.items():
                yield from walk(v, k)
        elif isinstance(value, list):
            for v in value:
                yield from walk(v, key)
        elif isinstance(value, str):
            low = key.casefold()
            skipped = low in hygiene.TECHNICAL_FIELDS or low.endswith(("_id", "_hash"))
            date = (low.endswith("_at") or low == "reference_time") and (dated.match(value) or value.casefold() in ("null", "none"))
            if not skipped and not date:
                yield key, value

    for frame in frames:
        found = [x for line in frame["value"] for x in walk(json.loads(line), "")]
        yield pd.DataFrame(found, columns=["key", "text"])


