"""Command line: run, profile, verify, config, validate, hygiene and score."""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from idloom.policy import PolicyError, load_settings

OK, FAILED, BAD_SETTINGS, BAD_INPUT, VIOLATIONS = 0, 1, 2, 3, 5


def session() -> SparkSession:
    """The session of spark-submit if there is one, else a local one."""
    builder = SparkSession.builder.appName("idloom").config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    if "PYSPARK_GATEWAY_PORT" not in os.environ and SparkSession.getActiveSession() is None:
        builder = builder.master("local[*]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", str(os.cpu_count() or 4))
    return builder.getOrCreate()


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="idloom", description=__doc__)
    parser.add_argument("--config", default="config.toml", help="TOML settings; defaults apply if the file is missing")
    commands = parser.add_subparsers(dest="command", required=True)
    for name, text in {
        "run": "resolve a package and write the artifacts", "profile": "summarise a package", "verify": "check written artifacts against their package",
        "config": "show the settings", "validate": "check a package's lineage", "hygiene": "check a package's texts", "score": "score artifacts against labelled pairs",
    }.items():
        command = commands.add_parser(name, help=text)
        command.add_argument("--input-dir")
        command.add_argument("--output-dir")
        if name == "run":
            command.add_argument("--possible-duplicate-pair-budget", type=int)
            command.add_argument("--merge-on-alias", action="store_true", default=None)
            command.add_argument("--alias-min-support", type=int)
            command.add_argument("--no-labels", action="store_true")
        if name in ("run", "score"):
            command.add_argument("--labels", default="data/reference/public_labeled_pairs.jsonl")
        if name == "config":
            command.add_argument("--show", action="store_true", default=True)
    return parser


def _show(document: dict) -> None:
    print(json.dumps(document, indent=2, sort_keys=True, default=str))


def _score(spark: SparkSession, output_dir: str, labels: str) -> int:
    from idloom.plans import acceptance, runs
    from idloom.sources import jsonl

    at = output_dir.rstrip("/")
    assigned = jsonl.read(spark, f"{at}/entity_assignments.jsonl", acceptance._SCHEMAS["entity_assignments.jsonl"])
    written = jsonl.read(spark, f"{at}/possible_duplicates.jsonl", acceptance._SCHEMAS["possible_duplicates.jsonl"])
    two = written.select(F.array_distinct("evidence_candidate_entity_ids").alias("e")).where(F.size("e") == 2).select(F.get("e", F.lit(0)).alias("left"), F.get("e", F.lit(1)).alias("right"))
    asked = jsonl.read(spark, labels, jsonl.SCHEMAS["public_labeled_pairs.jsonl"]).select(F.col("left_candidate_entity_id").alias("left"), F.col("right_candidate_entity_id").alias("right"), "label")
    scores = runs.identity_quality(asked, assigned, two, labels)
    _show(scores)
    return OK if scores["pass"] else FAILED


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    changed = {k: getattr(args, k, None) for k in ("input_dir", "output_dir", "possible_duplicate_pair_budget", "merge_on_alias", "alias_min_support")}
    try:
        settings = load_settings(args.config, **changed)
    except (PolicyError, TypeError) as error:
        print(f"configuration error: {error}", file=sys.stderr)
        return BAD_SETTINGS
    if args.command == "config":
        _show(settings.policy.describe())
        return OK
    from idloom.plans import acceptance, runs
    from idloom.sources.jsonl import InputError

    try:
        spark = session()
        if args.command == "profile":
            _show(runs.profile(spark, settings))
            return OK
        if args.command in ("validate", "hygiene"):
            found = (runs.validate if args.command == "validate" else runs.hygiene_check)(spark, settings.input_dir)
            _show(found)
            return OK if found["status"] == "PASS" else FAILED
        if args.command == "score":
            return _score(spark, settings.output_dir, args.labels)
        if args.command == "verify":
            try:
                _show(acceptance.verify(spark, settings.input_dir, settings.output_dir))
            except acceptance.VerificationError as error:
                _show({"status": "FAIL", "error": str(error)})
                return FAILED
            return OK
        done = runs.run(spark, settings, None if args.no_labels else args.labels)
        quality = done["report"].get("identity_quality")
        summary = {
            "status": "INVARIANT_VIOLATIONS" if done["violations"] else "OK", "output_dir": settings.output_dir, "counts": done["counts"], "output_sha256": done["sha256"],
            "runtime": done["report"]["runtime"], "configuration_fingerprint": settings.policy.fingerprint(), "invariant_violations": done["violations"],
        }
        if quality:
            summary["identity_quality"] = {k: quality[k] for k in ("macro_f1", "hard_merge_precision", "pass")}
        _show(summary)
        return VIOLATIONS if done["violations"] else OK
    except InputError as error:
        print(f"input error: {error}", file=sys.stderr)
        return BAD_INPUT


if __name__ == "__main__":
    sys.exit(main())
