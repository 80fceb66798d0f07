"""JSON Lines packages: readers with declared schemas, and sinks."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from idloom.sources import files, integrity
from idloom.sources.tables import Inputs

FILES = ("candidate_entities.jsonl", "candidate_facts.jsonl", "source_ledger.jsonl", "extraction_artifacts.jsonl")
CORRUPT = "_corrupt"

SCHEMAS = {
    "candidate_entities.jsonl": "candidate_entity_id string, type string, name string, normalized_name string, aliases array<string>, confidence double, source_event_id string, chunk_id string, org_id string",
    "candidate_facts.jsonl": "candidate_fact_id string, subject_candidate_id string, predicate string, object_candidate_id string, object_value variant, confidence double, source_event_id string, chunk_id string",
    "source_ledger.jsonl": "source_event_id string, org_id string, workspace_id string",
    "extraction_artifacts.jsonl": "source_event_id string, chunks array<struct<chunk_id string, source_event_id string>>",
    "public_labeled_pairs.jsonl": "left_candidate_entity_id string, right_candidate_entity_id string, label string",
}


class InputError(Exception):
    """A package that can't be used."""


def read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a JSON Lines file; blank lines are skipped and malformed ones are fatal, with their place."""
    rows = spark.read.schema(f"{schema}, {CORRUPT} string").option("columnNameOfCorruptRecord", CORRUPT).option("mode", "PERMISSIVE").json(path)
    return rows


def malformed(spark: SparkSession, path: str) -> tuple[int, str] | None:
    """The first line of a file that is no JSON object, with its number from 1; read only to tell an error."""
    lines = spark.sparkContext.textFile(path).zipWithIndex()

    def bad(pair: tuple[str, int]) -> bool:
        try:
            return bool(pair[0].strip()) and not isinstance(json.loads(pair[0]), dict)
        except ValueError:
            return True

    found = lines.filter(bad).takeOrdered(1, key=lambda x: x[1])
    return (found[0][1] + 1, found[0][0]) if found else None


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    path = f"{folder.rstrip('/')}/{name}"
    rows = read(spark, path, SCHEMAS[name])
    broken = rows.where(F.col(CORRUPT).isNotNull()).select(rows.columns[0], CORRUPT).limit(1).collect()
    if broken:
        line = malformed(spark, path)
        raise InputError(f"{name}:{line[0]}: not a JSON object" if line else f"{name}: a field has the wrong type")
    return rows.drop(CORRUPT)


def missing_files(spark: SparkSession, folder: str, names: tuple[str, ...] = FILES) -> list[str]:
    """Which files a folder lacks, in any file system that Spark knows."""
    return [n for n in names if not files.exists(spark, files.join(folder, n))]


def load_package(spark: SparkSession, folder: str, check: bool = True) -> Inputs:
    """The four inputs of a package folder; raises :class:`InputError` for what :mod:`integrity` finds."""
    if missing := missing_files(spark, folder):
        raise InputError(f"missing input files: {', '.join(missing)}")
    tables = {name: _table(spark, folder, name) for name in FILES}
    blank = lambda c: F.coalesce(c, F.lit(""))
    entities = tables["candidate_entities.jsonl"].select(
        "candidate_entity_id", blank("type").alias("type"), blank("name").alias("name"), "normalized_name",
        F.filter(F.coalesce("aliases", F.array().cast("array<string>")), lambda a: a.isNotNull() & (a != "")).alias("aliases"),
        F.coalesce("confidence", F.lit(0.0)).alias("confidence"), "source_event_id", blank("chunk_id").alias("chunk_id"), "org_id",
    )
    # A JSON null is a variant value and no SQL null.
    value = F.when(F.col("object_value").isNotNull() & ~F.is_variant_null("object_value"), F.coalesce(F.try_variant_get("object_value", "$", "string"), F.to_json("object_value")))
    facts = tables["candidate_facts.jsonl"].select(
        "candidate_fact_id", blank("subject_candidate_id").alias("subject_candidate_id"), blank("predicate").alias("predicate"),
        F.nullif("object_candidate_id", F.lit("")).alias("object_candidate_id"), value.alias("object_value"),
        F.when(value.isNotNull(), F.to_json("object_value")).alias("object_json"),
        "source_event_id", blank("chunk_id").alias("chunk_id"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"),
    )
    inputs = Inputs(tables["source_ledger.jsonl"], entities, facts, tables["extraction_artifacts.jsonl"])
    if check and (found := integrity.load_violations(inputs).orderBy("file", "check", "key").limit(5).collect()):
        raise InputError("; ".join(f"{r['file']}: {r['check']}: {r['key']}" for r in found))
    return inputs


def _field(name: str, always: bool) -> Column:
    """``"name":value`` of a column; null where the value is, unless it is ``always`` to be shown.

    A column whose name ends in ``_json`` holds JSON text already and is shown under the name before that.
    """
    value = F.col(name)
    wrapped = F.to_json(F.struct(value.alias("v")))  # {"v":...}
    text = value if name.endswith("_json") else F.substr(wrapped, F.lit(6), F.length(wrapped) - 6)
    key = F.lit(json.dumps(name.removesuffix("_json")) + ":")
    return F.when(value.isNotNull(), F.concat(key, text)).otherwise(F.concat(key, F.lit("null")) if always else None)


def canonical_json(rows: DataFrame, always: tuple[str, ...] = ()) -> DataFrame:
    """``rows`` as compact JSON texts with sorted keys in column ``value``; null fields are left out unless in ``always``."""
    fields = [_field(c, c in always) for c in sorted(rows.columns)]
    return rows.select(F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}")).alias("value"))


def write_sorted(rows: DataFrame, order: list[str], folder: str, name: str, always: tuple[str, ...] = (), single: bool = True) -> int:
    """Write ``rows`` as sorted JSON Lines: one file ``name``, or a folder of range parts, in any file system that Spark knows.

    One file is put together from the range parts by the driver's JVM, which holds a block of it at a time. Columns whose names begin with an underscore order the rows and aren't written. Returns the number of rows. The order is total, so the bytes don't depend on how rows came in.
    """
    spark = rows.sparkSession
    shown = [c for c in rows.columns if not c.startswith("_")]
    lines = canonical_json(rows.orderBy(*order).select(*shown), always)
    target = files.join(folder, name)
    parts = target + ".parts" if single else target
    lines.write.mode("overwrite").text(parts)
    written = spark.read.text(parts).count()
    if single:
        files.append_parts(spark, parts, target)
        files.remove(spark, parts)
    return written


def table_digest(rows: DataFrame) -> DataFrame:
    """One row: count and order-free hash of a table, for comparing runs without files."""
    hashed = F.xxhash64(*rows.columns)
    return rows.agg(F.count("*").alias("rows"), F.sum(hashed.cast("decimal(38,0)")).cast("string").alias("digest"))


def publish(spark: SparkSession, staging: str, target: str, names: list[str]) -> None:
    """Move finished files into place, each at once."""
    files.make_folder(spark, target)
    for name in names:
        files.replace(spark, files.join(staging, name), files.join(target, name))


def write_json(spark: SparkSession, path: str, document: dict) -> None:
    files.write_text(spark, path, json.dumps(document, indent=2, sort_keys=True, ensure_ascii=False) + "\n")
