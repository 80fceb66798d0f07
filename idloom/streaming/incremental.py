"""Resolution of a growing package with Structured Streaming.

Ids are hashes of contents, so an entity's key alone names it and batches can come in any order or twice. The state is
a table of one row for each occurrence, keyed by its id; every micro-batch appends the occurrences that are new, and
entities are a grouping over that table. Nothing is kept in memory between batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from idloom.operators.resolve import Resolution, resolve
from idloom.policy import Policy
from idloom.sources.jsonl import SCHEMAS
from idloom.sources.tables import scoped

OCCURRENCES = SCHEMAS["candidate_entities.jsonl"]


def occurrence_stream(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """Occurrences from JSON Lines files as they arrive in a folder."""
    return spark.readStream.schema(OCCURRENCES).option("maxFilesPerTrigger", files_per_trigger).json(folder)


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.exists(place) and any(True for _ in system.listStatus(place))


def upsert(state: str) -> Callable[[DataFrame, int], None]:
    """A sink for ``foreachBatch``: appends the batch's occurrences whose ids the state table doesn't have yet.

    A batch that is run again, after a failure, appends nothing twice.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        once = batch.where("candidate_entity_id is not null").dropDuplicates(["candidate_entity_id"])
        if _exists(spark, state):
            known = spark.read.schema(once.schema).parquet(state).select("candidate_entity_id")
            once = once.join(known, "candidate_entity_id", "left_anti")
        once.write.mode("append").parquet(state)

    return write


def start(stream: DataFrame, state: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Keep the state table up to date; ``once`` takes what is there and ends."""
    writer = stream.writeStream.foreachBatch(upsert(state)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def current(spark: SparkSession, state: str, ledger: DataFrame, policy: Policy = Policy()) -> Resolution:
    """The resolution of everything that has arrived."""
    rows = spark.read.parquet(state)
    filled = rows.withColumn("aliases", F.coalesce("aliases", F.array().cast("array<string>"))).withColumn("confidence", F.coalesce("confidence", F.lit(0.0)))
    return resolve(scoped(filled, ledger), policy)


def mention_counts(stream: DataFrame, event_time: str = "observed_at", window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """How often each type is seen in windows of event time; rows later than ``late`` are left out."""
    timed = stream.withWatermark(event_time, late)
    return timed.groupBy(F.window(event_time, window), "type").agg(F.count("*").alias("occurrences"), F.approx_count_distinct("normalized_name").alias("names"))
