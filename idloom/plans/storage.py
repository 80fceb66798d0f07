"""Lineage cuts in the folder that the whole cluster shares."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where it is unset and all runs on one machine a temporary one is set."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current is None:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="idloom-"))
        current = context.getCheckpointDir()
    return current.rstrip("/")


def drop_table(spark: SparkSession, path: str) -> None:
    """Delete a table that :func:`materialize` wrote."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _drop_at_exit(spark: SparkSession, path: str) -> None:
    try:
        drop_table(spark, path)
    except Exception:  # the session is gone already; the folder belongs to the cluster's housekeeping then
        pass


def materialize(df: DataFrame, name: str, keep: bool = True) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet into the shared folder and read it back, which cuts the lineage.

    The files survive the loss of any executor. They go when the driver exits, or by :func:`drop_table`.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/idloom-{name}-{uuid.uuid4().hex}"
    if keep:
        atexit.register(_drop_at_exit, spark, path)
    try:
        df.write.option("compression", "zstd").parquet(path)
    except Exception:
        _drop_at_exit(spark, path)
        raise
    return spark.read.schema(df.schema).parquet(path), path
