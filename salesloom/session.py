"""Session defaults and staged tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # call-site capture costs several JVM calls per column expression
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # staged Parquet files unpack to several times their size
    "spark.sql.sources.fileCompressionFactor": "4.0",
    # upper size of a join side that Spark may broadcast; it compares file or shuffle sizes
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``.

    Where it is unset a temporary folder serves, but in local mode only: on a cluster other
    machines could not read it.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="salesloom-"))
    return context.getCheckpointDir()


def _run_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/staged/{spark.sparkContext.applicationId}"


def staged_path(spark: SparkSession, name: str) -> str:
    """A new folder below this application's part of the shared folder."""
    return f"{_run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def drop_staged(spark: SparkSession) -> None:
    """Delete this application's staged tables; tables read from them are unusable afterwards."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_run_folder(spark))
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.delete(path, True)


#: Bytes of a method up to which the JVM compiles it; longer ones are interpreted for good.
COMPILED_BYTES = 8000


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """Code of steps with many columns in methods that the JVM compiles, where one for all would be too long."""
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), COMPILED_BYTES)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def stage(df: DataFrame, name: str, partition_by: str | None = None, wide: bool = False) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage in a place that outlives executors, lets later passes prune columns, and gives
    the planner the true size, so small tables are broadcast and large ones are not. ``wide`` is for steps that
    compute many columns.
    """
    spark = df.sparkSession
    path = staged_path(spark, name)
    if partition_by:
        # splits a hot value over several tasks and packs the small ones together
        df = df.hint("rebalance", partition_by)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    with compiled_methods(spark) if wide else nullcontext():
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
