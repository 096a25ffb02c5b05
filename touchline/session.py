"""Session settings and the shared scratch location."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


# Bytes of a batch that goes to Python: a worker holds a few of them, decoded, whatever the length of the texts.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
SETTINGS[BATCH_BYTES] = str(8 << 20)

# Spark's setting to remove an execution's shuffle files at its end.
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_written: list[str] = []


def build_session(name: str = "touchline", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the operators expect; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = SETTINGS | {k.replace("__", "."): v for k, v in extra.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, or where that is unset a folder in the warehouse,
    which all executors share as well."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return configured or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/touchline-scratch"


def bound_batches(spark: SparkSession) -> None:
    """Batches of bounded bytes also in a session that was not built here; a smaller bound stays."""
    now = spark.conf.get(BATCH_BYTES, None)
    size = int(now.rstrip("b")) if now and now.rstrip("b").lstrip("-").isdigit() else -1
    if not 0 < size <= int(SETTINGS[BATCH_BYTES]):
        spark.conf.set(BATCH_BYTES, SETTINGS[BATCH_BYTES])


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, remembered for ``discard_scratch``."""
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage by writing to the shared folder and reading back; survives the loss of executors.

    The write's shuffle files go when it ends: its table stands for them, and steps in a row would pile them up.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    before = spark.conf.get(CLEAN_SHUFFLES, None)
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEAN_SHUFFLES)
        else:
            spark.conf.set(CLEAN_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def discard_step(step: DataFrame) -> None:
    """Delete the table of a ``materialize``, once all that reads it is written."""
    spark = step.sparkSession
    written = {path for path in _written for file in step.inputFiles() if f"/{path.rsplit('/', 1)[-1]}/" in file}
    for path in written:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        _written.remove(path)


def discard_scratch(spark: SparkSession) -> int:
    """Delete what ``materialize`` has written so far, once the results that read it are stored; returns the count."""
    removed = 0
    while _written:
        target = spark._jvm.org.apache.hadoop.fs.Path(_written.pop())
        removed += target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    return removed
