"""A session with the settings that the engine is written for."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "evispark", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",  # files of checkpoints go when no plan holds them
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    return builder.config(map=settings).getOrCreate()


#: Bytes of an Arrow batch to a Python worker. Spark's default batch holds 10,000 rows of any length.
ARROW_BYTES = 2 << 20


def tune(spark: SparkSession | None) -> None:
    """Bound what a Python worker holds at a time by bytes; a value that the user chose stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark is not None and spark.conf.get(key, None) is None:
        spark.conf.set(key, str(ARROW_BYTES))


#: Rows of a shuffle that a task sorts or hashes, about. Adaptive execution goes by compressed bytes, which ids make few of: it
#: would put millions of rows into a task again.
TASK_ROWS = 500_000


def tasks(df: DataFrame) -> int | None:
    """Among how many tasks to deal df's rows: TASK_ROWS for each at most, and no fewer than Spark's setting; None where one
    task's rows are all there are. df is counted."""
    n = -(-df.count() // TASK_ROWS)
    return max(n, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))) if n > 1 else None


def dealt(df: DataFrame, n: int | None, *by: str) -> DataFrame:
    """df by the hash of columns in n tasks, so that a task's memory doesn't grow with df; with None as it is. Spark does not
    split a hot key of such a shuffle: for keys that many rows share leave it None."""
    return df if n is None else df.repartition(n, *by)


def cut(df: DataFrame) -> DataFrame:
    """df as a checkpoint: computed once, its lineage ends there. The files lie in spark.checkpoint.dir, which executors
    share, so they outlive lost executors; where it is unset (as in tests) below the warehouse."""
    spark = df.sparkSession
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(shared_folder(spark) + "/_checkpoints")
    return df.checkpoint()


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset the warehouse, but only if driver and executors are one machine."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return named or spark.conf.get("spark.sql.warehouse.dir")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that executors share; what lies there goes when the session ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(place)
    fs.deleteOnExit(place)
    return path
