"""Helpers that every operator of this subpackage uses: session settings, written tables that cut lineage, safe column names."""

from __future__ import annotations

import contextlib
import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from evispark.session import shared_folder

#: Rows of an Arrow batch; texts may be long, so a batch stays small in memory.
ARROW_ROWS = 1000


def tune(spark: SparkSession) -> None:
    """Lower Spark's default Arrow batch (10,000 rows) for text columns; a value that the user chose stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(ARROW_ROWS))


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or where it is unset, on one machine alone, one below the
    warehouse."""
    sc = spark.sparkContext._jsc.sc()
    if sc.getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(shared_folder(spark) + "/_checkpoints")
    return sc.getCheckpointDir().get()


#: Shuffle files of a finished write go at once, not when the driver next collects garbage: the written table replaces them.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting while the block runs."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back: the lineage ends there and outlives lost executors.

    The files are deleted by discard(), or else when the session ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tables/{name}-{uuid.uuid4().hex}"
    with setting(spark, CLEANUP, "true"):
        df.write.option("compression", "zstd").parquet(path)
    files, p = _files(spark, path)
    files.deleteOnExit(p)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def _files(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def discard(*tables: DataFrame) -> None:
    """Delete written() tables. Only for tables whose every reader has itself been written: later reads fail."""
    for t in tables:
        files, p = _files(t.sparkSession, t.scratch_path)
        files.delete(p, True)


def tidy(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """work, after which the Python worker, which lives on, gives freed memory back to the system."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        give_back()

    return run


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def row_key(id_col: str, text_col: str) -> Column:
    """64-bit key of a row by id and text; rows that repeat both share it, and nulls in either are values of their own."""
    return F.xxhash64(F.col(f"`{id_col}`").isNull(), F.col(f"`{id_col}`"), F.col(f"`{text_col}`").isNull(), F.col(f"`{text_col}`"))


def wide_key(id_col: str, text_col: str) -> Column:
    """128-bit key of a row by id and text; rows that repeat both share it, and nulls in either are values of their own."""
    own = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("-"))
    return F.unhex(F.md5(F.concat(F.octet_length(own).cast("string"), F.lit(":"), own, F.when(F.col(f"`{text_col}`").isNull(), "-").otherwise("+"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")))))


def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add _part, the partition, and _rank, the place in it."""
    from pyspark import TaskContext

    part, seen = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(seen + np.arange(n))], names=[*batch.schema.names, "_part", "_rank"])
        seen += n


def ranked(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Add _rank (0, 1, 2, ...) in this order over all rows, by ranges: no task sorts more than its range. Rows that are equal
    in the whole order must be interchangeable; they spread over ranges by their place in df, which is to be a written table.

    What reaches the driver, and is broadcast, is a count for each partition.
    """
    keys = [*order, F.col("_place")]
    ranged = df.withColumn("_place", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_place")
    ranged = written(ranged.mapInArrow(numbered, ddl(ranged.schema) + ", _part int, _rank long"), name)
    before, offsets = 0, []
    for part, n in sorted(map(tuple, ranged.groupBy("_part").count().collect())):
        offsets.append((part, before))
        before += n
    small = df.sparkSession.createDataFrame(offsets, "_part int, _before long")
    return ranged.join(F.broadcast(small), "_part").withColumn("_rank", F.col("_rank") + F.col("_before")).drop("_part", "_before")
