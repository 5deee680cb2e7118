"""Runs: tables that are written as a whole and verified when they are loaded, a lock on a run's folder, records of what became
of it, and stages that a later run takes up where an earlier one stopped."""

from __future__ import annotations

import json
import os
import socket
import time
import traceback
import uuid
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evispark.operators import checks

MANIFEST = "version int, name string, file string, bytes long, sha256 string, rows long"
VERSION = 1
#: Rows of a file at most, and of one with binary columns, so that a file's digest is taken in bounded memory.
FILE_ROWS, BINARY_ROWS = 100_000, 50


class RunLocked(RuntimeError):
    """Another run holds the folder."""


def place(spark: SparkSession, path: str):
    """(file system, path) of Hadoop, for any store that Spark reads."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = place(spark, path)
    return fs.exists(p)


def commit(tables: dict[str, DataFrame], target: str, kind: str = "parquet") -> None:
    """Write tables below a new folder, all or none: a staging folder, a manifest of its files, one rename.

    Files are written, counted and digested by tasks; the manifest has a row for each."""
    spark = next(iter(tables.values())).sparkSession
    fs, to = place(spark, target)
    if fs.exists(to):
        raise FileExistsError(target)
    stage = f"{target.rstrip('/')}.{uuid.uuid4().hex}.incomplete"
    for name, df in tables.items():
        most = BINARY_ROWS if any(t == "binary" for _, t in df.dtypes) else FILE_ROWS
        df.write.option("maxRecordsPerFile", most).format(kind).save(f"{stage}/{name}.{kind}")
    written = files(spark, stage).join(counted(spark, stage, list(tables), kind), ["name", "file"], "left")
    written.withColumn("rows", F.coalesce("rows", F.lit(0))).select(F.lit(VERSION).alias("version"), "name", "file", "bytes", "sha256", "rows").write.json(f"{stage}/manifest")
    fs.mkdirs(to.getParent())
    if not fs.rename(place(spark, stage)[1], to):
        raise OSError(f"cannot rename to {target}")


def files(spark: SparkSession, folder: str) -> DataFrame:
    """(name, file, bytes, sha256) of the data files below a folder, but for the manifest's own."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(folder)
    parts = F.split("path", "/")
    out = found.select(F.regexp_replace(F.element_at(parts, -2), r"\.[^.]*$", "").alias("name"), F.element_at(parts, -1).alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    return out.where("name <> 'manifest'")


def counted(spark: SparkSession, folder: str, names: list[str], kind: str) -> DataFrame:
    """(name, file, rows) of every file that has rows."""
    out = None
    for name in names:
        path = f"{folder}/{name}.{kind}"
        rows = spark.read.text(path) if kind == "json" else spark.read.format(kind).load(path)
        own = rows.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count("*").alias("rows")).select(F.lit(name).alias("name"), "file", "rows")
        out = own if out is None else out.union(own)
    return out


def reconciled(manifest: DataFrame, found: DataFrame, rows: DataFrame) -> DataFrame:
    """Violations of files (name, file, bytes, sha256) and their counts (name, file, rows) against a manifest of both.

    The three meet once, and each file's violations are made where they meet. A file has a row of counts at most."""
    key = ["name", "file"]
    told = manifest.select(*key, F.struct("bytes", "sha256").alias("told"), F.col("rows").alias("told_rows"))
    seen = found.select(*key, F.struct("bytes", "sha256").alias("seen")).join(rows.select(*key, "rows"), key, "left")
    count = F.coalesce("rows", F.lit(0))
    wrong = lambda code, when, detail=F.lit(None): F.when(when, F.struct(F.lit(code).alias("check_code"), detail.cast("string").alias("detail")))
    each = F.array(
        wrong("file-missing", F.col("seen").isNull()),
        wrong("file-unknown", F.col("told").isNull()),
        wrong("file-changed", F.expr("told.sha256 <> seen.sha256 or told.bytes <> seen.bytes"), F.col("seen.sha256")),
        wrong("row-count", F.col("told").isNotNull() & F.col("seen").isNotNull() & (F.col("told_rows") != count), count),
    )
    broken = told.join(seen, key, "full").select(F.concat_ws("/", *key).alias("key"), F.explode(F.array_compact(each)).alias("v"))
    return checks.union([checks.duplicates(manifest, key, "listed-twice"), broken.select("v.check_code", F.lit("error").alias("severity"), "key", "v.detail")])


def violations(spark: SparkSession, target: str, kind: str = "parquet") -> DataFrame:
    """What a committed folder has against its manifest; a folder without one is none that was committed."""
    if not exists(spark, f"{target}/manifest"):
        return checks.rows(spark.range(1), "no-manifest", F.lit(target))
    manifest = spark.read.schema(MANIFEST).json(f"{target}/manifest")
    found = files(spark, target)
    names = sorted({r.name for r in manifest.select("name").distinct().collect()} & {r.name for r in found.select("name").distinct().collect()})  # tables, not files
    rows = counted(spark, target, names, kind) if names else found.select("name", "file", F.lit(0).cast("long").alias("rows")).limit(0)
    other = checks.rows(manifest.where(~F.coalesce(F.col("version") == VERSION, F.lit(False))), "unknown-version", F.concat_ws("/", "name", "file"), F.col("version"))
    return reconciled(manifest, found, rows).unionByName(other)


def loaded(spark: SparkSession, target: str, kind: str = "parquet") -> dict[str, DataFrame]:
    """The tables of a committed folder, if every file is the one that was written."""
    try:
        found = violations(spark, target, kind)
        checks.fail_closed(found)
    except PySparkException as e:  # a changed file may no longer be one of its kind
        raise checks.CheckError(f"unreadable: {target}: {str(e)[:200]}") from e
    names = [r.name for r in spark.read.schema(MANIFEST).json(f"{target}/manifest").select("name").distinct().collect()]
    return {name: spark.read.format(kind).load(f"{target}/{name}.{kind}") for name in names}


class Run:
    """A run in a folder: `with Run(spark, folder) as run: tables = run.stage("parsed", make)`.

    The folder's lock is created exclusively; one whose process on this machine is gone is taken over, others are an error. Each
    begin and end is a record below state/. A stage whose tables are there and verified isn't made again."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.id, self.at = spark, folder.rstrip("/"), uuid.uuid4().hex, None

    def _write(self, path: str, value: dict, overwrite: bool = False) -> None:
        fs, p = place(self.spark, path)
        fs.mkdirs(p.getParent())
        out = fs.create(p, overwrite)
        try:
            out.write(bytearray(json.dumps(value, sort_keys=True).encode()))
        finally:
            out.close()

    def _read(self, path: str) -> dict:
        return json.loads("".join(r.value for r in self.spark.read.text(path).collect()) or "{}")

    def _lock(self) -> None:
        own = {"host": socket.gethostname(), "pid": os.getpid(), "run": self.id}
        path = f"{self.folder}/run.lock"
        for again in (True, False):
            try:
                return self._write(path, own)
            except Exception as e:  # noqa: BLE001  the file system's own error, through the gateway
                if not exists(self.spark, path):
                    raise
                holder = self._read(path)
                if not again or not self._gone(holder):
                    raise RunLocked(f"{self.folder} is held by {holder}") from e
                fs, p = place(self.spark, path)
                fs.delete(p, False)

    @staticmethod
    def _gone(holder: dict) -> bool:
        if holder.get("host") != socket.gethostname():
            return False
        try:
            os.kill(int(holder.get("pid", 0)), 0)  # signal 0 only asks whether the process is there
        except ProcessLookupError:
            return True
        except (PermissionError, OSError):
            return False
        return False

    def _record(self, status: str, **more) -> None:
        self._write(f"{self.folder}/state/{time.time_ns():020d}-{status}.json", {"run": self.id, "status": status, "stage": self.at, **more})

    def __enter__(self) -> Run:
        self._lock()
        self._record("running")
        return self

    def __exit__(self, kind, error, trace) -> None:
        if error is None:
            self._record("success")
        else:
            self._record("failed", error=kind.__name__, detail="".join(traceback.format_exception_only(kind, error))[:500])
        fs, p = place(self.spark, f"{self.folder}/run.lock")
        fs.delete(p, False)

    def stage(self, name: str, make: Callable[[], dict[str, DataFrame]]) -> dict[str, DataFrame]:
        """The stage's tables: those of an earlier run, or made and committed now."""
        self.at = name
        target = f"{self.folder}/{name}"
        if not exists(self.spark, target):
            commit(make(), target)
        return loaded(self.spark, target)


def states(spark: SparkSession, folder: str) -> DataFrame:
    """(run, status, stage, error, detail, at) of all runs in a folder, in the order of `at`."""
    rows = spark.read.schema("run string, status string, stage string, error string, detail string").json(f"{folder}/state")
    return rows.withColumn("at", F.regexp_extract(F.col("_metadata.file_name"), r"^(\d+)", 1))
