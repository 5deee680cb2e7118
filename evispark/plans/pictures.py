"""Pictures of decks: which of them a reader sees, one answer for each digest and task, and the blocks read as child elements.

Answers are a table of their own, which outlives a run. Equal pictures, in whatever decks, are one row of it; a picture that
has an answer is never asked for again, also not by a later run after a failure. Questions go out in waves, each of which is
committed as a whole, so what a run that dies repeats is one wave at most.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evispark import config
from evispark.functions import columns as C
from evispark.functions.udfs import call
from evispark.operators import blocks, checks, readers
from evispark.plans import models

CONTEXT = "One picture of a slide. Keep tables that stand apart as blocks of their own."
#: Pictures that are asked for between two commits.
WAVE = 100_000
ANSWERS = "sha256 string, task string, payload string, width int, height int, error_kind string, error string, run long"

# Names of readers in a configuration.
READERS = ("none", "openai_vlm", "command")


def reader_of(settings: dict) -> Callable[[], readers.ReaderBackend] | None:
    """Makes the configured reader, in each task; none where pictures aren't to be read."""
    own, api = settings["ocr"], settings["vlm_api"]
    kind = str(own["backend"]).strip().lower().replace("-", "_")
    if kind not in READERS:
        raise config.ConfigError(f"unknown reader {own['backend']!r}; known are {', '.join(READERS)}")
    if kind == "none" or own["policy"] == "never":
        return None
    if kind == "command":
        if not own["argv"]:
            raise config.ConfigError("ocr.argv is the program that reads a picture")
        return lambda: models.CommandReader(tuple(own["argv"]), own["timeout_seconds"])
    if not api["base_url"] or not api["model"]:
        raise config.ConfigError("openai_vlm needs vlm_api.base_url and vlm_api.model")
    key = config.secret(api)
    return lambda: readers.ImageReader(api["base_url"], api["model"], api["timeout_seconds"], api["max_tokens"], key=key)


def targets(elements: DataFrame, policy: str = "auto") -> DataFrame:
    """(source_id, element_id, sha256, task) of elements with bytes that a reader should see."""
    return blocks.visual_targets(elements.where("media_sha256 is not null"), policy).select("source_id", "element_id", F.col("media_sha256").alias("sha256"), "task")


def stored(spark: SparkSession, store: str) -> DataFrame:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(store)
    there = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)
    return spark.read.schema(ANSWERS).parquet(store) if there else spark.createDataFrame([], ANSWERS)


def answered(asked: DataFrame, media: DataFrame, reader: Callable[[], readers.ReaderBackend], store: str, wave: int = WAVE) -> tuple[DataFrame, DataFrame]:
    """(answers, failures): answers (columns as ANSWERS) of all asked (sha256, task), from the table at `store`, to which new ones
    are added; failures (check_code, key, detail) of those that still have none.

    media: (sha256, content), one row for each digest. Equal pictures are asked for once; a null digest is never asked for.
    """
    spark = asked.sparkSession
    wanted = asked.select("sha256", "task").where("sha256 is not null").distinct()
    run = time.time_ns()
    left = wanted.join(stored(spark, store).where("payload is not null").select("sha256", "task"), ["sha256", "task"], "left_anti")
    waves = -(-left.count() // wave)
    for n in range(waves):
        own = left.where(F.pmod(F.xxhash64("sha256", "task"), F.lit(waves)) == n)
        rows = own.join(media, "sha256").select(F.concat_ws("#", "sha256", "task").alias("element_id"), F.col("content").alias("image"), "task", F.lit(CONTEXT).alias("context"))
        rows = rows.repartition("element_id")
        sizes = call("image_size", "image")
        found = models.read_elements(rows.withColumn("size", sizes), reader, carry={"size": "array<int>"})
        split = F.split("element_id", "#")
        found.select(split[0].alias("sha256"), split[1].alias("task"), "payload", F.col("size")[0].alias("width"), F.col("size")[1].alias("height"), "error_kind", "error", F.lit(run).alias("run")).write.mode("append").parquet(store)
    every = stored(spark, store)
    best = every.where("payload is not null").groupBy("sha256", "task").agg(F.min_by(F.struct("payload", "width", "height", "error_kind", "error", "run"), "run").alias("a")).select("sha256", "task", "a.*")
    answers = best.join(wanted, ["sha256", "task"], "left_semi")
    last = every.where("payload is null").groupBy("sha256", "task").agg(F.max_by(F.concat_ws(": ", "error_kind", "error"), "run").alias("why"))
    open_ = wanted.join(answers.select("sha256", "task"), ["sha256", "task"], "left_anti").join(last, ["sha256", "task"], "left")
    return answers, checks.rows(open_, "picture-unread", F.concat_ws("#", "sha256", "task"), F.coalesce("why", F.lit("no bytes")))


def children(elements: DataFrame, asked: DataFrame, answers: DataFrame, source: str = "vlm") -> DataFrame:
    """Elements read from pictures: the parent's columns with id, kind, contents, place and order of their own.

    elements: with x, y, width, height, z_index and crop; asked: targets(). A block's box is in pixels of the whole picture; it
    is moved by what the crop cuts off and scaled to the shape. Where box or size is unknown the parent's place stands.
    """
    found = readers.read_payloads(answers.select("sha256", "task", "width", "height", "payload"))
    own = ["x", "y", "width", "height", "z_index", "crop"]
    parents = elements.select("source_id", "element_id", "slide_number", "name", "hidden", *(F.col(c).alias(f"p_{c}") for c in own))
    both = asked.join(found, ["sha256", "task"]).join(parents, ["source_id", "element_id"])
    edge = lambda i: F.coalesce(F.get("p_crop", F.lit(i)), F.lit(0.0))
    seen_w, seen_h = F.col("width") * (1 - edge(0) - edge(2)), F.col("height") * (1 - edge(1) - edge(3))
    moved: list[Column] = [F.col("bbox")[i] - edge(i % 2) * F.col(("width", "height")[i % 2]) for i in range(4)]
    ratio = lambda a, b: F.when(b > 0, a.cast("double") / b).otherwise(0.0)
    place = C.box_on_slide([F.col(f"p_{c}") for c in ("x", "y", "width", "height")], moved, F.lit(0.0), seen_w, seen_h, ratio(F.col("p_width"), seen_w), ratio(F.col("p_height"), seen_h))
    token = F.regexp_replace(F.regexp_replace(F.lower("kind"), r"[^\p{L}\p{N}]", "_"), "^_+|_+$", "")
    number = (F.col("ord") + 1).cast("int")
    return both.withColumn("_place", place).select(
        "source_id", "slide_number",
        F.concat("element_id", F.lit("-ocr"), F.lpad(number.cast("string"), F.greatest(F.lit(3), F.length(number.cast("string"))), F.lit("0"))).alias("element_id"),
        F.concat(F.lit("ocr_"), F.when(token == "", "block").otherwise(token)).alias("kind"),
        F.concat(F.coalesce("name", "element_id"), F.lit(" / block "), number.cast("string")).alias("name"),
        *(F.col("_place")[i].cast("long").alias(c) for i, c in enumerate(("x", "y", "width", "height"))),
        (F.col("p_z_index") + number).cast("int").alias("z_index"), F.col("element_id").alias("parent_id"), "hidden",
        F.nullif(F.col("text"), F.lit("")).alias("text"), F.nullif(F.col("markdown"), F.lit("")).alias("markdown"), F.nullif(F.col("html"), F.lit("")).alias("html"),
        "confidence", F.lit(source).alias("source"),
    )
