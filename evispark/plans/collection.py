"""A collection from files to a site: read decks, make blocks, decide, export, publish; state markers around it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evispark.functions import columns as C
from evispark.functions.udfs import call
from evispark.operators import artifacts, blocks, checks, decisions, readers, topics
from evispark.plans import pictures, publish, runs, stages
from evispark.session import cut, scratch
from evispark.sources import files, ooxml


@dataclass(frozen=True)
class Collection:
    """violations stop a site; warnings and qa, what checks of the elements found (both check_code, severity, key, detail), don't.
    assets: (source_id, path, content, sha256)."""

    occurrences: DataFrame
    sources: DataFrame
    blocks: DataFrame
    semantic: stages.Semantic
    violations: DataFrame
    assets: DataFrame
    warnings: DataFrame
    qa: DataFrame


@dataclass(frozen=True)
class Reading:
    """How decks are read: with pictures or without, strictly or with an error row for what can't be read, and by which reader
    of pictures, whose answers lie at `store`."""

    images: bool = False
    strict: bool = False
    policy: str = "auto"
    reader: Callable[[], readers.ReaderBackend] | None = None
    store: str | None = None


def read(spark: SparkSession, path: str, reading: Reading = Reading()) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(occurrences, sources, elements, media) of the decks below a path; equal files are one source with many occurrences."""
    found = files.discover(spark, path)
    listed = cut(found.drop("content"))  # digested once; contents are read again where they are needed
    checks.fail_closed(files.limits(listed).unionByName(files.archive_violations(found)))
    sources = cut(decisions.occurrences(listed).join(decisions.source_ids(listed), "sha256"))
    first = sources.select("source_id", F.element_at("paths", 1).alias("path"))
    one = found.join(first, "path", "left_semi")
    elements = ooxml.deck_elements(one, reading.images, reading.strict).join(first, "path")
    media = cut(ooxml.deck_media(one)) if reading.images else ooxml.deck_media(one.limit(0))
    return listed, sources, elements, media.join(first, "path")


def asset_path(source: Column, digest: Column, part: Column) -> Column:
    """Where a picture lies in a site: under its source and digest."""
    suffix = F.regexp_extract(F.lower(part), r"(\.[a-z0-9]{1,10})$", 1)
    return F.concat_ws("/", F.lit("assets"), source, F.concat(digest, F.when(suffix == "", ".bin").otherwise(suffix)))


def to_blocks(elements: DataFrame, include_empty: bool = False) -> DataFrame:
    """Provenance blocks of elements: order, ids, contents, citations; empty ones go after they have their numbers.

    A picture with bytes is a block that shows its file; what was read from it are further blocks (columns markdown, html)."""
    for c in ("markdown", "html", "media_part", "media_sha256"):
        elements = elements if c in elements.columns else elements.withColumn(c, F.lit(None).cast("string"))
    kept = blocks.keep_elements(elements.where("kind <> 'error'"), include_empty).withColumn("explicit_order", F.lit(None).cast("int")).withColumn("input_index", F.col("z_index"))
    ordered = blocks.reading_order(kept, ["source_id", "slide_number"])
    rendered = ordered.withColumn("table_text", F.when(F.col("table_json").isNotNull(), call("table_markup", "table_json")))
    asset = F.when(F.col("media_sha256").isNotNull(), asset_path(F.col("source_id"), F.col("media_sha256"), F.col("media_part")))
    words = F.regexp_replace(F.coalesce("name", F.lit("")), r"[\[\]\\\s]+", " ")
    body = C.content_of(F.col("table_text"), F.col("markdown"), F.col("html"), F.col("text"), F.concat(F.lit("../"), asset), words)
    named = rendered.withColumn("c", body).withColumn("asset_path", asset).withColumn("element_id", blocks.safe_element_id(F.col("element_id")))
    out = named.select("source_id", "slide_number", F.lit("").alias("slide_title"), C.citation(F.col("slide_number"), F.col("element_id")).alias("citation"), "element_id", "kind", "c.format", call("normalise_text", F.col("c.content")).alias("content"), (F.col("slide_number") * 1_000_000 + F.col("reading_order")).cast("long").alias("rank"), "asset_path")
    return blocks.without_empty(out).withColumnRenamed("format", "content_format").withColumn("content_sha256", C.sha256(F.col("content")))


def with_pictures(elements: DataFrame, media: DataFrame, reading: Reading) -> tuple[DataFrame, DataFrame]:
    """Elements and those read from their pictures, and failures of reading."""
    asked = pictures.targets(elements, reading.policy)
    # one place for each digest names it, so that bytes meet no aggregate
    one = media.groupBy("sha256").agg(F.min(F.struct("path", "part")).alias("one")).select("one.*")
    answers, failed = pictures.answered(asked, media.join(one, ["path", "part"]).select("sha256", "content"), reading.reader, reading.store or scratch(elements.sparkSession, "answers") + "/table")
    return elements.unionByName(pictures.children(elements, asked, answers), allowMissingColumns=True), failed


_CELLS = "struct<rows:int,columns:int,cells:array<struct<row:int,column:int,row_span:int,column_span:int,is_merge_origin:boolean>>>"


def quality(elements: DataFrame) -> DataFrame:
    """What is wrong with elements, slide by slide: repeated ids, boxes outside their slide, numbers read from a picture against
    native ones in the same place, tables read from pictures, cells outside their grid."""
    for c in ("source", "parent_id"):
        elements = elements if c in elements.columns else elements.withColumn(c, F.lit(None).cast("string"))
    slide = F.concat_ws("/", "source_id", F.col("slide_number").cast("string"))
    own = cut(elements.where("kind <> 'error'").withColumns({"slide_number": slide, "source": F.coalesce("source", F.lit("native")), "kind": F.regexp_replace("kind", "^ocr_", "")}))
    grids = own.where("table_json is not null").select(F.concat_ws("/", "slide_number", "element_id").alias("table_id"), F.from_json("table_json", _CELLS).alias("t")).select("table_id", "t.*")
    return checks.union([checks.slide_checks(own, F.col("slide_width"), F.col("slide_height")), checks.raster_tables(own), checks.table_checks(grids)])


def qa_summary(found: DataFrame) -> DataFrame:
    """(severity, check_code, n) of findings."""
    return found.groupBy("severity", "check_code").agg(F.count("*").alias("n"))


def collect(spark: SparkSession, path: str, selected: DataFrame | None = None, complete: bool = False, reading: Reading = Reading()) -> Collection:
    """Everything but the site. Without a selection all of a source's blocks are selected."""
    occurrences, sources, elements, media = read(spark, path, reading)
    elements = cut(elements)
    checks.fail_closed(files.changed(spark, path, occurrences))
    broken_parts = checks.rows(elements.where("error is not null"), "unread-shape", F.concat_ws("/", "source_id", "element_id"), F.col("error"))
    whole, failed = with_pictures(elements, media, reading) if reading.images and reading.reader and blocks.any_visual(elements) else (elements, broken_parts.limit(0))
    b = cut(to_blocks(whole))
    chosen = b.select("source_id", "citation").limit(0) if selected is None else selected
    decided = stages.organise(b, chosen, complete)
    ledger = cut(decided.ledger)  # these are read by every later step
    semantic = stages.Semantic(ledger, decisions.inventory(ledger), decided.duplicates, cut(decided.decisions))
    qa = cut(quality(whole))
    broken = checks.union([artifacts.provenance(b), artifacts.decisions(semantic.decisions, b, semantic.ledger), qa if reading.strict else qa.limit(0)])
    shown = elements.where("media_sha256 is not null").select("source_id", F.col("media_part").alias("part"), "media_sha256").distinct()
    assets = shown.join(media.select("source_id", "part", "content"), ["source_id", "part"]).select("source_id", F.col("part").alias("path"), "content", F.col("media_sha256").alias("sha256"))
    return Collection(occurrences, sources, b, semantic, broken, assets, broken_parts.unionByName(failed), qa)


def evidence_pages(b: DataFrame) -> DataFrame:
    """(path, body) of every slide's blocks. A picture is a link to its file; a block's citation is a link to its place here."""
    shown = b.withColumn("content", F.when(F.col("asset_path").isNotNull(), F.regexp_replace("content", r"\A!\[", "[")).otherwise(F.col("content")))
    cited = call("evidence_links", C.qualified(F.col("source_id"), F.col("citation")))
    return blocks.slide_pages(shown, cited).select(F.format_string("evidence/%s-%04d.md", "source_id", "slide_number").alias("path"), F.col("page").alias("body"))


def site(c: Collection) -> DataFrame:
    """(path, body): evidence pages, a dossier for each source, and an index."""
    evidence = evidence_pages(c.blocks)
    names = c.sources.select("source_id", C.file_stem(F.element_at("paths", 1)).alias("title"))
    kept = stages.kept_blocks(c.blocks, c.semantic.decisions)
    body = kept.groupBy("source_id").agg(publish.lines(F.col("content"), F.col("rank"), "").alias("body"))
    dossiers = publish.dossiers(names.join(body, "source_id"), c.semantic.inventory, kept.select("source_id", C.qualified(F.col("source_id"), F.col("citation")).alias("citation"), "rank"))
    linked = dossiers.select("path", call("evidence_links", "body").alias("body"))
    index = publish.index_pages("Sources", {"Sources": names.select(F.col("source_id").alias("id"), "title")})
    return evidence.union(linked).union(index)


def tables(c: Collection) -> dict[str, DataFrame]:
    """What a run keeps of a collection; restored() takes it up again."""
    return {"occurrences": c.occurrences, "sources": c.sources, "provenance": c.blocks, "ledger": c.semantic.ledger, "duplicates": c.semantic.duplicates, "decisions": c.semantic.decisions, "assets": c.assets, "warnings": c.warnings, "qa": c.qa, "qa_summary": qa_summary(c.qa)}


def restored(kept: dict[str, DataFrame]) -> Collection:
    ledger = kept["ledger"]
    semantic = stages.Semantic(ledger, decisions.inventory(ledger), kept["duplicates"], kept["decisions"])
    broken = checks.union([artifacts.provenance(kept["provenance"]), artifacts.decisions(kept["decisions"], kept["provenance"], ledger)])
    return Collection(kept["occurrences"], kept["sources"], kept["provenance"], semantic, broken, kept["assets"], kept["warnings"], kept["qa"])


def export(c: Collection, target: str) -> None:
    """The tables as JSON lines below a new folder, with a manifest of every file's digest and count: all or none."""
    checks.fail_closed(c.violations)
    runs.commit({name: df for name, df in tables(c).items() if name != "assets"}, target, "json")


def is_complete(spark: SparkSession, target: str) -> bool:
    """Was the folder committed, and is every file the one that was written?"""
    return runs.exists(spark, target) and runs.violations(spark, target, "json").isEmpty()


def topic_tables(c: Collection, most: int = 64) -> DataFrame:
    """Slide topics of kept blocks, merged by title and held under the limit."""
    kept = stages.kept_blocks(c.blocks, c.semantic.decisions)
    merged = topics.slide_topics(kept).select("source_id", call("topic_key", "title").alias("key"), "title", "citations", F.col("slide_number").cast("long").alias("first"))
    return stages.covered_topics(kept, merged, most)
