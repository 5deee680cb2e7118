"""Semantic documents: one for each source, with the request numbers and citations that stand behind it, and the checks that hold
a stored set of them against blocks, decisions and ledger before anything is published from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evispark.functions import columns as C
from evispark.functions import patterns
from evispark.operators import artifacts, checks, decisions
from evispark.plans import collection, integration, publish, stages


def documents(c: collection.Collection, dossiers: DataFrame | None = None) -> DataFrame:
    """(document_id, source_id, title, body, content_sha256): a source's dossier, or its kept blocks where no model wrote one,
    behind the list of its request numbers."""
    kept = stages.kept_blocks(c.blocks, c.semantic.decisions)
    titles = c.sources.select("source_id", C.file_stem(F.element_at("paths", 1)).alias("title"))
    text = dossiers if dossiers is not None else kept.groupBy("source_id").agg(publish.lines(F.col("content"), F.col("rank"), "").alias("body"))
    own = kept.select("source_id").distinct().join(titles, "source_id").join(text.select("source_id", F.col("body").alias("text")), "source_id", "left").join(c.semantic.inventory, "source_id", "left")
    requests = F.when(F.size("values") > 0, F.concat(F.lit("## Requests\n\n"), F.array_join(F.transform("values", lambda v: F.concat(F.lit("- "), v)), "\n")))
    out = own.withColumn("body", F.concat_ws("\n\n", requests, F.nullif("text", F.lit(""))))
    return out.select(F.col("source_id").alias("document_id"), "source_id", "title", "body", C.sha256(F.col("body")).alias("content_sha256"))


def rests_on(c: collection.Collection) -> DataFrame:
    """(source_id, citation, place): what a source's document rests on, its kept blocks in order. Rows, however large a source is."""
    return stages.kept_blocks(c.blocks, c.semantic.decisions).select("source_id", "citation", F.col("rank").alias("place"))


def numbers_of(c: collection.Collection) -> DataFrame:
    """(source_id, value): a source's request numbers, a spelling for each."""
    return c.semantic.inventory.select("source_id", F.explode("values").alias("value"))


def tables(c: collection.Collection, dossiers: DataFrame | None = None) -> dict[str, DataFrame]:
    return {"documents": documents(c, dossiers), "document_citations": rests_on(c), "document_requests": numbers_of(c)}


def violations(kept: dict[str, DataFrame], c: collection.Collection) -> DataFrame:
    """What a stored set of documents breaks: identities, digests, request numbers that a body lost, citations other than the
    kept blocks, decisions that don't cover the blocks, a ledger that the blocks don't give, slides without a block."""
    docs, cited, numbers = kept["documents"], kept["document_citations"], kept["document_requests"]
    name, known = F.col("document_id"), c.sources.select("source_id")
    whole = stages.kept_blocks(c.blocks, c.semantic.decisions)
    lost = numbers.join(docs, "source_id").where(~F.contains("body", "value"))
    ledger = c.semantic.ledger
    again = decisions.request_ledger(c.blocks).select(*ledger.columns)
    listed = cited.select(F.col("source_id").alias("document_id"), "source_id", F.array("citation").alias("citations"))
    slides = c.blocks.select("source_id", "slide_number").distinct()
    key = ["source_id", "citation"]
    return checks.union([
        checks.duplicates(docs, ["document_id"], "duplicate-document"),
        checks.bad_values(docs, "unsafe-id", name, ~name.rlike(patterns.SAFE_ID)),
        checks.bad_values(docs, "document-identity", name, name != F.col("source_id")),
        checks.missing(docs, known, ["source_id"], "unknown-source"),
        checks.missing(whole.select("source_id").distinct(), docs, ["source_id"], "no-document"),
        checks.bad_values(docs, "document-digest", name, ~F.coalesce(C.sha256(F.col("body")) == F.col("content_sha256"), F.lit(False))),
        checks.rows(lost, "request-lost", name, F.col("value")),
        checks.missing(numbers, numbers_of(c), ["source_id", "value"], "request-unknown"),
        checks.missing(numbers_of(c), numbers, ["source_id", "value"], "request-missing"),
        checks.duplicates(cited, key, "cited-twice"),
        checks.missing(cited, whole, key, "citation-not-kept"),
        checks.missing(whole, cited, key, "kept-not-cited"),
        checks.rows(cited.join(whole.select(*key, "rank"), key).where("place <> rank"), "citation-order", F.concat_ws("/", *key)),
        artifacts.documents(listed, c.blocks, slides),
        artifacts.decisions(c.semantic.decisions, c.blocks, ledger),
        checks.changed_rows(ledger, again, "citation"),
    ])


def evidence_violations(c: collection.Collection, pages: DataFrame) -> DataFrame:
    """Rendered evidence against the blocks: anchors that a page lacks, contents that are others, pictures whose file is another."""
    place = F.format_string("evidence/%s-%04d.md", "source_id", "slide_number")
    shown = c.blocks.where("asset_path is null").select("citation", place.alias("path"), F.col("element_id").alias("anchor"), "content_sha256")
    files = publish.asset_files(c.assets)[0].select("path", F.sha2("content", 256).alias("sha256"))
    pictured = c.blocks.withColumn("asset_sha256", F.regexp_extract("asset_path", r"([0-9a-f]{64})(?:\.[^/]*)?$", 1))
    return artifacts.evidence(shown, pages).unionByName(artifacts.assets(pictured, files))


def lineage(found: integration.Integrated, c: collection.Collection) -> DataFrame:
    """The stored source map against what the kept blocks and the ledger give."""
    return artifacts.lineage(found.facts, stages.kept_blocks(c.blocks, c.semantic.decisions), c.semantic.ledger)
