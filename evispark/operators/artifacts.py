"""Invariants of written artifacts as violation queries: ledgers, source maps, entities, relationships, pages, coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evispark.functions import columns as C
from evispark.functions import patterns
from evispark.functions.udfs import call
from evispark.operators import topics
from evispark.operators.checks import array_checks, bad_values, changed_rows, duplicates, missing, rows, text_checks, union


def provenance(blocks: DataFrame) -> DataFrame:
    """Citations that repeat or don't match their slide and element, and contents whose digest is another."""
    key = F.col("citation")
    parts = C.citation_parts(key)
    agrees = (parts["slide"] == F.col("slide_number")) & (parts["element"] == F.col("element_id"))
    return union([
        duplicates(blocks, ["source_id", "citation"], "duplicate-citation"),
        bad_values(blocks, "citation-mismatch", key, ~F.coalesce(agrees, F.lit(False))),
        bad_values(blocks, "content-digest", key, C.sha256(F.col("content")) != F.col("content_sha256")),
    ])


def assets(blocks: DataFrame, files: DataFrame) -> DataFrame:
    """Assets that are missing, outside the asset folder, or other bytes. blocks: (citation, asset_path, asset_sha256);
    files: (path, sha256)."""
    used = blocks.where("asset_path is not null")
    outside = ~F.col("asset_path").startswith("assets/") | F.col("asset_path").contains("..")
    found = used.join(files.select(F.col("path").alias("asset_path"), "sha256"), "asset_path", "left")
    return union([bad_values(used, "asset-path", F.col("citation"), outside), bad_values(found, "asset-missing", F.col("citation"), F.col("sha256").isNull()), bad_values(found, "asset-digest", F.col("citation"), F.col("sha256") != F.col("asset_sha256"))])


def source_map(blocks: DataFrame, ledger: DataFrame) -> DataFrame:
    """(qualified_citation, source_id, local_citation, slide_number, element_id, content_sha256, request_values, numbers,
    identifiers) of every block."""
    own = ledger.groupBy("source_id", "citation").agg(F.transform(F.sort_array(F.collect_list(F.struct("position", "value"))), lambda s: s["value"]).alias("request_values"))
    visible = C.visible_text(F.col("slide_title"), F.col("content"))
    none = F.array().cast("array<string>")
    out = blocks.join(own, ["source_id", "citation"], "left")
    return out.select(C.qualified(F.col("source_id"), F.col("citation")).alias("qualified_citation"), "source_id", F.col("citation").alias("local_citation"), "slide_number", "element_id", "content_sha256", F.coalesce("request_values", none).alias("request_values"), call("claim_numbers", visible).alias("numbers"), call("identifiers", visible).alias("identifiers"))


def source_map_rows(map_: DataFrame) -> DataFrame:
    """A source map's rows by themselves: citations that repeat or name another source, slide or element, slides before the first,
    digests that are none, lists with repeated values."""
    key = F.col("qualified_citation")
    parts = C.citation_parts(key)
    agrees = (parts["source"] == F.col("source_id")) & (parts["slide"] == F.col("slide_number")) & (parts["element"] == F.col("element_id"))
    twice = [bad_values(map_, f"repeated-{c}", key, F.size(F.array_distinct(c)) != F.size(c)) for c in ("request_values", "numbers", "identifiers") if c in map_.columns]
    return union([
        duplicates(map_, ["qualified_citation"], "duplicate-citation"),
        bad_values(map_, "citation-mismatch", key, ~F.coalesce(agrees, F.lit(False))),
        bad_values(map_, "slide-number", key, F.coalesce(F.col("slide_number"), F.lit(0)) < 1),
        bad_values(map_, "no-digest", key, ~F.coalesce(F.col("content_sha256").rlike("^[0-9a-f]{64}$"), F.lit(False))),
        *twice,
    ])


def edge_requests(edges: DataFrame, map_: DataFrame) -> DataFrame:
    """Request numbers of relationships (id, subject, object, citations, requests): those that none of its citations has, and ends
    that aren't among them."""
    have = edges.select("id", F.explode("citations").alias("qualified_citation")).join(map_.select("qualified_citation", F.explode("request_values").alias("value")), "qualified_citation").select("id", "value").distinct()
    said = edges.select("id", F.explode("requests").alias("value"))
    ends = edges.select("id", "requests", F.explode(F.array("subject", "object")).alias("end")).where(F.startswith("end", F.lit("pr:"))).withColumn("value", F.substring("end", 4, 1 << 30))
    return union([
        rows(said.join(have, ["id", "value"], "left_anti"), "request-not-cited", F.col("id"), F.col("value")),
        bad_values(ends, "end-not-a-request", F.col("id"), ~F.array_contains("requests", F.col("value")), F.col("value")),
        bad_values(edges, "no-request", F.col("id"), F.size("requests") == 0),
    ])


def lineage(stored: DataFrame, blocks: DataFrame, ledger: DataFrame) -> DataFrame:
    """What a stored source map says against what the blocks give."""
    return changed_rows(stored, source_map(blocks, ledger).select(*stored.columns), "qualified_citation")


def entities(df: DataFrame, known_sources: DataFrame, map_: DataFrame) -> DataFrame:
    """Ids that repeat or are unsafe, aliases that repeat, citations that are unknown, sources that don't follow from them."""
    cited = df.select("id", "source_ids", F.explode("citations").alias("qualified_citation"))
    derived = cited.join(map_.select("qualified_citation", "source_id"), "qualified_citation").groupBy("id").agg(F.collect_set("source_id").alias("derived"))
    return union([
        duplicates(df, ["id"], "duplicate-id"),
        bad_values(df, "unsafe-id", F.col("id"), ~F.col("id").rlike(patterns.SAFE_ID)),
        bad_values(df, "repeated-alias", F.col("id"), F.size(F.array_distinct("aliases")) != F.size("aliases")),
        bad_values(df, "no-citation", F.col("id"), F.size("citations") == 0),
        rows(cited.join(map_.select("qualified_citation"), "qualified_citation", "left_anti"), "unknown-citation", F.col("id"), F.col("qualified_citation")),
        rows(df.select("id", F.explode("source_ids").alias("source_id")).join(known_sources, "source_id", "left_anti"), "unknown-source", F.col("id"), F.col("source_id")),
        array_checks(df.join(derived, "id"), "id", "source_ids", "derived", "source-lineage"),
    ])


def pages(df: DataFrame, entity_ids: DataFrame, map_: DataFrame) -> DataFrame:
    """Pages whose body cites other than they declare, names undeclared entities, or holds what pages may not."""
    key = F.col("id")
    body = F.regexp_extract_all("body_markdown", F.lit(f"({patterns.QUALIFIED_CITATION})"), 1)
    linked = F.regexp_extract_all("body_markdown", F.lit(r"\[\[entities/([^\]|#]+)"), 1)
    return union([
        duplicates(df, ["id"], "duplicate-id"),
        array_checks(df.withColumn("cited", body), "id", "citations", "cited", "declared-citations"),
        rows(df.select("id", F.explode("citations").alias("qualified_citation")).join(map_.select("qualified_citation"), "qualified_citation", "left_anti"), "unknown-citation", key, F.col("qualified_citation")),
        bad_values(df, "undeclared-entity", key, F.size(F.array_except(linked, F.col("entity_ids"))) > 0),
        rows(df.select("id", F.explode("entity_ids").alias("entity")).join(entity_ids.select(F.col("id").alias("entity")), "entity", "left_anti"), "unknown-entity", key, F.col("entity")),
        bad_values(df, "raw-image", key, F.col("body_markdown").rlike(patterns.HTML_IMAGE) | F.col("body_markdown").rlike(r"(?<!\\)!\[")),
        text_checks(df, key, F.col("body_markdown")),
    ])


def coverage(stored: DataFrame, sources: DataFrame, pages_: DataFrame, entities_: DataFrame) -> DataFrame:
    """Stored coverage against what pages and entities say, and sources that nothing covers."""
    ids = lambda df: df.select("id", F.explode("source_ids").alias("source_id"))
    derived = topics.coverage(sources, ids(pages_), ids(entities_))
    same = stored.select(*derived.columns)
    return union([changed_rows(same, derived, "source_id"), bad_values(derived, "uncovered-source", F.col("source_id"), ~F.col("covered"))])


def documents(df: DataFrame, blocks: DataFrame, slides: DataFrame) -> DataFrame:
    """Documents (document_id, source_id, citations) that cite no block, or a block whose slide has no page. blocks: (source_id,
    citation, slide_number); slides: (source_id, slide_number)."""
    cited = df.select("document_id", "source_id", F.explode(F.array_distinct("citations")).alias("citation")).join(blocks.select("source_id", "citation", "slide_number"), ["source_id", "citation"], "left")
    lost = cited.where("slide_number is not null").join(slides, ["source_id", "slide_number"], "left_anti")
    return union([rows(cited.where("slide_number is null"), "unknown-citation", F.col("document_id"), F.col("citation")), rows(lost, "slide-page-missing", F.col("document_id"), F.col("citation"))])


def relationships(df: DataFrame, entities_: DataFrame) -> DataFrame:
    """Edges with unknown or equal ends, with no citation that an end shares, or from sources that an end lacks."""
    ends = df.select("id", "citations", "source_ids", F.explode(F.array("subject", "object")).alias("end")).join(entities_.select(F.col("id").alias("end"), F.col("citations").alias("theirs"), F.col("source_ids").alias("their_sources")), "end", "left")
    return union([
        duplicates(df, ["id"], "duplicate-id"),
        bad_values(df, "self-loop", F.col("id"), F.col("subject") == F.col("object")),
        rows(ends.where("theirs is null"), "unknown-endpoint", F.col("id"), F.col("end")),
        bad_values(ends, "no-shared-citation", F.col("id"), ~F.arrays_overlap("citations", "theirs"), F.col("end")),
        bad_values(ends, "source-not-shared", F.col("id"), F.size(F.array_except("source_ids", "their_sources")) > 0, F.col("end")),
    ])


# Keys of a generated page's head.
HEAD_KEYS = ("title", "description", "aliases", "tags", "pr_numbers", "source_ids", "draft")


def front_matter(pages_: DataFrame, keys: tuple[str, ...] = HEAD_KEYS) -> DataFrame:
    """Generated pages whose head isn't the keys in their order, one line each: JSON texts of one line for title and description
    (of at most 500 characters), lists of distinct JSON texts for the others, and no draft."""
    head = F.regexp_extract("body", r"\A---\n((?:.*\n)*?)---\n", 1)
    lines = F.filter(F.split(head, "\n"), lambda x: x != "")
    own = pages_.select("path", head.alias("head"), lines.alias("lines"))
    has = own.where("head <> ''")
    names = F.transform("lines", lambda x: F.substring_index(x, ": ", 1))
    value = lambda k: F.get(F.transform(F.filter("lines", lambda x: F.startswith(x, F.lit(f"{k}: "))), lambda x: F.substring(x, len(k) + 3, 1 << 30)), 0)
    wrong = []
    for k in keys:
        v = F.col("v")
        if k == "draft":
            bad = v != "false"
        elif k in ("title", "description"):
            text = F.get(F.from_json(F.concat(F.lit("["), v, F.lit("]")), "array<string>"), 0)
            bad = ~v.rlike(r'^".*"$') | text.isNull() | text.contains("\n") | (F.length(text) > 500) | ((text == "") if k == "title" else F.lit(False))
        else:
            items = F.from_json(v, "array<string>")
            bad = ~v.rlike(r"^\[.*\]$") | items.isNull() | (F.size(F.array_distinct(items)) != F.size(items)) | F.exists(items, lambda x: x.isNull())
        own_key = has.withColumn("v", value(k))
        wrong += [bad_values(own_key, f"front-matter-{k}", F.col("path"), v.isNull()), bad_values(own_key.where(v.isNotNull()), f"front-matter-{k}-value", F.col("path"), F.coalesce(bad, F.lit(True)), v)]
    known = F.filter(names, lambda x: x.isin(*keys))
    odd = has.where((F.size(F.array_except(F.lit(list(keys)), names)) == 0) & (names != F.lit(list(keys))))
    return union([bad_values(own, "no-front-matter", F.col("path"), F.col("head") == ""), rows(odd, "front-matter-keys", F.col("path"), F.array_join(known, ",")), *wrong])


def evidence(citations: DataFrame, pages_: DataFrame) -> DataFrame:
    """Anchors of cited evidence that a page lacks, or whose content is another. citations: (citation, path, anchor,
    content_sha256); pages_: (path, body)."""
    found = citations.join(pages_, "path", "left").withColumn("part", call("evidence_block", "body", "anchor"))
    inner = F.regexp_replace(F.regexp_replace("part", r'^<a id="[^"]*"></a>\n\n', ""), r"\n\n\[[^\n]*\]$", "")
    return union([bad_values(found, "anchor-missing", F.col("citation"), F.col("part").isNull()), bad_values(found, "evidence-changed", F.col("citation"), C.sha256(inner) != F.col("content_sha256"))])


def decisions(decided: DataFrame, blocks: DataFrame, ledger: DataFrame) -> DataFrame:
    """A semantic artifact's decisions: every block once, protected blocks kept, originals of duplicates kept and of the
    same source."""
    key = ["source_id", "citation"]
    protected = ledger.select(*key).distinct()
    lost = decided.join(protected, key, "left_semi").where("disposition <> 'keep'")
    copies = decided.where("disposition = 'duplicate'").select("source_id", F.col("citation").alias("copy"), F.col("duplicate_of").alias("citation"))
    kept = decided.where("disposition = 'keep'").select(*key)
    return union([duplicates(decided, key, "decided-twice"), missing(blocks, decided, key, "undecided"), missing(decided, blocks, key, "unknown-citation"), rows(lost, "protected-not-kept", F.col("citation")), rows(copies.join(kept, key, "left_anti"), "original-not-kept", F.col("copy"), F.col("citation"))])
