"""Registered queries: every operator over the plain tables, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evispark import views
from evispark.functions import columns as C
from evispark.functions.udfs import call
from evispark.operators import blocks as B
from evispark.operators import artifacts, checks, chunks, decisions, geometry, graph, links, topics
from evispark.plans import pictures, publish, runs, stages
from evispark.session import dealt, scratch, tasks
from evispark.streaming import ingest
from evispark.views import SLIDE_HEIGHT, SLIDE_WIDTH, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

DOC = """doc AS (SELECT source AS source_id, doc_id + 1 AS slide_number, lang AS slide_title,
'doc-' || doc_id AS element_id, text AS content, doc_id AS rank, '[slide-' || (doc_id + 1) || '#doc-' || doc_id || ']' AS citation FROM documents)"""
GEO = """geo AS (SELECT l_orderkey AS slide_number, CAST(l_linenumber AS INTEGER) AS element_id, CASE WHEN l_linenumber % 2 = 1 THEN 'native' ELSE 'ocr' END AS source,
(l_partkey * 37) % 9000 * 1000 AS x, (l_suppkey * 91) % 5000 * 1000 AS y, CAST(1000000 + l_linenumber * 400000 AS BIGINT) AS width, CAST(600000 + l_linenumber * 300000 AS BIGINT) AS height,
CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS text FROM lineitem)"""
SELECTED = "sel AS (SELECT source_id, citation FROM doc JOIN labels ON element_id = 'doc-' || doc_id WHERE quality = 1 AND toxic = 0)"
COPIES = r"""keyed AS (SELECT *, first_value(citation) OVER w AS duplicate_of, row_number() OVER w AS n FROM (SELECT *, trim(regexp_replace(content, '[ \t\n\x0B\f\r\x1c-\x1f]+', ' ', 'g'), ' ') AS form FROM doc)
WINDOW w AS (PARTITION BY source_id, form ORDER BY rank)), copies AS (SELECT source_id, citation, duplicate_of FROM keyed WHERE n > 1)"""
DECIDED = f"""{DOC}, {SELECTED}, {COPIES},
chosen AS (SELECT source_id, citation FROM sel UNION SELECT s.source_id, c.duplicate_of FROM sel s JOIN copies c USING (source_id, citation)),
decided AS (SELECT d.source_id, d.citation, CASE WHEN c.citation IS NOT NULL THEN 'duplicate' WHEN h.citation IS NOT NULL OR a.source_id IS NULL THEN 'keep' ELSE 'omit' END AS disposition,
CASE WHEN c.citation IS NOT NULL THEN 'exact_duplicate' WHEN h.citation IS NOT NULL OR a.source_id IS NULL THEN 'selected' ELSE 'out_of_scope' END AS reason_code, c.duplicate_of
FROM doc d LEFT JOIN copies c USING (source_id, citation) LEFT JOIN chosen h ON h.source_id = d.source_id AND h.citation = d.citation LEFT JOIN (SELECT DISTINCT source_id FROM chosen) a ON a.source_id = d.source_id)"""


#: A text with single spaces, as Spark and SQL say it: what an earlier, cleaned copy of it holds.
_ONE_SPACE = r"[ \t\n]+"
_CLEAN = "trim(regexp_replace(text, '[ \\t\\n]+', ' ', 'g'), ' ')"


def _clean(text):
    return F.trim(F.regexp_replace(text, _ONE_SPACE, " "))


def query(sql: str | None = None):
    """Register a function under its name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# ---- blocks


@query("""SELECT 'deck-' || conv_id AS source_id, CAST(turn + 1 AS INTEGER) AS slide_number, '' AS slide_title, '[slide-' || (turn + 1) || '#' || role || ']' AS citation, role AS element_id,
role AS kind, 'text' AS content_format, text AS content, conv_id * 1000 + turn AS rank, sha256(text) AS content_sha256 FROM conversations""")
def blocks(spark, sf):
    """Conversations as provenance blocks."""
    return views.blocks_conv(spark, sf)


@query(f"WITH {DOC} SELECT source_id, citation, sha256(content) AS content_sha256, CAST(length(content) AS BIGINT) AS n FROM doc")
def block_content_digest(spark, sf):
    return views.blocks_doc(spark, sf).select("source_id", "citation", "content_sha256", F.length("content").cast("long").alias("n"))


@query(f"WITH {DOC} SELECT source_id, citation, '[@' || source_id || '/slide-' || slide_number || '#' || element_id || ']' AS qualified, slide_number, element_id FROM doc")
def citation_build_and_parse(spark, sf):
    q = views.blocks_doc(spark, sf).select("source_id", "citation", C.qualified(F.col("source_id"), F.col("citation")).alias("qualified"))
    return q.withColumn("p", C.citation_parts(F.col("qualified"))).select("source_id", "citation", "qualified", F.col("p.slide").cast("long").alias("slide_number"), F.col("p.element").alias("element_id"))


@query("""SELECT CAST(l_orderkey AS BIGINT) AS slide_number, CAST(l_linenumber AS INTEGER) AS element_id, CAST(row_number() OVER (PARTITION BY l_orderkey
ORDER BY CASE WHEN l_linenumber % 3 = 0 THEN 0 ELSE 1 END, CASE WHEN l_linenumber % 3 = 0 THEN l_suppkey END, (l_suppkey * 91) % 5000 * 1000, (l_partkey * 37) % 9000 * 1000, l_linenumber) AS INTEGER) AS reading_order FROM lineitem""")
def reading_order(spark, sf):
    t = table(spark, sf, "lineitem")
    geo = t.select(
        F.col("l_orderkey").alias("slide_number"),
        F.col("l_linenumber").cast("int").alias("element_id"),
        F.when(F.col("l_linenumber") % 3 == 0, F.col("l_suppkey")).alias("explicit_order"),
        ((F.col("l_suppkey") * 91) % 5000 * 1000).alias("y"),
        ((F.col("l_partkey") * 37) % 9000 * 1000).alias("x"),
        F.lit(0).alias("z_index"),
        F.col("l_linenumber").alias("input_index"),
    )
    return B.reading_order(geo, ["slide_number"]).select("slide_number", "element_id", "reading_order")


@query("""SELECT source AS source_id, 'e' || (doc_id % 7) AS base, doc_id, CASE WHEN row_number() OVER w = 1 THEN 'e' || (doc_id % 7) ELSE 'e' || (doc_id % 7) || '--' || row_number() OVER w END AS unique_id
FROM documents WINDOW w AS (PARTITION BY source, doc_id % 7 ORDER BY doc_id)""")
def unique_element_ids(spark, sf):
    d = table(spark, sf, "documents").select(F.col("source").alias("source_id"), F.concat(F.lit("e"), (F.col("doc_id") % 7).cast("string")).alias("base"), "doc_id")
    return B.unique_ids(d, ["source_id"], "base", "doc_id")


@query("""WITH b AS (SELECT conv_id, turn, '<!-- BEGIN BLOCK ' || role || ' -->' || chr(10) || '<a id="' || role || '"></a>' || chr(10) || chr(10) || text || chr(10) || chr(10) || '[slide-' || (turn + 1) || '#' || role || ']' || chr(10) || '<!-- END BLOCK ' || role || ' -->' AS b FROM conversations)
SELECT 'deck-' || conv_id AS source_id, CAST(turn + 1 AS INTEGER) AS slide_number, '# Slide ' || (turn + 1) || chr(10) || chr(10) || string_agg(b, chr(10) || chr(10) ORDER BY b) AS page FROM b GROUP BY conv_id, turn""")
def slide_pages(spark, sf):
    return B.slide_pages(views.blocks_conv(spark, sf))


@query("""SELECT l_orderkey AS table_id, CAST(l_linenumber AS INTEGER) AS line, CAST(coalesce(sum(CAST(l_quantity AS BIGINT)) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset" FROM lineitem""")
def cumulative_offsets(spark, sf):
    t = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("table_id"), F.col("l_linenumber").cast("int").alias("line"), F.col("l_quantity").cast("long").alias("size"), "l_partkey", "l_suppkey")
    return B.cumulative_offsets(t, ["table_id"], ["line", "l_partkey", "l_suppkey", "size"], "size").select("table_id", "line", "offset")


@query("""SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'markdown' WHEN doc_id % 5 = 1 THEN 'html' WHEN doc_id % 5 = 2 THEN 'text' WHEN doc_id % 5 = 3 THEN 'markdown' ELSE 'text' END AS format,
CASE WHEN doc_id % 5 IN (0, 1, 2) THEN text WHEN doc_id % 5 = 3 THEN '![' || lang || '](' || source || '.png)' ELSE '' END AS content FROM documents""")
def content_precedence(spark, sf):
    d = table(spark, sf, "documents")
    only = lambda n: F.when(F.col("doc_id") % 5 == n, F.col("text"))
    asset = F.when(F.col("doc_id") % 5 == 3, F.concat("source", F.lit(".png")))
    return d.select("doc_id", C.content_of(F.lit(None).cast("string"), only(0), only(1), only(2), asset, F.col("lang")).alias("c")).select("doc_id", "c.format", "c.content")


ELEMENTS = """el AS (SELECT o_orderkey AS slide_number, o_custkey AS element_id, CASE o_orderkey % 6 WHEN 0 THEN 'image' WHEN 1 THEN 'text' WHEN 2 THEN 'chart' WHEN 3 THEN 'table' WHEN 4 THEN 'shape' ELSE 'diagram' END AS kind,
CASE WHEN o_custkey % 3 = 0 THEN '  ' WHEN o_custkey % 3 = 1 THEN o_orderpriority END AS text FROM orders)"""


def _elements(spark, sf):
    kind = F.element_at(F.array(*map(F.lit, ("image", "text", "chart", "table", "shape", "diagram"))), (F.col("o_orderkey") % 6 + 1).cast("int"))
    text = F.when(F.col("o_custkey") % 3 == 0, "  ").when(F.col("o_custkey") % 3 == 1, F.col("o_orderpriority"))
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("slide_number"), F.col("o_custkey").alias("element_id"), kind.alias("kind"), text.alias("text"))


@query(f"WITH {ELEMENTS} SELECT slide_number, element_id, kind FROM el WHERE kind IN ('image', 'chart', 'diagram', 'table') OR trim(coalesce(text, '')) <> ''")
def keep_elements(spark, sf):
    return B.keep_elements(_elements(spark, sf)).select("slide_number", "element_id", "kind")


@query(f"WITH {ELEMENTS} SELECT slide_number, element_id, CASE kind WHEN 'image' THEN 'document' ELSE 'chart' END AS task FROM el WHERE kind IN ('image', 'chart', 'diagram')")
def visual_targets(spark, sf):
    return B.visual_targets(_elements(spark, sf)).select("slide_number", "element_id", "task")


@query(f"WITH {ELEMENTS} SELECT slide_number, element_id FROM el WHERE coalesce(text, '') <> '' OR kind = 'image'")
def blocks_without_empty(spark, sf):
    e = _elements(spark, sf).withColumn("asset_path", F.when(F.col("kind") == "image", F.lit("a.png"))).withColumnRenamed("text", "content")
    return B.without_empty(e).select("slide_number", "element_id")


@query("""WITH n AS (SELECT conv_id, CASE WHEN conv_id % 3 = 0 THEN ' ' ELSE 'note ' || conv_id END AS notes FROM (SELECT DISTINCT conv_id FROM conversations)), m AS (SELECT conv_id, max(turn) + 1 AS last FROM conversations WHERE conv_id % 2 = 0 GROUP BY 1)
SELECT n.conv_id, 'notes' AS kind, notes AS content, CAST(coalesce(last, 0) + 1 AS BIGINT) AS reading_order FROM n LEFT JOIN m USING (conv_id) WHERE trim(notes) <> ''""")
def notes_blocks(spark, sf):
    """Notes behind the kept blocks of conversations; odd ones have lost their blocks."""
    c = table(spark, sf, "conversations")
    notes = c.select("conv_id").distinct().withColumn("notes", F.when(F.col("conv_id") % 3 == 0, " ").otherwise(F.concat(F.lit("note "), F.col("conv_id").cast("string"))))
    kept = c.where("conv_id % 2 = 0").select("conv_id", (F.col("turn") + 1).cast("long").alias("reading_order"))
    return B.notes_blocks(kept, notes, ["conv_id"]).select("conv_id", "kind", "content", F.col("reading_order").cast("long").alias("reading_order"))


@query("SELECT o_custkey AS page, o_orderkey AS line, CASE WHEN row_number() OVER w > 1 THEN lower(o_orderstatus) || '-' || (row_number() OVER w - 1) ELSE lower(o_orderstatus) END AS anchor FROM orders WINDOW w AS (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey)")
def heading_slugs(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("page"), F.col("o_orderkey").alias("line"), F.lower("o_orderstatus").alias("slug"))
    return links.heading_slugs(o, "page", "line", "slug").select("page", "line", "anchor")


@query("""WITH b AS (SELECT l_orderkey AS id, l_partkey AS p, l_suppkey % 100 AS s, l_linenumber AS n FROM lineitem)
SELECT id, p, n, CASE WHEN n % 3 = 0 THEN [least(p, s), least(s, p + 1), greatest(p, s), greatest(s, p + 1)] WHEN s >= p AND p + 1 >= s THEN [p, s, s, p + 1] END AS box FROM b""")
def clean_boxes(spark, sf):
    """Boxes of two corners, which count only in order, and of four, which have a box in any."""
    t = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_partkey").alias("p"), (F.col("l_suppkey") % 100).alias("s"), F.col("l_linenumber").alias("n"))
    two = F.array("p", "s", "s", F.col("p") + 1)
    four = F.array(F.col("p"), F.col("s"), F.col("s"), F.col("p") + 1, F.col("p"), F.col("p") + 1, F.col("s"), F.col("s"))
    box = C.clean_box(F.when(F.col("n") % 3 == 0, four).otherwise(two).cast("array<double>"))
    return t.select("id", "p", "n", box.cast("array<long>").alias("box"))


@query("""SELECT l_orderkey AS id, l_linenumber AS n, l_partkey AS p, list_transform([l_partkey % 1200 - 100, l_suppkey % 1100, l_partkey % 1500, l_suppkey % 900 + 200], lambda v, i: CAST(round(least(greatest(v / 1000.0 * CASE WHEN i % 2 = 1 THEN 4000 ELSE 2250 END, 0), CASE WHEN i % 2 = 1 THEN 4000 ELSE 2250 END) * 1000) AS BIGINT)) AS milli_pixels FROM lineitem""")
def grid_pixels(spark, sf):
    t = table(spark, sf, "lineitem")
    grid = F.array(F.col("l_partkey") % 1200 - 100, F.col("l_suppkey") % 1100, F.col("l_partkey") % 1500, F.col("l_suppkey") % 900 + 200)
    return t.select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("p"), F.transform(C.grid_to_pixels(grid, F.lit(4000), F.lit(2250)), lambda v: F.round(v * 1000).cast("long")).alias("milli_pixels"))


@query("""WITH b AS (SELECT l_orderkey AS id, l_linenumber AS n, l_partkey AS p, least(greatest(l_partkey % 300 - 10, 0), 200) AS x1, least(greatest(l_suppkey % 150 - 10, 0), 100) AS y1, least(greatest(l_partkey % 300 + l_linenumber * 8 - 10, 0), 200) AS x2, least(greatest(l_suppkey % 150 + 20 - 10, 0), 100) AS y2, l_linenumber % 5 = 0 AS none FROM lineitem)
SELECT id, n, p, CASE WHEN none OR x2 <= x1 OR y2 <= y1 THEN [1000, 2000, 600, 300] ELSE [1000 + x1 * 3, 2000 + y1 * 3, (x2 - x1) * 3, (y2 - y1) * 3] END AS box FROM b""")
def box_on_slide(spark, sf):
    """Boxes that were found in a padded crop of 200 by 100 pixels, on the slide; the crop's own box where one vanishes."""
    t = table(spark, sf, "lineitem")
    at = lambda c: F.when(F.col("l_linenumber") % 5 != 0, c.cast("double"))
    block = [at(F.col("l_partkey") % 300), at(F.col("l_suppkey") % 150), at(F.col("l_partkey") % 300 + F.col("l_linenumber") * 8), at(F.col("l_suppkey") % 150 + 20)]
    box = C.box_on_slide([F.lit(n).cast("long") for n in (1000, 2000, 600, 300)], block, F.lit(10.0), F.lit(200.0), F.lit(100.0), F.lit(3.0), F.lit(3.0))
    return t.select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("p"), box.alias("box"))


@query("""SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'image/png' WHEN 1 THEN 'image/jpeg' WHEN 2 THEN 'image/tiff' WHEN 3 THEN 'image/webp' ELSE 'application/octet-stream' END AS kind, 'data:' || CASE doc_id % 5 WHEN 0 THEN 'image/png' WHEN 1 THEN 'image/jpeg' WHEN 2 THEN 'image/tiff' WHEN 3 THEN 'image/webp' ELSE 'application/octet-stream' END
|| ';base64,' || to_base64(CASE doc_id % 5 WHEN 0 THEN unhex('89504E470D0A1A0A') WHEN 1 THEN unhex('FFD8FFE0') WHEN 3 THEN unhex('524946460000000057454250') ELSE unhex('00') END) AS url FROM documents""")
def media_types(spark, sf):
    """Media by their first bytes, else by their names, and as data URLs."""
    d, by = table(spark, sf, "documents"), F.col("doc_id") % 5
    data = F.unhex(F.when(by == 0, "89504E470D0A1A0A").when(by == 1, "FFD8FFE0").when(by == 3, "524946460000000057454250").otherwise("00"))
    kind = C.media_type(data, F.when(by == 2, "a/b.TIFF").when(by == 1, "wrong.png").otherwise("none"))
    return d.select("doc_id", kind.alias("kind"), C.data_url(data, kind).alias("url"))


@query("""SELECT l_orderkey AS id, l_linenumber AS n, l_partkey AS p, CASE WHEN l_linenumber % 3 = 2 THEN '' ELSE '$$' || chr(10) || 'x_' || l_partkey || chr(10) || '$$' END AS formula FROM lineitem""")
def formula_markdown(spark, sf):
    part = F.concat(F.lit("x_"), F.col("l_partkey").cast("string"))
    raw = F.when(F.col("l_linenumber") % 3 == 0, F.concat(F.lit(" $"), part, F.lit("$ "))).when(F.col("l_linenumber") % 3 == 1, F.concat(F.lit("$$ "), part, F.lit(" $$"))).otherwise("$$ $$")
    return table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("p"), C.formula_markdown(raw).alias("formula"))


@query("""SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '_con.' || doc_id WHEN 1 THEN 'a_' || doc_id WHEN 2 THEN 'deck' ELSE left('n' || doc_id || repeat('x', 120), 100) END AS stem FROM documents""")
def safe_stems(spark, sf):
    d, i = F.col("doc_id") % 4, F.col("doc_id").cast("string")
    name = F.when(d == 0, F.concat(F.lit("con."), i)).when(d == 1, F.concat(F.lit(" a<>:"), i, F.lit(". "))).when(d == 2, " . ").otherwise(F.concat(F.lit("n"), i, F.lit("x" * 120)))
    return table(spark, sf, "documents").select("doc_id", C.safe_stem(name).alias("stem"))


# ---- decisions


@query(f"WITH {DOC}, {COPIES} SELECT * FROM copies")
def dup_map(spark, sf):
    return decisions.exact_duplicates(views.blocks_doc(spark, sf))


def _decided(spark, sf):
    d = views.blocks_doc(spark, sf)
    none = d.select("source_id", "citation").limit(0)
    return d, decisions.decisions(d, views.selection(spark, sf), none, decisions.exact_duplicates(d))


@query(f"WITH {DECIDED} SELECT * FROM decided")
def keep_decisions(spark, sf):
    return _decided(spark, sf)[1]


@query(f"WITH {DECIDED} SELECT disposition, reason_code, count(*) AS n FROM decided GROUP BY ALL")
def decisions_counts(spark, sf):
    return _decided(spark, sf)[1].groupBy("disposition", "reason_code").agg(F.count("*").alias("n"))


@query(f"WITH {DECIDED} SELECT d.source_id, d.citation, d.slide_title FROM doc d SEMI JOIN (SELECT * FROM decided WHERE disposition = 'keep') k ON d.source_id = k.source_id AND d.citation = k.citation")
def selected_semi(spark, sf):
    d, k = _decided(spark, sf)
    return stages.kept_blocks(d, k).select("source_id", "citation", "slide_title")


@query(f"WITH {DECIDED} SELECT d.source_id, d.citation, d.slide_title FROM doc d ANTI JOIN (SELECT * FROM decided WHERE disposition = 'keep') k ON d.source_id = k.source_id AND d.citation = k.citation")
def omitted_anti(spark, sf):
    d, k = _decided(spark, sf)
    return stages.omitted_blocks(d, k).select("source_id", "citation", "slide_title")


@query("""WITH b AS (SELECT source AS source_id, '[slide-' || (doc_id + 1) || '#doc-' || doc_id || ']' AS citation, doc_id FROM documents)
SELECT 'decided-twice' AS check_code, doc_id FROM b WHERE doc_id % 10 = 2 UNION ALL SELECT 'undecided', doc_id FROM b WHERE doc_id % 10 = 1 UNION ALL SELECT 'unknown-citation', doc_id FROM b WHERE doc_id % 10 = 3""")
def decision_violations(spark, sf):
    """Decisions of which some are missing, some come twice and some are of a block that isn't there."""
    d, decided = _decided(spark, sf)
    last = F.regexp_extract("citation", r"doc-(\d+)", 1).cast("long")
    twice, ghosts = decided.where(last % 10 == 2), decided.where(last % 10 == 3).withColumn("source_id", F.lit("ghost"))
    found = stages.complete_decisions(d, decided.where(last % 10 != 1).union(twice).union(ghosts))
    return found.select("check_code", F.regexp_extract("key", r"doc-(\d+)", 1).cast("long").alias("doc_id"))


@query("SELECT sha256(text) AS sha256, count(*) AS n, list_sort(list(CAST(doc_id AS VARCHAR))) AS paths FROM documents GROUP BY 1")
def source_groups(spark, sf):
    return decisions.occurrences(table(spark, sf, "documents").select(C.sha256(F.col("text")).alias("sha256"), F.col("doc_id").cast("string").alias("path")))


@query("""WITH d AS (SELECT DISTINCT sha256(text) AS sha256 FROM documents), l AS (SELECT unnest(range(2, 65, 2)) AS l), n AS (SELECT l, count(DISTINCT left(sha256, CAST(l AS INTEGER))) AS n FROM d, l GROUP BY l)
SELECT sha256, 'deck-' || left(sha256, CAST((SELECT min(l) FROM n WHERE n = (SELECT count(*) FROM d)) AS INTEGER)) AS source_id FROM d""")
def unique_prefix(spark, sf):
    """The shortest prefixes that differ, from two digits on, so that short ones do collide."""
    return decisions.source_ids(table(spark, sf, "documents").select(C.sha256(F.col("text")).alias("sha256")), 2)


@query("SELECT o_orderkey, 'PR-' || o_orderkey AS value, CAST(o_orderkey AS VARCHAR) AS canonical_key FROM orders WHERE o_orderkey % 3 = 0")
def request_ledger(spark, sf):
    """Request numbers of made-up blocks: a number for every third order, spelled in three ways."""
    k = F.col("o_orderkey").cast("string")
    text = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("PR No.: PR-"), k, F.lit("\nResult: passed"))).otherwise(F.concat(F.lit("| name | PR 번호 |\n| --- | --- |\n| a | PR-"), k, F.lit(" |")))
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderkey").alias("rank"), F.lit("s").alias("source_id"), F.col("o_orderkey").cast("string").alias("citation"), F.lit(1).alias("slide_number"), F.lit("e").alias("element_id"), F.lit("").alias("slide_title"), F.when(F.col("o_orderkey") % 3 == 0, text).otherwise("Guide 40").alias("content"))
    return decisions.request_ledger(o).select(F.col("rank").alias("o_orderkey"), "value", "canonical_key")


REQUESTS = """rq AS (SELECT 's' || o_custkey % 20 AS source_id, 'c' || o_orderkey AS citation, o_orderkey AS rank, CASE WHEN o_orderkey % 4 = 0 THEN 'PR-' || o_custkey % 30 ELSE 'pr ' || o_custkey % 30 END AS value, CAST(o_custkey % 30 AS VARCHAR) AS key FROM orders)"""


def _requests(spark, sf):
    number = (F.col("o_custkey") % 30).cast("string")
    text = F.when(F.col("o_orderkey") % 4 == 0, F.concat(F.lit("see PR-"), number)).otherwise(F.concat(F.lit("see pr "), number, F.lit(", and pr "), number))
    o = table(spark, sf, "orders").select(F.concat(F.lit("s"), (F.col("o_custkey") % 20).cast("string")).alias("source_id"), F.concat(F.lit("c"), F.col("o_orderkey").cast("string")).alias("citation"), F.lit(1).alias("slide_number"), F.lit("e").alias("element_id"), F.col("o_orderkey").alias("rank"), F.lit("").alias("slide_title"), text.alias("content"))
    return decisions.request_ledger(o)


@query(f"WITH {REQUESTS}, f AS (SELECT source_id, key, min(rank) AS rank, arg_min(value, rank) AS value FROM rq GROUP BY ALL) SELECT source_id, list(value ORDER BY rank) AS values FROM f GROUP BY 1")
def request_inventory(spark, sf):
    """A source's request numbers, a spelling of each, in the order of their first places."""
    return decisions.inventory(_requests(spark, sf))


@query(f"WITH {REQUESTS} SELECT source_id, citation, [value] AS values FROM rq")
def request_by_citation(spark, sf):
    return decisions.by_citation(_requests(spark, sf))


# ---- topics and coverage


@query(f"WITH {DOC} SELECT source_id, slide_title AS title, list(citation ORDER BY rank) AS citations FROM doc GROUP BY ALL")
def slide_topics(spark, sf):
    """A topic for each language of a source."""
    d = views.blocks_doc(spark, sf).withColumn("slide_number", F.hash("slide_title"))
    return topics.slide_topics(d).select("source_id", "title", "citations")


def _merged(spark, sf):
    d = views.blocks_doc(spark, sf)
    c = d.select("source_id", F.col("rank").alias("ord"), F.concat(F.lit("Topic "), (F.col("rank") % 11).cast("string")).alias("title"), F.col("slide_title").alias("description"), "citation", "rank")
    return topics.merge_topics(c, ["source_id"], F.regexp_replace(F.lower("title"), "[^a-z0-9]", ""))


MERGED = "merged AS (SELECT source_id, 'topic' || (rank % 11) AS key, 'Topic ' || (rank % 11) AS title, arg_min(slide_title, rank) AS description, list(citation ORDER BY rank) AS citations, min(rank) AS first FROM doc GROUP BY source_id, rank % 11)"


@query(f"WITH {DOC}, {MERGED} SELECT * FROM merged")
def topic_merge(spark, sf):
    return _merged(spark, sf)


@query(f"""WITH {DOC}, {MERGED}, r AS (SELECT *, count(*) OVER (PARTITION BY source_id) AS n, row_number() OVER (PARTITION BY source_id ORDER BY first, key) AS place FROM merged),
x AS (SELECT source_id, place, CASE WHEN n > 4 AND place >= 4 THEN 4 ELSE place END AS slot, CASE WHEN n > 4 AND place >= 4 THEN 'Further evidence' ELSE title END AS title, unnest(citations) AS c, generate_subscripts(citations, 1) AS i FROM r)
SELECT source_id, CAST(slot AS INTEGER) AS slot, min(title) AS title, list(c ORDER BY place, i) AS citations FROM x GROUP BY source_id, slot""")
def topk_overflow(spark, sf):
    return topics.with_overflow(_merged(spark, sf), ["source_id"], 4).select("source_id", F.col("slot").cast("int").alias("slot"), "title", "citations")


@query(f"WITH {DOC} SELECT source_id, citation, slide_number, rank FROM doc WHERE rank % 11 >= 5")
def uncovered_topics(spark, sf):
    return topics.uncovered(views.blocks_doc(spark, sf), _merged(spark, sf).where("key in ('topic0','topic1','topic2','topic3','topic4')"))


@query("""SELECT s.source_id, coalesce(p.ids, []) AS page_ids, coalesce(e.ids, []) AS entity_ids, p.ids IS NOT NULL AS covered FROM (SELECT DISTINCT source AS source_id FROM documents) s
LEFT JOIN (SELECT source AS source_id, list_sort(list(DISTINCT lang)) AS ids FROM documents JOIN labels USING (doc_id) WHERE toxic = 1 GROUP BY 1) p USING (source_id)
LEFT JOIN (SELECT source AS source_id, list_sort(list(DISTINCT lang || '-low')) AS ids FROM documents JOIN labels USING (doc_id) WHERE quality = 0 GROUP BY 1) e USING (source_id)""")
def coverage_rollup(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    pages = d.where("toxic = 1").select(F.col("lang").alias("id"), F.col("source").alias("source_id"))
    entities = d.where("quality = 0").select(F.concat("lang", F.lit("-low")).alias("id"), F.col("source").alias("source_id"))
    return topics.coverage(table(spark, sf, "documents").select(F.col("source").alias("source_id")), pages, entities)


@query("SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, CASE WHEN d.doc_id IS NULL THEN 'extra' ELSE 'missing' END AS side FROM documents d FULL JOIN labels l ON d.doc_id = l.doc_id WHERE d.doc_id IS NULL OR l.doc_id IS NULL")
def coverage_reconcile(spark, sf):
    return topics.reconcile(table(spark, sf, "documents"), table(spark, sf, "labels"), ["doc_id"])


@query("""WITH d AS (SELECT doc_id, source AS source_id, 'c' || doc_id AS citation, doc_id % 3 = 0 AS has_request FROM documents)
SELECT doc_id AS topic_id, source_id, citation FROM d UNION SELECT t.doc_id, t.source_id, b.citation FROM d t JOIN d b USING (source_id) WHERE NOT t.has_request AND b.has_request""")
def topic_expand(spark, sf):
    """A topic for every document, over whole sources; the rows are topics times request citations of their source.

    Sources follow doc_id % 20, so that doc_id % 4 is one value in a source and would never expand; doc_id % 3 does.
    """
    d = table(spark, sf, "documents").select(F.col("source").alias("source_id"), F.concat(F.lit("c"), F.col("doc_id").cast("string")).alias("citation"), (F.col("doc_id") % 3 == 0).alias("has_request"), "doc_id")
    return topics.expand_citations(d.select(F.col("doc_id").alias("topic_id"), "source_id", "citation"), d.drop("doc_id"))


@query("""WITH r AS (SELECT o_custkey % 97 AS record_id, o_orderkey AS source_id, l_linenumber AS citation, l_partkey AS value, l_returnflag = 'R' AS own FROM orders JOIN lineitem ON l_orderkey = o_orderkey),
o AS (SELECT DISTINCT record_id, source_id, value FROM r WHERE own)
SELECT * FROM o UNION SELECT DISTINCT r.record_id, r.source_id, -r.source_id FROM r ANTI JOIN o ON o.record_id = r.record_id AND o.source_id = r.source_id""")
def fallback_lineage(spark, sf):
    """Lines whose order is missing meet no record, so numbers come from lines and orders as they are."""
    orders, lines = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    n = tasks(lines)
    r = dealt(orders, n, "o_orderkey").join(dealt(lines, n, "l_orderkey"), F.col("o_orderkey") == F.col("l_orderkey"))
    r = r.select((F.col("o_custkey") % 97).alias("record_id"), F.col("o_orderkey").alias("source_id"), F.col("l_linenumber").alias("citation"))
    own = lines.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("source_id"), F.col("l_linenumber").alias("citation"), F.col("l_partkey").alias("value"))
    return topics.lineage(r, own, orders.select(F.col("o_orderkey").alias("source_id"), (-F.col("o_orderkey")).alias("value")), n=n)


TOKENS = """tk AS (SELECT c_nationkey AS chunk, 'c' || c_custkey AS citation, c_custkey % 7 = 0 AS request, c_custkey % 3 = 0 AS token FROM customer)"""


def _tokens(spark, sf):
    some = lambda flag: F.when(flag, F.array(F.lit("x"))).otherwise(F.array().cast("array<string>"))
    return table(spark, sf, "customer").select(F.col("c_nationkey").alias("chunk"), F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("citation"), some(F.col("c_custkey") % 7 == 0).alias("requests"), some(F.col("c_custkey") % 3 == 0).alias("tokens"))


@query(f"WITH {TOKENS} SELECT chunk, list(citation ORDER BY CASE WHEN request THEN 0 ELSE 1 END, CASE WHEN token THEN 0 ELSE 1 END, citation) AS citations FROM tk GROUP BY 1")
def citation_priority(spark, sf):
    return topics.allowed_citations(_tokens(spark, sf), "chunk")


@query(f"WITH {TOKENS} SELECT chunk, list_slice(list(citation ORDER BY CASE WHEN request THEN 0 ELSE 1 END, CASE WHEN token THEN 0 ELSE 1 END, citation), 1, 8) AS citations FROM tk GROUP BY 1")
def citation_limit(spark, sf):
    """The feature is the limit: a chunk's first eight."""
    return topics.allowed_citations(_tokens(spark, sf), "chunk", 8)


@query("""SELECT o_orderkey AS topic_id FROM orders WHERE o_orderkey % 40 IN (o_custkey % 11, o_custkey % 13) AND o_orderkey % 5 <> 4""")
def title_grounding(spark, sf):
    """Topics whose title claims a number, and evidence that has two; some cite nothing that is there."""
    o = table(spark, sf, "orders")
    source = F.concat(F.lit("s"), (F.col("o_orderkey") % 17).cast("string"))
    cited = lambda n: F.concat(F.col("o_orderkey").cast("string"), F.lit(f"-{n}"))
    t = o.select(F.col("o_orderkey").alias("topic_id"), source.alias("source_id"), F.concat(F.lit("Run "), (F.col("o_orderkey") % 40).cast("string"), F.lit(" of it")).alias("title"), F.when(F.col("o_orderkey") % 5 == 4, F.array(F.lit("gone"))).otherwise(F.array(cited(1), cited(2))).alias("citations"))
    facts = [o.select(source.alias("source_id"), cited(n).alias("citation"), F.array((F.col("o_custkey") % m).cast("string")).alias("numbers")) for n, m in ((1, 11), (2, 13))]
    return topics.grounded_titles(t, facts[0].union(facts[1])).select("topic_id")


@query("""SELECT 0 AS pass_no, s_name AS name, CAST(NULL AS VARCHAR) AS type FROM supplier UNION ALL SELECT 1, p_name, p_type FROM part""")
def candidate_union(spark, sf):
    return topics.all_candidates(table(spark, sf, "supplier").select(F.col("s_name").alias("name")), table(spark, sf, "part").select(F.col("p_type").alias("type"), F.col("p_name").alias("name")))


@query("SELECT page_id, 'occurrence-' || left(sha256(lower(url)), 16) AS id, 'cannot read ' || regexp_extract(url, '[^/]*$') || ' twice: ' || regexp_extract(url, '[^/]*$') AS message FROM pages")
def occurrence_ids(spark, sf):
    """Paths as ids, and messages that name files without their folders."""
    p = table(spark, sf, "pages")
    message = F.concat(F.lit("cannot read "), "url", F.lit(" twice: "), "url")
    return p.select("page_id", C.occurrence_id(F.col("url")).alias("id"), C.without_paths(message, F.array("url")).alias("message"))


# ---- tables and geometry


@query("""WITH l AS (SELECT l_orderkey AS table_id, string_agg('| ' || l_linenumber || ' | ' || l_partkey || ' | ' || l_returnflag || ' |', chr(10) ORDER BY l_linenumber, CAST(l_partkey AS VARCHAR), l_returnflag) AS body FROM lineitem GROUP BY 1)
SELECT table_id, '| line | part | flag |' || chr(10) || '| --- | --- | --- |' || chr(10) || body AS markdown FROM l""")
def gfm_table(spark, sf):
    return views.order_tables(spark, sf).select("table_id", C.pipe_table(F.col("matrix")).alias("markdown"))


@query(f"""WITH {GEO} SELECT slide_number, element_id, CAST(round(x * 1000000.0 / {SLIDE_WIDTH}) AS BIGINT) AS left_ppm, CAST(round(y * 1000000.0 / {SLIDE_HEIGHT}) AS BIGINT) AS top_ppm,
CAST(round((x + width) * 1000000.0 / {SLIDE_WIDTH}) AS BIGINT) AS right_ppm, CAST(round((y + height) * 1000000.0 / {SLIDE_HEIGHT}) AS BIGINT) AS bottom_ppm FROM geo""")
def bbox_normalized(spark, sf):
    g = views.elements_geo(spark, sf)
    box = C.bbox_normalized(F.col("x"), F.col("y"), F.col("width"), F.col("height"), F.lit(SLIDE_WIDTH), F.lit(SLIDE_HEIGHT))
    return g.select("slide_number", "element_id", *(F.round(box[i] * 1000000).cast("long").alias(f"{n}_ppm") for i, n in enumerate(("left", "top", "right", "bottom"))))


@query(f"WITH {GEO} SELECT slide_number, element_id FROM geo WHERE x < 0 OR y < 0 OR x + width > {SLIDE_WIDTH} OR y + height > {SLIDE_HEIGHT}")
def outside_slide(spark, sf):
    return geometry.outside_slide(views.elements_geo(spark, sf), SLIDE_WIDTH, SLIDE_HEIGHT).select("slide_number", "element_id")


OVERLAP = """o AS (SELECT a.slide_number, a.element_id AS a_element_id, b.element_id AS b_element_id, a.text AS a_text, b.text AS b_text FROM geo a JOIN geo b ON a.slide_number = b.slide_number AND a.source = 'native' AND b.source = 'ocr'
WHERE greatest(least(a.x + a.width, b.x + b.width) - greatest(a.x, b.x), 0) * greatest(least(a.y + a.height, b.y + b.height) - greatest(a.y, b.y), 0) >= 0.75 * least(a.width * a.height, b.width * b.height))"""


@query(f"WITH {GEO}, {OVERLAP} SELECT * FROM o")
def overlap_pairs(spark, sf):
    return geometry.overlaps(views.elements_geo(spark, sf))


@query(f"WITH {GEO}, {OVERLAP} SELECT slide_number, a_element_id, b_element_id, [a_text] AS a_numbers, [b_text] AS b_numbers FROM o WHERE a_text <> b_text")
def overlap_conflict(spark, sf):
    found = geometry.numeric_conflicts(geometry.overlaps(views.elements_geo(spark, sf)), geometry.raw_numbers)
    return found.select("slide_number", "a_element_id", "b_element_id", "a_numbers", "b_numbers")


@query(f"""WITH {GEO} SELECT slide_number, element_id, x AS "left", y AS top, x + width AS "right", y + height AS bottom, width + 48 AS model_width, height + 48 AS model_height, x - 24 AS model_left, y - 24 AS model_top FROM geo""")
def model_images(spark, sf):
    g = views.elements_geo(spark, sf)
    crops = g.select("slide_number", "element_id", F.col("x").alias("left"), F.col("y").alias("top"), (F.col("x") + F.col("width")).alias("right"), (F.col("y") + F.col("height")).alias("bottom"))
    return geometry.model_images(crops)


@query(f"""WITH {GEO}, {OVERLAP} SELECT 'numeric-conflict' AS check_code, 'error' AS severity, slide_number || '/' || a_element_id || '/' || b_element_id AS key, a_text || '|' || b_text AS detail FROM o WHERE a_text <> b_text
UNION ALL SELECT 'element-outside-slide', 'warning', slide_number || '/' || element_id, NULL FROM geo WHERE x < 0 OR y < 0 OR x + width > {SLIDE_WIDTH} OR y + height > {SLIDE_HEIGHT}
UNION ALL SELECT 'duplicate-element-id', 'error', slide_number || '/' || element_id, CAST(count(*) AS VARCHAR) FROM geo GROUP BY slide_number, element_id HAVING count(*) > 1""")
def slide_checks(spark, sf):
    return checks.slide_checks(views.elements_geo(spark, sf), SLIDE_WIDTH, SLIDE_HEIGHT)


@query(f"""WITH {GEO}, p AS (SELECT a.slide_number, a.element_id, a.x AS x1, a.y AS y1, a.x + a.width AS x2, a.y + a.height AS y2, b.x AS u1, b.y AS v1, b.x + b.width AS u2, b.y + b.height AS v2, a.element_id <> b.element_id AS other FROM geo a JOIN geo b USING (slide_number)),
m AS (SELECT slide_number, element_id, x1, y1, x2, y2, max(CASE WHEN other AND least(y2, v2) > greatest(y1, v1) AND u2 <= x1 THEN CAST(ceil((u2 + x1) / 2.0) AS BIGINT) END) AS l, min(CASE WHEN other AND least(y2, v2) > greatest(y1, v1) AND u1 >= x2 THEN CAST(floor((x2 + u1) / 2.0) AS BIGINT) END) AS r,
max(CASE WHEN other AND least(x2, u2) > greatest(x1, u1) AND v2 <= y1 THEN CAST(ceil((v2 + y1) / 2.0) AS BIGINT) END) AS t, min(CASE WHEN other AND least(x2, u2) > greatest(x1, u1) AND v1 >= y2 THEN CAST(floor((y2 + v1) / 2.0) AS BIGINT) END) AS b FROM p GROUP BY ALL)
SELECT slide_number, element_id, least(x1, greatest(x1 - 1219200, 0, coalesce(l, 0))) AS "left", least(y1, greatest(y1 - 685800, 0, coalesce(t, 0))) AS top, greatest(x2, least(x2 + 1219200, {SLIDE_WIDTH}, coalesce(r, {SLIDE_WIDTH}))) AS "right", greatest(y2, least(y2 + 685800, {SLIDE_HEIGHT}, coalesce(b, {SLIDE_HEIGHT}))) AS bottom FROM m""")
def midgap_crop(spark, sf):
    return geometry.midgap_crops(views.elements_geo(spark, sf), SLIDE_WIDTH, SLIDE_HEIGHT)


@query(f"""WITH {GEO} SELECT slide_number, element_id, least(greatest(CAST(floor(x * 4000 / {SLIDE_WIDTH}.0) AS BIGINT), 0), 4000) AS "left", least(greatest(CAST(floor(y * 2250 / {SLIDE_HEIGHT}.0) AS BIGINT), 0), 2250) AS top,
least(greatest(CAST(ceil((x + width) * 4000 / {SLIDE_WIDTH}.0) AS BIGINT), 0), 4000) AS "right", least(greatest(CAST(ceil((y + height) * 2250 / {SLIDE_HEIGHT}.0) AS BIGINT), 0), 2250) AS bottom FROM geo""")
def emu_to_px(spark, sf):
    g = views.elements_geo(spark, sf)
    box = C.emu_to_pixels(F.col("x"), F.col("y"), F.col("width"), F.col("height"), F.lit(SLIDE_WIDTH), F.lit(SLIDE_HEIGHT), F.lit(4000), F.lit(2250))
    return g.select("slide_number", "element_id", box.alias("b")).select("slide_number", "element_id", "b.*")


@query(f"""WITH {GEO}, p AS (SELECT a.slide_number AS image, a.element_id AS block_id, b.element_id AS box_id, a.text AS la, b.text AS lb, greatest(least(a.x + a.width, b.x + b.width) - greatest(a.x, b.x), 0) * greatest(least(a.y + a.height, b.y + b.height) - greatest(a.y, b.y), 0) AS i,
a.width * a.height AS m, b.width * b.height AS n FROM geo a JOIN geo b ON a.slide_number = b.slide_number AND a.source = 'native' AND b.source = 'ocr'),
q AS (SELECT image, block_id, box_id, i / CAST(m + n - i AS DOUBLE) + CASE WHEN la = lb THEN 0.05 ELSE 0.0 END AS quality FROM p)
SELECT image, block_id, box_id FROM q WHERE quality >= 0.5 QUALIFY row_number() OVER (PARTITION BY image, block_id ORDER BY quality DESC, box_id) = 1""")
def iou_best(spark, sf):
    g = views.elements_geo(spark, sf).select(F.col("slide_number").alias("image"), "element_id", F.col("text").alias("label"), F.array("x", "y", F.col("x") + F.col("width"), F.col("y") + F.col("height")).cast("array<double>").alias("box"), "source")
    found = geometry.best_matches(g.where("source = 'native'").withColumnRenamed("element_id", "block_id"), g.where("source = 'ocr'").withColumnRenamed("element_id", "box_id"))
    return found.select("image", "block_id", "box_id")


# ---- text


@query()
def number_tokens(spark, sf):
    """Numbers that touch no letter or digit; the SQL at hand has no look-around."""
    return table(spark, sf, "documents").select("doc_id", F.explode(F.array_distinct(geometry.raw_numbers(F.col("text")))).alias("number"))


@query()
def prose_number_tokens(spark, sf):
    """Numbers of prose by the kernel; rows without a digit never reach Python."""
    return table(spark, sf, "documents").where(F.col("text").rlike(r"\d")).select("doc_id", F.explode(call("prose_numbers", "text")).alias("number"))


@query(r"""WITH t AS (SELECT doc_id, unnest(m) AS token, generate_subscripts(m, 1) AS n FROM (SELECT doc_id, regexp_extract_all(text, '(?i)(?:^|[^A-Z0-9])([A-Z]{2,8}[ \t_-]+[A-Z0-9][A-Z0-9._/\-]{0,63})', 1) AS m FROM documents))
SELECT doc_id, arg_min(token, n) AS token FROM t GROUP BY doc_id, lower(token)""")
def identifier_tokens(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.explode(call("identifiers", "text")).alias("token"))


@query("SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS line_no, unnest(string_split(text, chr(10))) AS line FROM documents")
def line_explode(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("i", "line")).select("doc_id", (F.col("i") + 1).cast("long").alias("line_no"), "line")


@query("""SELECT doc_id, lower(trim(regexp_replace(regexp_replace(lang || ' / ' || source, '[^a-z0-9._-]+', '-', 'g'), '[-_.]{2,}', '-', 'g'), '-._')) AS slug FROM documents""")
def page_slugs(spark, sf):
    return table(spark, sf, "documents").select("doc_id", call("page_slug", F.concat("lang", F.lit(" / "), "source")).alias("slug"))


@query("SELECT doc_id, sha256(trim(regexp_replace(nfc_normalize(text), '[ ]+\n', '\n', 'g'), ' \n\t')) AS digest FROM documents")
def normalised_digest(spark, sf):
    return table(spark, sf, "documents").select("doc_id", C.sha256(call("normalise_text", "text")).alias("digest"))


@query("SELECT doc_id, left(trim(regexp_replace(text, '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g'), ' '), 500) AS description FROM documents")
def descriptions(spark, sf):
    return table(spark, sf, "documents").select("doc_id", C.description(F.col("text")).alias("description"))


def _fragments_sql(limit: int) -> str:
    """CTEs d (source_id, doc_id, t), p (doc_id, k, body): fragments by whole lines, one line after the other; longer lines are cut."""
    long, fits = f"length(line) > {limit}", f"held > 0 AND held + length(line) <= {limit}"
    pieces = f"(length(line) + {limit - 1}) // {limit}"
    return f"""d AS (SELECT source AS source_id, doc_id, coalesce(text, '') AS t FROM documents),
l AS (SELECT doc_id, unnest(p) AS line, generate_subscripts(p, 1) AS n FROM (SELECT doc_id, regexp_extract_all(t, '[^\\n]*\\n|[^\\n]+') AS p FROM d WHERE length(t) > {limit})),
r AS (SELECT doc_id, n, CASE WHEN {long} THEN 0 ELSE length(line) END AS held, 1 AS f, {pieces} AS last FROM l WHERE n = 1
UNION ALL SELECT l.doc_id, l.n, CASE WHEN {long} THEN 0 WHEN {fits} THEN held + length(line) ELSE length(line) END,
CASE WHEN {fits} THEN last ELSE last + 1 END, CASE WHEN {long} THEN last + {pieces} WHEN {fits} THEN last ELSE last + 1 END FROM r JOIN l ON l.doc_id = r.doc_id AND l.n = r.n + 1),
p AS (SELECT doc_id, f AS k, rtrim(string_agg(line, '' ORDER BY n), chr(10)) AS body FROM r JOIN l USING (doc_id, n) WHERE NOT {long} GROUP BY doc_id, f
UNION ALL SELECT doc_id, f + i, rtrim(substr(line, i * {limit} + 1, {limit}), chr(10)) FROM (SELECT doc_id, f, line, unnest(range(0, {pieces})) AS i FROM r JOIN l USING (doc_id, n) WHERE {long})
UNION ALL SELECT doc_id, 1, t FROM d WHERE length(t) <= {limit})"""


@query(f"WITH RECURSIVE {_fragments_sql(500)} SELECT doc_id, CAST(k AS INTEGER) AS position, body AS fragment FROM p")
def fragment_split(spark, sf):
    """Fragments of at most 500 characters by the table function, called from SQL."""
    from evispark.functions import udfs

    udfs.register(spark)
    table(spark, sf, "documents").createOrReplaceTempView("_split")
    return spark.sql("SELECT d.doc_id, s.position, s.fragment FROM _split d, LATERAL split_text(d.text, 500) s")


@query(f"""WITH RECURSIVE {_fragments_sql(1908)},
o AS (SELECT source_id, doc_id, k, 60 + length(body) AS s, row_number() OVER (PARTITION BY source_id ORDER BY doc_id, k) AS n FROM p JOIN d USING (doc_id)),
w AS (SELECT source_id, n, 1 AS chunk, s AS used FROM o WHERE n = 1 UNION ALL SELECT o.source_id, o.n, CASE WHEN used + 2 + s > 2000 THEN chunk + 1 ELSE chunk END, CASE WHEN used + 2 + s > 2000 THEN s ELSE used + 2 + s END FROM w JOIN o ON o.source_id = w.source_id AND o.n = w.n + 1)
SELECT source_id, doc_id AS rank, CAST(k AS INTEGER) AS fragment, CAST(chunk AS BIGINT) AS chunk FROM o JOIN w USING (source_id, n)""")
def chunk_pack(spark, sf):
    return chunks.chunk_blocks(views.blocks_doc(spark, sf), 2000, header=60)


@query("""WITH RECURSIVE d AS (SELECT source AS source_id, coalesce(length(text), 0) AS s, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n FROM documents),
w AS (SELECT source_id, n, 1 AS chunk, s AS used FROM d WHERE n = 1 UNION ALL SELECT d.source_id, d.n, CASE WHEN w.used > 0 AND w.used + 2 + d.s > 131072 THEN w.chunk + 1 ELSE w.chunk END,
CASE WHEN w.used > 0 AND w.used + 2 + d.s > 131072 THEN d.s ELSE w.used + d.s + CASE WHEN w.used > 0 THEN 2 ELSE 0 END END FROM w JOIN d ON d.source_id = w.source_id AND d.n = w.n + 1)
SELECT source_id, count(*) AS fragments, CAST(max(chunk) AS BIGINT) AS chunks FROM w GROUP BY 1""")
def chunk_summary(spark, sf):
    """How many chunks a source fills under a budget that holds any one document."""
    c = chunks.chunk_blocks(views.blocks_doc(spark, sf), 131_072)
    return c.groupBy("source_id").agg(F.count("*").alias("fragments"), F.max("chunk").alias("chunks"))


# ---- graph


@query(r"""WITH d AS (SELECT doc_id, ' ' || regexp_replace(lower(text), '[\x20\x09-\x0D]+', ' ', 'g') || ' ' AS t FROM documents), b AS (SELECT item_id, ' ' || trim(regexp_replace(lower(text), '[\x20\x09-\x0D]+', ' ', 'g')) || ' ' AS t FROM benchmark)
SELECT d.doc_id AS text_id, b.item_id AS name_id FROM d JOIN b ON contains(d.t, b.t) WHERE trim(b.t) <> ''""")
def entity_contains(spark, sf):
    return graph.contained(table(spark, sf, "documents").select(F.col("doc_id").alias("text_id"), "text"), table(spark, sf, "benchmark").select(F.col("item_id").alias("name_id"), F.col("text").alias("name")))


@query("""WITH c AS (SELECT p_partkey AS ord, p_type AS name, lower(p_brand) AS key, CASE WHEN p_size % 3 = 0 THEN 'lot' WHEN p_size % 3 = 1 THEN 'other' ELSE 'product' END AS type, p_name AS description, 'c' || p_partkey AS citation FROM part),
b AS (SELECT key, CASE WHEN count(*) FILTER (type = 'lot') > 0 THEN 'lot' ELSE min(type) END AS best FROM c GROUP BY key),
f AS (SELECT c.*, b.best, row_number() OVER (PARTITION BY c.key ORDER BY c.type <> b.best, ord) AS n FROM c JOIN b USING (key)),
h AS (SELECT key, best AS type, name, description FROM f WHERE n = 1),
names AS (SELECT key, name, min(ord) AS o FROM c GROUP BY ALL)
SELECT h.key, h.type, h.name, h.description, coalesce((SELECT list(n.name ORDER BY n.o) FROM names n WHERE n.key = h.key AND n.name <> h.name), []) AS aliases, (SELECT list(c.citation ORDER BY c.ord) FROM c WHERE c.key = h.key) AS citations FROM h""")
def entity_merge(spark, sf):
    kind = F.when(F.col("p_size") % 3 == 0, "lot").when(F.col("p_size") % 3 == 1, "other").otherwise("product")
    c = table(spark, sf, "part").select(F.col("p_partkey").alias("ord"), F.col("p_type").alias("name"), "p_brand", kind.alias("type"), F.col("p_name").alias("description"), F.concat(F.lit("c"), F.col("p_partkey").cast("string")).alias("citation"))
    return graph.merge_entities(c, F.lower("p_brand"))


@query("""SELECT c_custkey AS mention_id, min(s_suppkey) AS entity_id FROM customer JOIN supplier ON c_nationkey = s_nationkey AND c_custkey % 10 = s_suppkey % 10 GROUP BY 1 HAVING count(*) = 1""")
def alias_resolve(spark, sf):
    """Mentions of suppliers by nation, which many suppliers share."""
    m = table(spark, sf, "customer").select(F.col("c_custkey").alias("mention_id"), F.col("c_nationkey").cast("string").alias("key"), F.lit("s").alias("source_id"), F.array(F.col("c_custkey") % 10).alias("citations"))
    e = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("entity_id"), F.array(F.col("s_nationkey").cast("string"), F.col("s_name")).alias("keys"), F.lit("s").alias("source_id"), F.array(F.col("s_suppkey") % 10).alias("citations"))
    return graph.resolve_aliases(m, e)


def _edges(spark, sf):
    t = table(spark, sf, "lineitem")
    return graph.merge_edges(t.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"), F.col("l_returnflag").alias("predicate"), F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("subject"), F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("object"), F.lit("").alias("assertion"), F.col("l_linestatus").alias("description"), F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("citation")))


EDGES = """edges AS (SELECT 'rel-' || left(sha256(l_returnflag || chr(31) || 's' || l_suppkey || chr(31) || 'p' || l_partkey || chr(31)), 20) AS id, l_returnflag AS predicate, 's' || l_suppkey AS subject, 'p' || l_partkey AS object,
arg_min(l_linestatus, l_orderkey * 10 + l_linenumber) AS description, list_distinct(list('o' || l_orderkey)) AS citations FROM lineitem GROUP BY l_returnflag, l_suppkey, l_partkey)"""


@query(f"WITH {EDGES} SELECT id, predicate, subject, object, description, list_sort(citations) AS citations FROM edges")
def edge_merge(spark, sf):
    return _edges(spark, sf).withColumn("citations", F.array_sort("citations"))


@query(f"WITH {EDGES} SELECT subject AS node, 'out' AS direction, predicate, object AS other FROM edges UNION ALL SELECT object, 'in', predicate, subject FROM edges")
def edge_incidence(spark, sf):
    return graph.incidence(_edges(spark, sf))


@query(f"""WITH {EDGES}, ends AS (SELECT id, unnest([subject, object]) AS node, citations FROM edges), known AS (SELECT 'p' || l_partkey AS id, list(DISTINCT 'o' || l_orderkey) AS theirs FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
SELECT DISTINCT CASE WHEN k.id IS NULL THEN 'unknown-endpoint' ELSE 'no-shared-citation' END AS check_code, e.id FROM ends e LEFT JOIN known k ON k.id = e.node WHERE k.id IS NULL OR NOT list_has_any(e.citations, k.theirs)""")
def edge_lineage_violations(spark, sf):
    """Edges of suppliers and parts, of which only returned parts are known, with the orders that returned them."""
    returned = table(spark, sf, "lineitem").where("l_returnflag = 'R'")
    known = returned.groupBy(F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("id")).agg(F.collect_set(F.concat(F.lit("o"), F.col("l_orderkey").cast("string"))).alias("citations"))
    return graph.edge_violations(_edges(spark, sf), known)


@query(f"""WITH pk AS (SELECT * FROM (VALUES ('uses_material', 'material'), ('has_lot', 'lot'), ('related_to', NULL)) t(predicate, kind)),
f AS (SELECT o_orderkey AS ord, CASE o_orderkey % 4 WHEN 0 THEN 'uses_material' WHEN 1 THEN 'has_lot' WHEN 2 THEN 'related_to' ELSE 'likes' END AS predicate, o_custkey % 10 + 1 AS s, o_custkey % 1009 AS name, o_orderkey % 7 AS c, o_orderkey % 50 AS q,
CASE o_orderkey % 5 WHEN 1 THEN ' of PR-' || o_custkey % 7 WHEN 2 THEN ' in PX-' || o_orderkey % 7 ELSE '' END AS tail, o_custkey % 7 AS claimed, o_orderkey % 5 AS v, o_orderpriority AS d FROM orders),
g AS (SELECT f.*, pk.kind FROM f JOIN pk USING (predicate) WHERE q <= 40 AND c < 5 AND s IN (SELECT s_suppkey FROM supplier) AND (v <> 1 OR claimed = c) AND (v <> 2 OR c % 2 = 0)),
e AS (SELECT p_partkey AS id, p_partkey % 1009 AS name, p_partkey % 7 AS c, CASE p_size % 3 WHEN 0 THEN 'lot' WHEN 1 THEN 'material' ELSE 'other' END AS type FROM part),
o AS (SELECT g.ord, count(*) FILTER (e.type = g.kind) AS liked, min(e.id) FILTER (e.type = g.kind) AS liked_id, count(*) AS n, min(e.id) AS id FROM g JOIN e ON e.name = g.name AND e.c = g.c GROUP BY 1),
r AS (SELECT g.*, CASE WHEN o.liked > 0 THEN o.liked_id ELSE o.id END AS object FROM g JOIN o USING (ord) WHERE CASE WHEN o.liked > 0 THEN o.liked = 1 ELSE o.n = 1 END),
k AS (SELECT predicate, s, object, q, tail, arg_min(d, ord) AS description, list_sort(list(DISTINCT 'c' || c)) AS citations FROM r GROUP BY ALL)
SELECT 'rel-' || left(sha256(predicate || chr(31) || 'entity:s' || s || chr(31) || 'entity:p' || object || chr(31) || 'holds ' || q || ' units' || lower(tail)), 20) AS id, predicate, 'entity:s' || s AS subject, 'entity:p' || object AS object, 'Holds ' || q || ' units' || tail AS assertion, description, citations, list_transform(citations, lambda x: 'PR-' || substr(x, 2)) AS requests FROM k""")
def edge_resolve(spark, sf):
    """Relationships of suppliers to parts by name: unknown predicates, ungrounded numbers, borrowed and changed request numbers,
    ambiguous ends and citations without a request drop out."""
    t, by, v = table(spark, sf, "orders"), F.col("o_orderkey") % 4, F.col("o_orderkey") % 5
    predicate = F.when(by == 0, "uses_material").when(by == 1, "Has_Lot ").when(by == 2, "related_to").otherwise("likes")
    name = lambda c: F.concat(F.lit("c"), c.cast("string"))
    number = lambda c, of: (c % of).cast("string")
    tail = F.when(v == 1, F.concat(F.lit(" of PR-"), number(F.col("o_custkey"), 7))).when(v == 2, F.concat(F.lit(" in PX-"), number(F.col("o_orderkey"), 7))).otherwise("")
    words = F.concat(F.lit("Holds "), number(F.col("o_orderkey"), 50), F.lit(" units"), tail)
    found = t.select(F.col("o_orderkey").alias("ord"), F.lit("s").alias("source_id"), predicate.alias("predicate"), F.concat(F.lit("Supplier "), (F.col("o_custkey") % 10 + 1).cast("string")).alias("subject"), F.lit(None).cast("string").alias("subject_type"), F.concat(F.lit("Item  "), number(F.col("o_custkey"), 1009)).alias("object"), F.lit(None).cast("string").alias("object_type"), words.alias("assertion"), F.col("o_orderpriority").alias("description"), F.array(name(F.col("o_orderkey") % 7), F.lit("nowhere")).alias("citations"))
    supplier = table(spark, sf, "supplier").select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("entity_id"), F.lit("organization").alias("type"), F.array(F.concat(F.lit("supplier "), F.col("s_suppkey").cast("string"))).alias("keys"), F.lit("s").alias("source_id"), F.transform(F.sequence(F.lit(0), F.lit(6)), name).alias("citations"))
    kind = F.when(F.col("p_size") % 3 == 0, "lot").when(F.col("p_size") % 3 == 1, "material").otherwise("other")
    part = table(spark, sf, "part").select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")), kind, F.array(F.concat(F.lit("item "), number(F.col("p_partkey"), 1009))), F.lit("s"), F.array(name(F.col("p_partkey") % 7)))
    no_requests = F.array().cast("array<struct<key:string,value:string>>")
    spelled = F.when(F.col("id") % 2 == 0, F.array(F.concat(F.lit("PX-"), F.col("id").cast("string")))).otherwise(F.array().cast("array<string>"))
    evidence = spark.range(7).select(F.lit("s").alias("source_id"), name(F.col("id")).alias("citation"), F.transform(F.sequence(F.lit(0), F.lit(40)), lambda n: n.cast("string")).alias("numbers"), F.when(F.col("id") < 5, F.array(F.struct(F.col("id").cast("string").alias("key"), F.concat(F.lit("PR-"), F.col("id").cast("string")).alias("value")))).otherwise(no_requests).alias("requests"), spelled.alias("identifiers"))
    out = graph.resolve_edges(found, supplier.union(part), evidence)
    return out.withColumn("citations", F.array_sort("citations")).withColumn("requests", F.array_sort("requests"))


@query("SELECT DISTINCT c_custkey AS page_id, s_suppkey AS entity_id FROM customer JOIN supplier ON c_nationkey = s_nationkey")
def shared_sources(spark, sf):
    pages = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("source_id"))
    return graph.shared_sources(pages, table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("source_id")))


@query("""WITH c AS (SELECT DISTINCT 'd' || o_orderkey AS key, 's' || (o_custkey % 3) AS source_id, unnest(['c' || o_custkey, 'c' || (o_custkey + 300)]) AS citation FROM orders),
b AS (SELECT 's' || (c_custkey % 3) AS source_id, 'c' || c_custkey AS citation, c_custkey % 10 + 1 AS slide_number FROM customer),
j AS (SELECT c.*, b.slide_number FROM c LEFT JOIN b USING (source_id, citation))
SELECT CASE WHEN slide_number IS NULL THEN 'unknown-citation' ELSE 'slide-page-missing' END AS check_code, 'error' AS severity, key, citation AS detail FROM j WHERE slide_number IS NULL OR slide_number > 8""")
def document_violations(spark, sf):
    """Documents of orders that cite their customer and another one: some cite none, some a slide without page."""
    cite = lambda c: F.concat(F.lit("c"), c.cast("string"))
    source = lambda c: F.concat(F.lit("s"), (c % 3).cast("string"))
    who = F.col("o_custkey")
    docs = table(spark, sf, "orders").select(F.concat(F.lit("d"), F.col("o_orderkey").cast("string")).alias("document_id"), source(who).alias("source_id"), F.array(cite(who), cite(who + 300)).alias("citations"))
    blocks = table(spark, sf, "customer").select(source(F.col("c_custkey")).alias("source_id"), cite(F.col("c_custkey")).alias("citation"), (F.col("c_custkey") % 10 + 1).alias("slide_number"))
    return artifacts.documents(docs, blocks, blocks.where("slide_number <= 8").select("source_id", "slide_number").distinct())


# ---- links and pages

RESERVED = ", ".join(f"('{name}')" for name in links.RESERVED_SLUGS)


@query(f"""WITH v AS (SELECT p_partkey, lower(CASE p_partkey % 50 WHEN 0 THEN 'index' WHEN 1 THEN 'Con' ELSE replace(p_type, ' ', '-') END) AS base FROM part),
n AS (SELECT p_partkey, base, row_number() OVER (PARTITION BY base ORDER BY lpad(CAST(p_partkey AS VARCHAR), 12, '0')) + CASE WHEN base IN (SELECT * FROM (VALUES {RESERVED}) r) THEN 1 ELSE 0 END AS n FROM v)
SELECT p_partkey, CASE WHEN n = 1 THEN base ELSE base || '-' || n END AS slug FROM n""")
def slug_numbers(spark, sf):
    p, by = table(spark, sf, "part"), F.col("p_partkey") % 50
    base = F.when(by == 0, "index").when(by == 1, "Con").otherwise(F.replace("p_type", F.lit(" "), F.lit("-")))
    values = p.select("p_partkey", base.alias("base"), F.lpad(F.col("p_partkey").cast("string"), 12, "0").alias("ord"))
    return links.numbered_slugs(values, "base", "ord").select("p_partkey", "slug")


HREFS = r"""found AS (SELECT page_id, unnest(regexp_extract_all(html, '(?i)<a\b[^>]*\bhref\s*=\s*["'']([^"'']*)["'']', 1)) AS href, generate_subscripts(regexp_extract_all(html, '(?i)<a\b[^>]*\bhref\s*=\s*["'']([^"'']*)["'']', 1), 1) - 1 AS position FROM pages)"""


@query(rf"""WITH {HREFS} SELECT page_id, CAST(position AS INTEGER) AS position, href, split_part(href, '#', 1) AS path, nullif(regexp_extract(href, '#(.*)$', 1), '') AS fragment, regexp_matches(href, '(?i)^(https?:|mailto:|data:)') AS external FROM found""")
def link_extract(spark, sf):
    return links.html_links(table(spark, sf, "pages"))


@query(rf"""WITH {HREFS} SELECT page_id, CAST(position AS INTEGER) AS position, href FROM found WHERE NOT regexp_matches(href, '(?i)^(https?:|mailto:|data:)') AND split_part(href, '#', 1) <> ''
AND split_part(href, '#', 1) NOT IN (SELECT regexp_replace(url, '^https?://[^/]*', '') FROM pages)""")
def dangling_links(spark, sf):
    p = table(spark, sf, "pages")
    return links.dangling(links.html_links(p), p.select(F.regexp_replace("url", "^https?://[^/]*", "").alias("path")))


@query(r"SELECT page_id FROM pages WHERE regexp_matches(html, '(?i)<\s*/?\s*(?:script|iframe|object|embed)\b|\son[a-z]+\s*=|javascript:')")
def dangerous_html(spark, sf):
    return table(spark, sf, "pages").where(C.is_dangerous(F.col("html"))).select("page_id")


@query()
def html_to_text(spark, sf):
    return table(spark, sf, "pages").select("page_id", call("plain_text", "html").alias("text"))


@query("""WITH b AS (SELECT DISTINCT url AS value, regexp_replace(url, '[0-9].*$', '') AS base FROM pages), n AS (SELECT base, count(*) AS n FROM b GROUP BY 1)
SELECT value, CASE WHEN n > 1 THEN base || '--' || left(sha256(value), 10) ELSE base END AS slug FROM b JOIN n USING (base)""")
def slug_collisions(spark, sf):
    return links.unique_slugs(table(spark, sf, "pages").select(F.col("url").alias("value")), F.regexp_replace("value", "[0-9].*$", ""))


@query("SELECT lower(lang) AS path_key, count(DISTINCT lang || doc_id % 2) AS n FROM documents GROUP BY 1")
def path_collisions(spark, sf):
    d = table(spark, sf, "documents").select(F.concat("lang", (F.col("doc_id") % 2).cast("string")).alias("path"), C.sha256(F.col("text")).alias("sha256"), "lang")
    return links.path_collisions(d, F.lower("lang"))


@query("SELECT n_name AS title, string_agg('- ' || s_name, chr(10) ORDER BY s_name) AS body FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1")
def listagg_pages(spark, sf):
    s = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return s.groupBy(F.col("n_name").alias("title")).agg(publish.lines(F.col("s_name"), F.col("s_name")).alias("body"))


@query("SELECT 'pages/' || page_id || '.html' AS path, sha256(html) AS sha256, CAST(strlen(html) AS BIGINT) AS bytes FROM pages")
def manifest_hashes(spark, sf):
    return publish.manifest(table(spark, sf, "pages").select(F.concat(F.lit("pages/"), F.col("page_id").cast("string"), F.lit(".html")).alias("path"), F.col("html").alias("body")))


@query(f"""WITH f AS (SELECT CAST(doc_id AS VARCHAR) AS name, sha256(text) AS d FROM documents), m AS (SELECT DISTINCT CAST(l.doc_id AS VARCHAR) AS name, sha256(coalesce({_CLEAN}, '')) AS d FROM labels l LEFT JOIN documents USING (doc_id) WHERE l.quality = 1 OR l.toxic = 1)
SELECT CASE WHEN m.name IS NULL THEN 'undeclared-file' WHEN f.name IS NULL THEN 'missing-file' ELSE 'digest-mismatch' END AS check_code, 'error' AS severity, coalesce(f.name, m.name) AS key, f.d AS detail FROM f FULL JOIN m USING (name) WHERE m.name IS NULL OR f.name IS NULL OR f.d <> m.d""")
def tamper_detect(spark, sf):
    """Documents as files against a manifest that lists the good or toxic labelled ones by their cleaned texts."""
    d = table(spark, sf, "documents")
    files = d.select(F.col("doc_id").cast("string").alias("name"), C.sha256(F.col("text")).alias("sha256"))
    labelled = table(spark, sf, "labels").where("quality = 1 or toxic = 1").select("doc_id")
    listed = labelled.join(d, "doc_id", "left").select(F.col("doc_id").cast("string").alias("name"), C.sha256(F.coalesce(_clean(F.col("text")), F.lit(""))).alias("sha256")).distinct()
    return checks.digest_checks(files, listed)


@query("SELECT event_type, count(*) AS n, count(*) FILTER (value BETWEEN 0 AND 1) AS clean, CAST(round(avg(value) FILTER (value BETWEEN 0 AND 1) * 1000) AS BIGINT) AS mean_permille FROM events GROUP BY 1")
def confidence_mean(spark, sf):
    e = table(spark, sf, "events").withColumn("c", C.clean_confidence(F.col("value").cast("string")))
    return e.groupBy("event_type").agg(F.count("*").alias("n"), F.count("c").alias("clean"), F.round(F.avg("c") * 1000).cast("long").alias("mean_permille"))


@query("SELECT s_suppkey, s_name FROM supplier ORDER BY lower(s_name), s_name, s_suppkey LIMIT 16")
def stable_sort_topk(spark, sf):
    return table(spark, sf, "supplier").select("s_suppkey", "s_name").orderBy(call("stable_key", "s_name"), "s_name", "s_suppkey").limit(16)


@query("SELECT event_id, ts, event_type, value FROM events")
def stream_dedupe(spark, sf):
    """The events table as a stream that has every event twice; each comes out once, written by a query that ends."""
    twice = ingest.event_stream(spark, sf).withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1)))).drop("copy")
    with_time = ingest.once(twice, ["event_id"])
    base = scratch(spark, "stream")
    ingest.run_once(with_time, f"{base}/out", f"{base}/marks")
    return spark.read.parquet(f"{base}/out").select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "event_type", "value")


# ---- artifacts, checks and pages


@query(f"""WITH {DOC}, d AS (SELECT doc.*, lang, n_chars, {_CLEAN} AS clean, text FROM doc JOIN documents ON doc_id = rank)
SELECT 'content-digest' AS check_code, 'error' AS severity, citation AS key, CAST(NULL AS VARCHAR) AS detail FROM d WHERE sha256(clean) <> sha256(text)
UNION ALL SELECT 'citation-mismatch', 'error', citation, NULL FROM d WHERE lang <> 'en' AND n_chars <> slide_number""")
def provenance_violations(spark, sf):
    """Blocks with the digests of cleaned texts, and those that aren't English with their length for a slide number."""
    own = table(spark, sf, "documents").select(F.col("doc_id").alias("rank"), "lang", "n_chars")
    b = views.blocks_doc(spark, sf).join(own, "rank").withColumn("content_sha256", C.sha256(_clean(F.col("content"))))
    return artifacts.provenance(b.withColumn("slide_number", F.when(F.col("lang") == "en", F.col("slide_number")).otherwise(F.col("n_chars"))))


@query("""SELECT 'raster-table-boundary-unverified' AS check_code, 'warning' AS severity, l_orderkey || '/t' || l_linenumber AS key, CAST(NULL AS VARCHAR) AS detail
FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_returnflag = 'R' AND l_linestatus = 'O' AND l_discount > 0.05 AND o_orderstatus <> 'F'""")
def raster_table_warnings(spark, sf):
    """Orders as elements, pictures or charts unless they are finished, and their lines as elements inside or outside of them:
    returned ones are tables, open ones were read."""
    o = table(spark, sf, "orders")
    kind = F.when(F.col("o_orderstatus") == "F", "text").when(F.col("o_orderstatus") == "O", "image").otherwise("chart")
    parent = o.select(F.col("o_orderkey").alias("slide_number"), F.col("o_custkey").cast("string").alias("element_id"), kind.alias("kind"), F.lit("native").alias("source"), F.lit(None).cast("string").alias("parent_id"))
    lines = table(spark, sf, "lineitem").join(o, F.col("o_orderkey") == F.col("l_orderkey"))
    child = lines.select("l_orderkey", F.concat(F.lit("t"), F.col("l_linenumber").cast("string")), F.when(F.col("l_returnflag") == "R", "table").otherwise("text"), F.when(F.col("l_linestatus") == "O", "ocr").otherwise("native"), F.when(F.col("l_discount") > 0.05, F.col("o_custkey").cast("string")))
    return checks.raster_tables(parent.union(child))


@query("""WITH c AS (SELECT l_orderkey AS t, CAST(l_linenumber - 1 AS INTEGER) AS r, CAST(CAST(round(l_tax * 100) AS INTEGER) % 3 AS INTEGER) AS k, CAST(CAST(round(l_discount * 100) AS INTEGER) % 4 AS INTEGER) AS rs, CAST(1 + CAST(l_quantity AS INTEGER) % 2 AS INTEGER) AS cs, l_returnflag <> 'N' AS o FROM lineitem),
i AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY r, k, rs, cs, o) - 1 AS i FROM c)
SELECT CASE WHEN r >= 3 OR k >= 2 THEN 'invalid-table-cell' ELSE 'invalid-table-span' END AS check_code, 'error' AS severity, t || '/' || i AS key, CAST(NULL AS VARCHAR) AS detail FROM i WHERE o AND (r >= 3 OR k >= 2 OR rs < 1 OR r + rs > 3 OR k + cs > 2)""")
def table_violations(spark, sf):
    """A table of three rows and two columns for each order, its lines as cells: place and spans by number, tax, discount, quantity."""
    part = lambda c, n: (F.round(F.col(c) * 100).cast("int") % n)
    cell = F.struct((F.col("l_linenumber") - 1).cast("int").alias("row"), part("l_tax", 3).alias("column"), part("l_discount", 4).alias("row_span"), (F.col("l_quantity").cast("int") % 2 + 1).alias("column_span"), (F.col("l_returnflag") != "N").alias("is_merge_origin"))
    t = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("table_id")).agg(F.sort_array(F.collect_list(cell)).alias("cells"))
    return checks.table_checks(t.select("table_id", F.lit(3).alias("rows"), F.lit(2).alias("columns"), "cells"))


@query("""SELECT l_orderkey AS page, unnest(['text', 'table']) AS kind, unnest([CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR)]) AS text, unnest([0, 1]) AS ord FROM lineitem""")
def reader_payload_blocks(spark, sf):
    """Payloads of a reader, a text and a table for each order line, as block rows."""
    from evispark.operators import readers

    row = F.concat(F.lit("<table><tr><td>"), F.col("l_partkey").cast("string"), F.lit("</td></tr></table>"))
    payload = F.to_json(F.struct(F.array(F.struct(F.lit("text").alias("kind"), F.col("l_linenumber").cast("string").alias("text")), F.struct(F.lit("table").alias("kind"), row.alias("text"))).alias("blocks")))
    t = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("page"), payload.alias("payload"))
    return readers.read_payloads(t).select("page", "kind", "text", "ord")


@query("""SELECT 'index.md' AS path, '---' || chr(10) || 'title: "Nations"' || chr(10) || 'description: "Nations"' || chr(10) || 'aliases: []' || chr(10) || 'tags: ["index"]' || chr(10) || 'pr_numbers: []' || chr(10) || 'source_ids: []' || chr(10) || 'draft: false' || chr(10) || '---' || chr(10) || chr(10) || '# Nations' || chr(10) || chr(10)
|| '## Nations' || chr(10) || chr(10) || string_agg('- [[nations/' || n_nationkey || '|' || n_name || ']]', chr(10) ORDER BY lower(n_name)) || chr(10) AS body FROM nation""")
def index_page(spark, sf):
    return publish.index_page("Nations", {"Nations": table(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("title"))})


@query("""WITH x AS (SELECT s_nationkey AS id, list_sort(list(CAST(s_suppkey AS VARCHAR))) AS derived, coalesce(list_sort(list(CAST(s_suppkey AS VARCHAR)) FILTER (s_acctbal >= 0)), []) AS stored FROM supplier GROUP BY 1)
SELECT 'source-lineage' AS check_code, 'error' AS severity, CAST(id AS VARCHAR) AS key, CAST(NULL AS VARCHAR) AS detail FROM x WHERE stored <> derived""")
def array_lineage(spark, sf):
    """Nations whose stored suppliers, those that owe nothing, are not all of them."""
    key = F.col("s_suppkey").cast("string")
    s = table(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("id")).agg(F.collect_list(key).alias("derived"), F.collect_list(F.when(F.col("s_acctbal") >= 0, key)).alias("stored"))
    return checks.array_checks(s, "id", "stored", "derived", "source-lineage")


@query("""WITH m AS (SELECT 's' || l_suppkey % 7 AS source_id, l_orderkey AS slide, 'e' || l_linenumber AS e, CASE WHEN l_returnflag = 'R' THEN l_partkey ELSE l_orderkey END AS slide_number, CASE WHEN l_tax < 0.01 THEN 'none' ELSE sha256(CAST(l_partkey AS VARCHAR)) END AS d, [CAST(l_linenumber AS VARCHAR), CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)] AS n FROM lineitem),
q AS (SELECT *, '[@' || source_id || '/slide-' || slide || '#' || e || ']' AS q FROM m)
SELECT 'duplicate-citation' AS check_code, 'error' AS severity, q AS key, CAST(count(*) AS VARCHAR) AS detail FROM q GROUP BY q HAVING count(*) > 1
UNION ALL SELECT 'citation-mismatch', 'error', q, NULL FROM q WHERE slide <> slide_number UNION ALL SELECT 'slide-number', 'error', q, NULL FROM q WHERE slide_number < 1
UNION ALL SELECT 'no-digest', 'error', q, NULL FROM q WHERE d = 'none' UNION ALL SELECT 'repeated-numbers', 'error', q, NULL FROM q WHERE n[1] = n[2]""")
def source_map_violations(spark, sf):
    """Order lines as a source map: a citation for each line of an order, slides of returned ones by part, digests missing where no
    tax is due, the line's number and quantity as its numbers."""
    t = table(spark, sf, "lineitem")
    text = lambda c: c.cast("string")
    source, element = F.concat(F.lit("s"), text(F.col("l_suppkey") % 7)), F.concat(F.lit("e"), text(F.col("l_linenumber")))
    slide = F.when(F.col("l_returnflag") == "R", F.col("l_partkey")).otherwise(F.col("l_orderkey"))
    digest = F.when(F.col("l_tax") < 0.01, "none").otherwise(C.sha256(text(F.col("l_partkey"))))
    cited = F.concat(F.lit("[@"), source, F.lit("/slide-"), text(F.col("l_orderkey")), F.lit("#"), element, F.lit("]"))
    numbers = F.array(text(F.col("l_linenumber")), text(F.col("l_quantity").cast("long")))
    return artifacts.source_map_rows(t.select(cited.alias("qualified_citation"), source.alias("source_id"), slide.alias("slide_number"), element.alias("element_id"), digest.alias("content_sha256"), numbers.alias("numbers")))


@query(f"""WITH d AS (SELECT CAST(doc_id AS VARCHAR) AS id FROM documents WHERE sha256({_CLEAN}) <> sha256(text))
SELECT code AS check_code, 'error' AS severity, id AS key, CAST(NULL AS VARCHAR) AS detail FROM d, (VALUES ('not-derivable'), ('not-stored')) t(code)""")
def lineage_reconcile(spark, sf):
    """Stored digests of cleaned texts against those that the texts give."""
    d = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"), "text")
    return checks.changed_rows(d.select("id", C.sha256(_clean(F.col("text"))).alias("sha256")), d.select("id", C.sha256(F.col("text")).alias("sha256")), "id")


@query(r"""WITH h AS (SELECT page_id, regexp_extract_all(html, '<a href="/([^"]*)"', 1) AS h FROM pages), n AS (SELECT page_id, h, h[1] AS name FROM h WHERE len(h) > 0),
l AS (SELECT name, h[i] AS goal, (i - 1) % 6 AS kind FROM (SELECT name, h, unnest(range(1, len(h) + 1)) AS i FROM n)),
known AS (SELECT DISTINCT name FROM n), folded AS (SELECT DISTINCT replace(lower(name), 'ß', 'ss') AS name FROM n)
SELECT 'p/' || l.name || '.md' AS path, CASE WHEN kind = 4 THEN 'unsafe-link' WHEN k.name IS NULL AND f.name IS NULL THEN 'dangling-link' ELSE 'dangling-fragment' END AS check_code,
CASE kind WHEN 0 THEN 'p/' || goal WHEN 1 THEN goal || '.md' WHEN 2 THEN '../p/' || goal || '.md' WHEN 3 THEN goal || '.md' WHEN 4 THEN '/' || goal ELSE 'P/' || goal END AS target, CASE WHEN kind = 3 THEN 'lost' WHEN kind = 5 THEN 'top' END AS fragment
FROM l LEFT JOIN known k ON k.name = goal AND kind IN (1, 2, 3) LEFT JOIN folded f ON f.name = replace(lower(goal), 'ß', 'ss') AND kind IN (0, 5)
WHERE kind = 4 OR (kind IN (0, 5) AND f.name IS NULL) OR (kind IN (1, 2, 3) AND k.name IS NULL) OR (kind = 3 AND k.name IS NOT NULL)""")
def site_link_violations(spark, sf):
    """Pages of one first link are a page of its name; their links become wiki, standard, reference and HTML ones, some with
    fragments, some absolute. Every page has the heading Top."""
    found = table(spark, sf, "pages").select("page_id", F.regexp_extract_all("html", F.lit('<a href="/([^"]*)"'), 1).alias("h")).where(F.size("h") > 0)
    kinds = [("[[p/", "]]"), ("[x](", ".md)"), ("<a href='../p/", ".md'>x</a>"), ("\n[r]: ", ".md#lost\n"), ("[x](/", ")"), ("[[P/", "#top|x]]")]

    def written(to, at):
        out = F.lit("")
        for n, (before, after) in enumerate(kinds):
            out = F.when(at % len(kinds) == n, F.concat(F.lit(before), to, F.lit(after))).otherwise(out)
        return out

    one = found.select(F.get("h", 0).alias("name"), F.array_join(F.transform("h", written), " ").alias("body"))
    pages = one.groupBy("name").agg(F.concat(F.lit("# Top\n"), F.array_join(F.sort_array(F.collect_list("body")), "\n")).alias("body"))
    return links.tree_violations(pages.select(F.concat(F.lit("p/"), "name", F.lit(".md")).alias("path"), "body"))


@query("""WITH f AS (SELECT l_orderkey AS o, min(l_linestatus) AS d, count(*) AS n FROM lineitem GROUP BY 1), b AS (SELECT coalesce(o_orderkey, o) AS o, o_orderkey, o_orderstatus, o_custkey % 7 + 1 AS told, f.d, f.n FROM orders FULL JOIN f ON o = o_orderkey)
SELECT 'file-missing' AS check_code, 'error' AS severity, 'orders/' || o AS key, CAST(NULL AS VARCHAR) AS detail FROM b WHERE n IS NULL
UNION ALL SELECT 'file-unknown', 'error', 'orders/' || o, NULL FROM b WHERE o_orderkey IS NULL
UNION ALL SELECT 'file-changed', 'error', 'orders/' || o, d FROM b WHERE o_orderstatus <> d
UNION ALL SELECT 'row-count', 'error', 'orders/' || o, CAST(n AS VARCHAR) FROM b WHERE told <> n""")
def manifest_reconcile(spark, sf):
    """Orders as a manifest of files, whose digests are their states, against the files that order lines make."""
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("file"), "l_linestatus")
    n = tasks(lines)  # by the file alone: the name is one
    told = table(spark, sf, "orders").select(F.lit("orders").alias("name"), F.col("o_orderkey").cast("string").alias("file"), F.lit(1).cast("long").alias("bytes"), F.col("o_orderstatus").alias("sha256"), (F.col("o_custkey") % 7 + 1).cast("long").alias("rows"))
    made = dealt(lines, n, "file").groupBy(F.lit("orders").alias("name"), "file").agg(F.min("l_linestatus").alias("sha256"), F.count("*").alias("rows"))
    return runs.reconciled(dealt(told, n, "file"), made.select("name", "file", F.lit(1).cast("long").alias("bytes"), "sha256"), made.select("name", "file", "rows"))


class LineReader:
    """Stands for a reader of pictures: a text's bytes are a picture, its lines blocks of ten pixels height."""

    def read(self, image: bytes, task: str, context: str) -> dict:
        lines = bytes(image).decode().split("\n")
        return {"blocks": [{"kind": "line", "text": line, "bbox": [0, 10 * i, 100, 10 * i + 10]} for i, line in enumerate(lines) if line.strip()]}


@query(r"""WITH l AS (SELECT doc_id, unnest(p) AS line, generate_subscripts(p, 1) - 1 AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents)),
k AS (SELECT doc_id, line, i, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS n FROM l WHERE regexp_matches(line, '[^\s]'))
SELECT source AS source_id, 'd' || doc_id || '-ocr' || lpad(CAST(n AS VARCHAR), CAST(greatest(3, length(CAST(n AS VARCHAR))) AS INTEGER), '0') AS element_id, 'd' || doc_id AS parent_id, 'ocr_line' AS kind, sha256(line) AS text_sha256, CAST(n AS INTEGER) AS z_index, CAST(1000 + 1000 * i AS BIGINT) AS y FROM k JOIN documents USING (doc_id)""")
def picture_blocks(spark, sf):
    """Every document's text as a picture on a slide: equal ones are read once, and their lines are child elements in place."""
    d = table(spark, sf, "documents").where("text is not null").withColumn("digest", C.sha256(F.col("text")))
    tall = F.size(F.split("text", "\n"))
    elements = d.select(F.col("source").alias("source_id"), F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("element_id"), F.lit(1).alias("slide_number"), F.lit("image").alias("kind"), F.lit("p").alias("name"), F.lit(False).alias("hidden"), F.lit(0).cast("long").alias("x"), F.lit(1000).cast("long").alias("y"), F.lit(10_000).cast("long").alias("width"), (tall * 1000).cast("long").alias("height"), F.lit(0).alias("z_index"), F.array().cast("array<double>").alias("crop"), F.col("digest").alias("media_sha256"), "doc_id", tall.alias("tall"))
    asked = pictures.targets(elements)
    first = elements.groupBy("media_sha256").agg(F.min("doc_id").alias("doc_id"))
    media = d.join(first, "doc_id").select(F.col("digest").alias("sha256"), F.encode("text", "UTF-8").alias("content"))
    answers, _ = pictures.answered(asked, media, LineReader, scratch(spark, "answers") + "/table")
    sizes = elements.select(F.col("media_sha256").alias("sha256"), F.lit(100).alias("width"), (10 * F.col("tall")).alias("height")).distinct()
    found = pictures.children(elements, asked, answers.drop("width", "height").join(sizes, "sha256"))
    return found.select("source_id", "element_id", "parent_id", "kind", C.sha256(F.col("text")).alias("text_sha256"), "z_index", "y")


@query("""SELECT o_orderkey AS page_id, 'borrowed-number' AS check_code, CAST(o_orderkey % 50 AS VARCHAR) AS detail FROM orders WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey % 1009 = o_custkey % 1009 AND p_size = o_orderkey % 50)""")
def line_grounding(spark, sf):
    """A line for each order that claims a number and cites parts by a key that many share; the facts are the parts' sizes."""
    cited = lambda c: F.concat(F.lit("[slide-"), (c % 1009).cast("string"), F.lit("#e]"))
    lines = table(spark, sf, "orders").select(F.col("o_orderkey").alias("page_id"), F.lit(1).alias("line_no"), F.concat(F.lit("It has "), (F.col("o_orderkey") % 50).cast("string"), F.lit(" of it "), cited(F.col("o_custkey"))).alias("line"))
    facts = table(spark, sf, "part").select(cited(F.col("p_partkey")).alias("citation"), F.col("p_size").cast("string").alias("number"))
    return checks.line_grounding(lines, facts).select(F.substring_index("key", "/", 1).cast("long").alias("page_id"), "check_code", "detail")


@query("""SELECT doc_id, list_concat(list_concat(CASE WHEN n_chars % 3 = 2 THEN ['unknown-citation:[slide-2#e]'] ELSE [] END,
list_transform(list_sort(list_distinct(list_filter([CASE WHEN n_chars % 2 = 1 THEN CAST(n_chars AS VARCHAR) END, CASE WHEN lang = 'en' AND doc_id <> n_chars - n_chars % 2 THEN CAST(doc_id AS VARCHAR) END], lambda x: x IS NOT NULL))), lambda x: 'number:' || x)),
CASE WHEN lang = 'en' THEN ['uncited-line:2'] ELSE [] END) AS errors FROM documents""")
def grounding_errors(spark, sf):
    """A page for each document: its length, cited, and its id, uncited where it is English, a heading elsewhere; the evidence knows
    the even lengths."""
    n, text = F.col("n_chars"), lambda c: c.cast("string")
    first = F.concat(F.lit("it is "), text(n), F.lit(" [slide-"), text(n % 3), F.lit("#e]\n"))
    body = F.concat(first, F.when(F.col("lang") == "en", F.concat(F.lit("and "), text(F.col("doc_id")))).otherwise("# Head"))
    allowed = F.array(F.lit("[slide-0#e]"), F.lit("[slide-1#e]"))
    return table(spark, sf, "documents").select("doc_id", call("grounding_errors", body, allowed, F.concat(F.lit("has "), text(n - n % 2))).alias("errors"))


@query("""SELECT n_nationkey AS id, '<table>' || chr(10) || '  <tr>' || chr(10) || '    <th colspan="2">' || n_name || '</th>' || chr(10) || '  </tr>' || chr(10) || '  <tr>' || chr(10) || '    <td>' || n_regionkey || '</td>' || chr(10) || '    <td></td>' || chr(10) || '  </tr>' || chr(10) || '</table>' AS html FROM nation""")
def span_tables(spark, sf):
    cell = lambda r, c, t, w: F.struct(F.lit(r).alias("row"), F.lit(c).alias("column"), t.alias("text"), F.lit(1).alias("row_span"), F.lit(w).alias("column_span"))
    raw = F.to_json(F.struct(F.lit(2).alias("rows"), F.lit(2).alias("columns"), F.array(cell(0, 0, F.col("n_name"), 2), cell(1, 0, F.col("n_regionkey").cast("string"), 1)).alias("cells")))
    return table(spark, sf, "nation").select(F.col("n_nationkey").alias("id"), call("table_markup", raw).alias("html"))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def stream_counts(spark, sf):
    """Counts of a stream that ends, written batch by batch."""
    base = scratch(spark, "stream")
    ingest.each_batch(ingest.event_stream(spark, sf).select("event_id", "event_type"), _append(f"{base}/batches"), f"{base}/marks")
    return spark.read.parquet(f"{base}/batches").groupBy("event_type").agg(F.count("*").alias("n"))


def _append(path: str):
    """A batch written under its number: one that is tried again replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write
