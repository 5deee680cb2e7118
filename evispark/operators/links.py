"""Link graph of a site: links and anchors as tables, dangling links by anti join, path collisions, slugs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evispark.functions import patterns
from evispark.functions.udfs import call
from evispark.operators.blocks import unique_ids
from evispark.session import cut

HREF = r"""(?i)<a\b[^>]*\bhref\s*=\s*["']([^"']*)["']"""
HEADING = r"(?is)<h1[^>]*>(.*?)</h1>"


def html_links(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, position, href, path, fragment, external) of every anchor tag."""
    found = pages.select(key, F.posexplode(F.regexp_extract_all(html, F.lit(HREF), 1)).alias("position", "href"))
    fragment = F.nullif(F.regexp_extract("href", "#(.*)$", 1), F.lit(""))
    return found.select(key, "position", "href", F.substring_index("href", "#", 1).alias("path"), fragment.alias("fragment"), F.col("href").rlike("(?i)^(https?:|mailto:|data:)").alias("external"))


def dangling(links: DataFrame, targets: DataFrame, key: str = "page_id") -> DataFrame:
    """Local links whose path is no page. targets: (path)."""
    return links.where("not external and path <> ''").join(targets.select("path").distinct(), "path", "left_anti").select(key, "position", "href")


def page_links(pages: DataFrame, key: str = "path", text: str = "body") -> DataFrame:
    """(key, kind, target, fragment) of Markdown pages."""
    return pages.select(key, F.inline(call("links", text)))


def page_anchors(pages: DataFrame, key: str = "path", text: str = "body") -> DataFrame:
    return pages.select(key, F.explode(call("anchors", text)).alias("anchor"))


def path_key(path) -> F.Column:
    return call("stable_key", F.regexp_replace(path, r"\.[^./]*$", ""))


#: Pages that show what decks hold; the others are generated.
EVIDENCE = "evidence/"


def tree_violations(pages: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """(check_code, path, target, fragment) of a site's pages (path, body): links of any kind to no page or file, fragments that
    the page linked to doesn't have, links to absolute paths or unknown schemes, markup of images, and in generated pages
    citations that are no links.

    Wiki links name a page without its suffix, from the root, in any case. Standard, reference and HTML links are relative to
    their page and may also go to `files` (path)."""
    code = lambda c: F.lit(c).alias("check_code")
    keyed = pages.select("path", "body", path_key(F.col("path")).alias("page_key"))
    known_keys = keyed.select("page_key").distinct()
    every = pages.select("path").union(files.select("path")).distinct() if files is not None else pages.select("path").distinct()
    found = cut(keyed.select("path", "page_key", F.inline(call("placed_links", "body", "path"))))
    wiki = found.where("kind = 'wiki'").select("path", "target", "fragment", F.when(F.col("target") == "", F.col("page_key")).otherwise(call("stable_key", F.regexp_replace(F.ltrim("target", F.lit("/")), r"\.md$", ""))).alias("page_key"))
    local = found.where("kind not in ('wiki', 'external', 'unsafe')").select("path", "target", "fragment", F.when(F.col("target") == "", F.col("path")).otherwise(F.col("place")).alias("goal"))
    anchors = cut(page_anchors(keyed.select("path", "body")).select("path", path_key(F.col("path")).alias("page_key"), F.col("anchor").alias("fragment")).distinct())
    shown = ["path", "target", "fragment"]
    parts = [
        wiki.join(known_keys, "page_key", "left_anti").select(code("dangling-link"), *shown),
        wiki.where("fragment is not null").join(known_keys, "page_key", "left_semi").join(anchors.select("page_key", "fragment"), ["page_key", "fragment"], "left_anti").select(code("dangling-fragment"), *shown),
        local.join(every.select(F.col("path").alias("goal")), "goal", "left_anti").select(code("dangling-link"), *shown),
        local.where("fragment is not null").join(pages.select(F.col("path").alias("goal")), "goal", "left_semi").join(anchors.select(F.col("path").alias("goal"), "fragment"), ["goal", "fragment"], "left_anti").select(code("dangling-fragment"), *shown),
        found.where("kind = 'unsafe'").select(code("unsafe-link"), *shown),
    ]
    none = (F.lit(None).cast("string").alias("target"), F.lit(None).cast("string").alias("fragment"))
    image = F.col("body").rlike(patterns.MARKDOWN_IMAGE) | F.col("body").contains("![[") | F.col("body").rlike(patterns.HTML_IMAGE)
    raw = ~F.startswith("path", F.lit(EVIDENCE)) & (F.col("body").contains("[slide-") | F.col("body").contains("[@"))
    parts += [pages.where(image).select(code("image-markup"), "path", *none), pages.where(raw).select(code("raw-citation"), "path", *none)]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def path_collisions(files: DataFrame, key) -> DataFrame:
    """(path_key, n): paths that differ only in case or form, or hold different bytes. files: (path, sha256)."""
    g = files.groupBy(key.alias("path_key")).agg(F.countDistinct("path").alias("n"), F.countDistinct("sha256").alias("contents"))
    return g.where("n > 1 or contents > 1").select("path_key", "n")


def unique_slugs(values: DataFrame, slug, value: str = "value") -> DataFrame:
    """(value, slug): values whose base slug is not theirs alone get a digest of ten hex digits behind it."""
    base = values.select(value).distinct().withColumn("base", slug)
    shared = cut(base.groupBy("base").count().where("count > 1").select("base", F.lit(True).alias("shared")))
    return base.join(shared, "base", "left").select(value, F.when(F.col("shared"), F.concat("base", F.lit("--"), F.substring(F.sha2(F.encode(value, "UTF-8"), 256), 1, 10))).otherwise(F.col("base")).alias("slug"))


# Names that a site's own files have.
RESERVED_SLUGS = ("index", "publish-report", "manifest", "documents", "con", "prn", "aux", "nul", *(f"{port}{n}" for port in ("com", "lpt") for n in range(1, 10)))


def numbered_slugs(values: DataFrame, base: str, order: str, reserved: tuple[str, ...] = RESERVED_SLUGS) -> DataFrame:
    """values with a slug each: a base that an earlier row or a reserved name has gets -2, -3, ..., the first that is free.

    `order` is a text column without empty values; rows of one base are numbered in its order. Slugs are in lower case.
    """
    own = values.withColumn("_base", F.lower(base)).withColumn("_held", F.lit(False))
    held = values.sparkSession.createDataFrame([(name,) for name in reserved], "_base string").withColumn(order, F.lit("")).withColumn("_held", F.lit(True))
    named = unique_ids(own.unionByName(held, allowMissingColumns=True), [], "_base", order, "-")
    return named.where("not _held").withColumnRenamed("unique_id", "slug").drop("_base", "_held")


def heading_slugs(headings: DataFrame, page: str, line: str, slug: str) -> DataFrame:
    """A heading slug that a page has already gets -1, -2, ... by line."""
    w = Window.partitionBy(page, slug).orderBy(line)
    n = F.row_number().over(w) - 1
    return headings.withColumn("anchor", F.when(n > 0, F.concat(slug, F.lit("-"), n.cast("string"))).otherwise(F.col(slug)))
