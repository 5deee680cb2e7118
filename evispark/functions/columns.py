"""Scalar operators that Spark's own expressions can say: citations, digests, rendering, geometry, clean-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from evispark.functions import patterns


def citation(slide: Column, element: Column) -> Column:
    return F.concat(F.lit("[slide-"), slide.cast("string"), F.lit("#"), element, F.lit("]"))


def qualified(source: Column, local: Column) -> Column:
    """Global form of local citations in a column of text; leading zeros of slide numbers go."""
    return F.regexp_replace(local, r"\[slide-0*(\d+)#([^\]\s#]+)\]", F.concat(F.lit("[@"), source, F.lit("/slide-$1#$2]")))


def citation_parts(text: Column) -> Column:
    """struct(source, slide, element) of a local or qualified citation; null where it is none."""
    whole = r"^\[(?:@([a-z0-9](?:[a-z0-9._-]{0,126}[a-z0-9])?)/)?slide-(\d+)#([^\]\s#]+)\]$"
    part = lambda n: F.regexp_extract(text, whole, n)
    return F.when(text.rlike(whole), F.struct(F.nullif(part(1), F.lit("")).alias("source"), part(2).cast("int").alias("slide"), part(3).alias("element")))


def citations_in(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"({patterns.LOCAL_CITATION})"), 1))


def sha256(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def visible_text(title: Column, content: Column) -> Column:
    return F.concat(F.coalesce(title, F.lit("")), F.lit("\n"), F.coalesce(content, F.lit("")))


def content_of(table: Column, markdown: Column, html: Column, text: Column, asset: Column, name: Column) -> Column:
    """struct(format, content): the first form that is there, in this order; an image link if there is but an asset."""
    has = lambda c: c.isNotNull() & (c != "")
    form = lambda f, c: F.struct(F.lit(f).alias("format"), c.alias("content"))
    out = F.when(has(table), F.struct(F.when(table.startswith("<table"), "html").otherwise("markdown").alias("format"), table.alias("content")))
    for f, c in (("markdown", markdown), ("html", html), ("text", text)):
        out = out.when(has(c), form(f, c))
    image = F.concat(F.lit("!["), F.coalesce(name, F.lit("")), F.lit("]("), asset, F.lit(")"))
    return out.when(has(asset), form("markdown", image)).otherwise(form("text", F.lit("")))


def escape_cell(cell: Column) -> Column:
    out = F.replace(F.coalesce(cell, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(out, F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit("<br>"))


def pipe_table(matrix: Column) -> Column:
    """Pipe table of an array of rows, the first of which is the head; empty without rows."""
    line = lambda row: F.concat(F.lit("| "), F.array_join(F.transform(row, escape_cell), " | "), F.lit(" |"))
    rule = F.concat(F.lit("| "), F.array_join(F.transform(F.element_at(matrix, 1), lambda _: F.lit("---")), " | "), F.lit(" |"))
    body = F.transform(F.slice(matrix, 2, F.greatest(F.size(matrix) - 1, F.lit(0))), line)
    return F.when(F.size(matrix) > 0, F.array_join(F.concat(F.array(line(F.element_at(matrix, 1)), rule), body), "\n")).otherwise("")


def bbox_normalized(x: Column, y: Column, w: Column, h: Column, slide_w: Column, slide_h: Column) -> Column:
    """[x1, y1, x2, y2] as shares of the slide to six places; null where the slide has no size."""
    share = lambda v, of: F.bround(v.cast("double") / of, 6)
    return F.when((slide_w > 0) & (slide_h > 0), F.array(share(x, slide_w), share(y, slide_h), share(x + w, slide_w), share(y + h, slide_h)))


def overlap(ax1: Column, ax2: Column, bx1: Column, bx2: Column) -> Column:
    return F.greatest(F.least(ax2, bx2) - F.greatest(ax1, bx1), F.lit(0))


def iou(a: list[Column], b: list[Column]) -> Column:
    """Intersection over union of [x1, y1, x2, y2] boxes; 0 where the union is empty."""
    both = overlap(a[0], a[2], b[0], b[2]) * overlap(a[1], a[3], b[1], b[3])
    area = lambda c: F.greatest(c[2] - c[0], F.lit(0)) * F.greatest(c[3] - c[1], F.lit(0))
    union = area(a) + area(b) - both
    return F.when(union > 0, both / union).otherwise(0.0)


def floor_div(a: Column, b: Column) -> Column:
    """Integer division that rounds down, also for negative numbers."""
    return ((a - F.pmod(a, b)) / b).cast("long")


def emu_to_pixels(x: Column, y: Column, w: Column, h: Column, slide_w: Column, slide_h: Column, image_w: Column, image_h: Column) -> Column:
    """Half-open pixel box around an EMU box: outwards to whole pixels, held inside the image."""
    low = lambda v, of, px: F.least(F.greatest(floor_div(v * px, of), F.lit(0)), px)
    high = lambda v, of, px: F.least(F.greatest(-floor_div(-v * px, of), F.lit(0)), px)
    return F.struct(low(x, slide_w, image_w).alias("left"), low(y, slide_h, image_h).alias("top"), high(x + w, slide_w, image_w).alias("right"), high(y + h, slide_h, image_h).alias("bottom"))


def clean_confidence(value: Column) -> Column:
    """A number from 0 to 1, else null."""
    number = value.try_cast("double")
    return F.when(number.between(0.0, 1.0), number)


def clean_box(values: Column, swap: bool = False) -> Column:
    """[x1, y1, x2, y2] of an array of four numbers or eight (corner points): finite and in order, else null (or put in
    order)."""
    xs = F.when(F.size(values) == 4, F.array(values[0], values[2])).when(F.size(values) == 8, F.array(values[0], values[2], values[4], values[6]))
    ys = F.when(F.size(values) == 4, F.array(values[1], values[3])).when(F.size(values) == 8, F.array(values[1], values[3], values[5], values[7]))
    fine = F.forall(values, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    box = F.array(F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys))
    ordered = F.lit(True) if swap else (F.size(values) == 8) | ((values[2] >= values[0]) & (values[3] >= values[1]))
    return F.when(fine & xs.isNotNull() & ordered, box)


def grid_to_pixels(values: Column, width: Column, height: Column) -> Column:
    """Box on a grid of 0 to 1000 in pixels, held inside the image."""
    at = lambda i, size: F.least(F.greatest(values[i].cast("double") / 1000 * size, F.lit(0.0)), size.cast("double"))
    return F.array(at(0, width), at(1, height), at(2, width), at(3, height))


def box_on_slide(parent: list[Column], block: list[Column], padding: Column, crop_w: Column, crop_h: Column, scale_x: Column, scale_y: Column) -> Column:
    """A block's pixel box, found in a padded crop, as x, y, width, height on the slide; the parent's where it vanishes."""
    hold = lambda v, size: F.least(F.greatest(v - padding, F.lit(0.0)), size)
    x1, y1, x2, y2 = hold(block[0], crop_w), hold(block[1], crop_h), hold(block[2], crop_w), hold(block[3], crop_h)
    left, top = parent[0] + F.bround(x1 * scale_x).cast("long"), parent[1] + F.bround(y1 * scale_y).cast("long")
    w, h = F.bround((x2 - x1) * scale_x).cast("long"), F.bround((y2 - y1) * scale_y).cast("long")
    own = F.array(left, top, w, h)
    return F.when(block[0].isNull() | (w <= 0) | (h <= 0), F.array(*parent)).otherwise(own)


def media_type(data: Column, path: Column) -> Column:
    """By the first bytes, else by the suffix."""
    head = F.hex(F.substring(data, 1, 12))
    out = F.when(head.startswith("89504E47"), "image/png").when(head.startswith("FFD8FF"), "image/jpeg").when(head.startswith("47494638"), "image/gif")
    out = out.when(head.startswith("52494646") & head.endswith("57454250"), "image/webp").when(head.startswith("25504446"), "application/pdf").when(head.startswith("424D"), "image/bmp")
    suffix = F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))
    for s, t in (("png", "image/png"), ("jpg", "image/jpeg"), ("jpeg", "image/jpeg"), ("gif", "image/gif"), ("webp", "image/webp"), ("bmp", "image/bmp"), ("tif", "image/tiff"), ("tiff", "image/tiff")):
        out = out.when(suffix == s, t)
    return out.otherwise("application/octet-stream")


def data_url(data: Column, kind: Column) -> Column:
    return F.concat(F.lit("data:"), kind, F.lit(";base64,"), F.base64(data))


def ocr_task(kind: Column) -> Column:
    return F.when(kind == "table", "table").when(kind.isin("chart", "diagram"), "chart").when(kind == "formula", "formula").when(kind == "text", "text").otherwise("document")


def formula_markdown(raw: Column) -> Column:
    body = F.trim(F.regexp_replace(raw, r"^\s*\$+|\$+\s*$", ""))
    return F.when(body == "", "").otherwise(F.concat(F.lit("$$\n"), body, F.lit("\n$$")))


def safe_stem(value: Column) -> Column:
    """Directory name: unsafe characters to underscores, at most 100 characters, device names set apart."""
    stem = F.substring(F.regexp_replace(F.regexp_replace(value, r'[<>:"/\\|?*\x00-\x1f]+', "_"), r"^[ .]+|[ .]+$", ""), 1, 100)
    stem = F.when(stem == "", "deck").otherwise(stem)
    return F.when(F.lower(F.substring_index(stem, ".", 1)).isin(*patterns.RESERVED_STEMS), F.concat(F.lit("_"), stem)).otherwise(stem)


def file_stem(path: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(path, r"([^/\\]+)$", 1), r"\.[^.]*$", "")


def occurrence_id(path: Column) -> Column:
    """Name of a file's occurrence that doesn't give its path away; path comes in NFC, its case doesn't count."""
    return F.concat(F.lit("occurrence-"), F.left(sha256(F.lower(path)), F.lit(16)))


def without_paths(message: Column, paths: Column) -> Column:
    """A message in which each path of an array is its file's name alone, longer paths first."""
    longest = F.transform(F.array_sort(F.transform(paths, lambda p: F.struct((-F.length(p)).alias("n"), p.alias("p")))), lambda s: s["p"])
    return F.aggregate(longest, message, lambda text, p: F.replace(text, p, F.regexp_extract(p, r"([^/\\\\]*)$", 1)))


def is_dangerous(html: Column) -> Column:
    return html.rlike(patterns.DANGEROUS_HTML)


def controls_in(text: Column) -> Column:
    return text.rlike(r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]")


def description(text: Column) -> Column:
    """One line without citations, at most 500 characters."""
    bare = F.regexp_replace(F.regexp_replace(text, patterns.QUALIFIED_CITATION, ""), patterns.LOCAL_CITATION, "")
    return F.left(F.trim(F.regexp_replace(bare, r"\s+", " ")), F.lit(500))


def front_matter(fields: dict[str, Column]) -> Column:
    """Keys with JSON scalars or arrays between rules."""
    lines = [F.concat(F.lit(f"{k}: "), v) for k, v in fields.items()]
    return F.concat(F.lit("---\n"), F.concat_ws("\n", *lines), F.lit("\n---\n"))


def json_text(value: Column) -> Column:
    """A JSON string literal."""
    return F.regexp_replace(F.regexp_replace(F.to_json(F.struct(F.coalesce(value, F.lit("")).alias("v"))), r'^\{"v":', ""), r"\}$", "")
