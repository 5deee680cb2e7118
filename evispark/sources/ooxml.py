"""Slide decks: one task reads one file with the standard zip and XML parsers.

    ooxml.decks(spark, folder)                       # any store that Spark reads
    spark.dataSource.register(DeckSource); spark.read.format("deck").option("path", folder).load()  # paths on every executor

A row is an element: place, kind, text, table and notes; paragraphs_json has the paragraphs with level, alignment, bullet and
runs (font, size, bold, italic, underline, hyperlink), table_json the cells with spans and boxes; media_part and media_sha256
name a picture's bytes in the deck (see deck_media), crop its cut edges. Groups are flattened into slide space. With
images=False pictures are left out. A shape, slide or deck that can't be read is a row of kind `error` with the reason, and the
others are read all the same, unless `strict`: then the task fails with it.
"""

from __future__ import annotations

import io
import json
import math
import posixpath
import re
import zipfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from glob import glob
from hashlib import sha256
from itertools import accumulate
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "path string, slide_number int, element_id string, kind string, name string, x long, y long, width long, height long, z_index int, parent_id string, hidden boolean, text string, table_json string, notes string, slide_width long, slide_height long, paragraphs_json string, media_part string, media_sha256 string, crop array<double>, error string"
MEDIA = "path string, part string, sha256 string, content binary"

# XML namespaces of the format.
A = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
P = "{http://schemas.openxmlformats.org/presentationml/2006/main}"
R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
REL = "{http://schemas.openxmlformats.org/package/2006/relationships}"

Matrix = tuple[float, float, float, float, float, float]
IDENTITY: Matrix = (1, 0, 0, 1, 0, 0)


def compose(m: Matrix, n: Matrix) -> Matrix:
    """First n, then m."""
    a, b, c, d, e, f = m
    g, h, i, j, k, o = n
    return a * g + c * h, b * g + d * h, a * i + c * j, b * i + d * j, a * k + c * o + e, b * k + d * o + f


def apply(m: Matrix, x: float, y: float) -> tuple[float, float]:
    return m[0] * x + m[2] * y + m[4], m[1] * x + m[3] * y + m[5]


def placed(x: float, y: float, w: float, h: float, rotation: float, flip_h: bool, flip_v: bool) -> Matrix:
    """Rotation (degrees) and flips about the middle of a box."""
    t = math.radians(rotation)
    cos, sin = math.cos(t), math.sin(t)
    cx, cy = x + w / 2, y + h / 2
    turn = (cos, sin, -sin, cos, 0, 0)
    flip = (-1 if flip_h else 1, 0, 0, -1 if flip_v else 1, 0, 0)
    return compose((1, 0, 0, 1, cx, cy), compose(turn, compose(flip, (1, 0, 0, 1, -cx, -cy))))


def bounds(m: Matrix, x: float, y: float, w: float, h: float) -> tuple[int, int, int, int]:
    """Upright box around a transformed one: left and top rounded down, extent up."""
    points = [apply(m, *p) for p in ((x, y), (x + w, y), (x, y + h), (x + w, y + h))]
    left, top = (math.floor(min(p[i] for p in points) + 1e-6) for i in (0, 1))
    return left, top, *(math.ceil(max(p[i] for p in points) - 1e-6) - v for i, v in ((0, left), (1, top)))


def number(value, default: int = 0) -> int:
    try:
        return int(float(value))
    except (TypeError, ValueError):
        return default


class DeckError(ValueError):
    """A part of a deck that can't be read, where strict reading was asked for."""


def relations(archive: zipfile.ZipFile, part: str, external: bool = False) -> dict[str, tuple[str, str]]:
    """Relation id -> (kind, part) of a part's internal relations, or (kind, address) of its external ones."""
    folder, name = posixpath.split(part)
    try:
        root = ElementTree.fromstring(archive.read(f"{folder}/_rels/{name}.rels"))
    except KeyError:
        return {}
    found = [r for r in root.iter(f"{REL}Relationship") if (r.get("TargetMode") == "External") == external]
    target = (lambda t: t) if external else lambda t: posixpath.normpath(posixpath.join(folder, t).replace("//", "/")).lstrip("/")
    return {r.get("Id"): (r.get("Type", "").rsplit("/", 1)[-1], target(r.get("Target", ""))) for r in found}


@dataclass
class Slide:
    """What reading a slide's shapes needs besides them: its number, its relations and the deck's media by part."""

    number: int
    inner: dict[str, tuple[str, str]]
    outer: dict[str, tuple[str, str]]
    digest: Callable[[str], str | None]
    images: bool = False
    strict: bool = False
    z: int = 0


def paragraphs(body) -> str:
    """Text of a body, or of a list of paragraphs, line by line."""
    if body is None:
        return ""
    lines = []
    for p in body if isinstance(body, list) else body.iter(f"{A}p"):
        lines.append("".join((n.text or "") if n.tag == f"{A}t" else "\n" for n in p.iter() if n.tag in (f"{A}t", f"{A}br")))
    return "\n".join(lines).replace("\v", "\n")


_ON = ("1", "true", "on")


def run_data(run, outer: dict[str, tuple[str, str]]) -> dict:
    """Text and what its own properties say of font, size in points, bold, italic, underline and hyperlink."""
    own = run.find(f"{A}rPr")
    out = {"text": (run.findtext(f"{A}t") or "").replace("\v", "\n")}
    if own is None:
        return out
    font, link = own.find(f"{A}latin"), own.find(f"{A}hlinkClick")
    said = {
        "font_name": font.get("typeface") if font is not None else None,
        "font_size_pt": number(own.get("sz")) / 100 if own.get("sz") else None,
        "bold": own.get("b") in _ON if own.get("b") else None,
        "italic": own.get("i") in _ON if own.get("i") else None,
        "underline": own.get("u") != "none" if own.get("u") else None,
        "hyperlink": outer.get(link.get(f"{R}id"), ("", None))[1] if link is not None else None,
    }
    return out | {k: v for k, v in said.items() if v is not None}


def paragraph_data(body, outer: dict[str, tuple[str, str]]) -> list[dict]:
    """Every paragraph's text, level, alignment, bullet and runs."""
    out = []
    for p in body.iter(f"{A}p") if body is not None else ():
        own = p.find(f"{A}pPr")
        data = {"text": paragraphs([p]), "level": number(own.get("lvl")) if own is not None else 0, "runs": [run_data(r, outer) for r in p.findall(f"{A}r")]}
        if own is not None and own.get("algn"):
            data["alignment"] = own.get("algn")
        for tag, kind, value in (("buChar", "character", "char"), ("buAutoNum", "number", "type"), ("buNone", "none", None)):
            if own is not None and (mark := own.find(f"{A}{tag}")) is not None:
                data["bullet"] = {"kind": kind} | ({"value": mark.get(value)} if value else {})
                break
        out.append(data)
    return out


def table_json(table, m: Matrix = IDENTITY, frame: tuple[int, int, int, int] = (0, 0, 0, 0), outer: dict | None = None) -> str:
    """Rows, columns and the cells that no other covers, with spans, paragraphs and boxes, as JSON. A box comes from the summed
    widths and heights of the grid, scaled to the shape's frame (x, y, width, height) and placed in slide space."""
    rows, grid = table.findall(f"{A}tr"), table.findall(f"{A}tblGrid/{A}gridCol")
    columns = len(grid)
    right, down_to = ([0, *accumulate(number(n.get(k)) for n in nodes)] for nodes, k in ((grid, "w"), (rows, "h")))
    x0, y0, width, height = frame
    wide, high = (whole / ends[-1] if ends[-1] else 1.0 for whole, ends in ((width, right), (height, down_to)))
    cells = []
    for y, row in enumerate(rows):
        for x, cell in enumerate(row.findall(f"{A}tc")):
            if cell.get("hMerge") in _ON or cell.get("vMerge") in _ON:
                continue
            down, across = (max(1, min(number(cell.get(k), 1), most)) for k, most in (("rowSpan", len(rows) - y), ("gridSpan", columns - x)))
            box = bounds(m, x0 + right[x] * wide, y0 + down_to[y] * high, (right[min(x + across, columns)] - right[x]) * wide, (down_to[y + down] - down_to[y]) * high)
            body = cell.find(f"{A}txBody")
            cells.append({"row": y, "column": x, "text": paragraphs(body), "row_span": down, "column_span": across, "is_merge_origin": True, "bbox": box, "paragraphs": paragraph_data(body, outer or {})})
    return json.dumps({"rows": len(rows), "columns": columns, "cells": cells}, ensure_ascii=False)


def picture_data(shape, slide: Slide) -> dict:
    """The part and digest of a picture's bytes and the shares of its edges that are cut off: left, top, right, bottom."""
    blip, cut = next(shape.iter(f"{A}blip"), None), next(shape.iter(f"{A}srcRect"), None)
    part = slide.inner.get(blip.get(f"{R}embed"), ("", None))[1] if blip is not None else None
    edges = [number(cut.get(k)) / 100_000 for k in "ltrb"] if cut is not None else [0.0] * 4
    return {"media_part": part, "media_sha256": slide.digest(part) if part else None, "crop": edges}


def kind_of(shape) -> str:
    tag = shape.tag.rsplit("}", 1)[-1]
    if tag == "grpSp":
        return "group"
    if tag == "pic":
        media = shape.find(f"{P}nvPicPr/{P}nvPr")
        return "media" if media is not None and any(n.tag.endswith(("videoFile", "audioFile")) for n in media.iter()) else "image"
    if tag == "graphicFrame":
        uri = next((d.get("uri", "") for d in shape.iter(f"{A}graphicData")), "")
        return next((k for k, s in (("table", "/table"), ("chart", "/chart"), ("diagram", "/diagram"), ("ole", "/ole")) if uri.endswith(s)), "shape")
    return "text" if paragraphs(shape.find(f"{P}txBody")).strip() else "shape"


def shapes(tree, m: Matrix, slide: Slide, parent: str | None = None, path: tuple = (), hidden: bool = False) -> Iterator[dict]:
    """Depth first; a group's children are placed by the group's transform into slide space."""
    drawn = [s for s in tree if s.tag.rsplit("}", 1)[-1] in ("sp", "pic", "grpSp", "graphicFrame", "cxnSp")]
    for i, shape in enumerate(drawn, 1):
        own_path = (*path, i)
        info = next((n for n in shape.iter() if n.tag == f"{P}cNvPr"), None)
        own_id = f"s{slide.number:04d}-p{'.'.join(map(str, own_path))}-id{info.get('id') if info is not None else i}"
        try:
            kind = kind_of(shape)
            if kind == "image" and not slide.images:
                continue
            slide.z += 1
            own, turned, inner = shape_data(shape, kind, m, slide)
        except Exception as e:  # noqa: BLE001  whatever a broken shape raises is a row
            yield failed(slide, own_id, e) | {"parent_id": parent}
            continue
        concealed = hidden or (info is not None and info.get("hidden") in _ON)
        yield {"slide_number": slide.number, "element_id": own_id, "kind": kind, "name": info.get("name") if info is not None else None, "z_index": slide.z, "parent_id": parent, "hidden": concealed} | own
        if kind == "group":
            yield from shapes(shape, inner, slide, own_id, own_path, concealed)


def failed(slide: Slide, element_id: str, error: Exception) -> dict:
    """The row of what can't be read; an error where reading is strict."""
    said = f"{type(error).__name__}: {error}"[:500]
    if slide.strict:
        raise DeckError(f"slide {slide.number}, {element_id}: {said}") from error
    return {"slide_number": slide.number, "element_id": element_id, "kind": "error", "z_index": slide.z, "hidden": False, "error": said}


def shape_data(shape, kind: str, m: Matrix, slide: Slide) -> tuple[dict, Matrix, Matrix]:
    """Place and content of a shape, its transform, and that of its children."""
    frame = next((n for n in (shape.find(f"{P}xfrm"), shape.find(f"{P}spPr/{A}xfrm"), shape.find(f"{P}grpSpPr/{A}xfrm")) if n is not None), None)
    off, ext = (frame.find(f"{A}off"), frame.find(f"{A}ext")) if frame is not None else (None, None)
    x, y = (number(off.get(k)) if off is not None else 0 for k in ("x", "y"))
    w, h = (number(ext.get(k)) if ext is not None else 0 for k in ("cx", "cy"))
    turned = compose(m, placed(x, y, w, h, number(frame.get("rot")) / 60000 if frame is not None else 0, frame is not None and frame.get("flipH") == "1", frame is not None and frame.get("flipV") == "1"))
    left, top, width, height = bounds(turned, x, y, w, h)
    out = {"x": left, "y": top, "width": width, "height": height, "text": "", "table_json": None}
    body = shape.find(f"{P}txBody")
    if kind in ("text", "shape"):
        out |= {"text": paragraphs(body), "paragraphs_json": json.dumps(paragraph_data(body, slide.outer), ensure_ascii=False) if body is not None else None}
    table = next((t for t in shape.iter(f"{A}tbl")), None) if kind == "table" else None
    if table is not None:
        out["table_json"] = table_json(table, turned, (x, y, w, h), slide.outer)
    if kind == "image":
        out |= picture_data(shape, slide)
    inner = turned
    child_off, child_ext = (frame.find(f"{A}chOff"), frame.find(f"{A}chExt")) if kind == "group" and frame is not None else (None, None)
    if child_off is not None and child_ext is not None:
        cx, cy = number(child_ext.get("cx")), number(child_ext.get("cy"))
        sx, sy = w / cx if cx else 1, h / cy if cy else 1
        inner = compose(turned, (sx, 0, 0, sy, x - sx * number(child_off.get("x")), y - sy * number(child_off.get("y"))))
    return out, turned, inner


def deck(data: bytes, images: bool = False, strict: bool = False) -> Iterator[dict]:
    """Elements of one deck, slides in show order."""
    try:
        archive = zipfile.ZipFile(io.BytesIO(data))
        main = "ppt/presentation.xml"
        root, links = ElementTree.fromstring(archive.read(main)), relations(archive, main)
        size, entries = root.find(f"{P}sldSz"), list(root.iter(f"{P}sldId"))
        whole = {"slide_width": number(size.get("cx")), "slide_height": number(size.get("cy"))}
    except Exception as e:  # noqa: BLE001
        yield failed(Slide(0, {}, {}, str, images, strict), "deck", e)
        return
    known: dict[str, str | None] = {}

    def digest(part: str) -> str | None:
        if part not in known:
            known[part] = sha256(archive.read(part)).hexdigest() if part in archive.NameToInfo else None
        return known[part]

    with archive:
        for i, entry in enumerate(entries, 1):
            own = Slide(i, {}, {}, digest, images, strict)
            try:
                part = links[entry.get(f"{R}id")][1]
                tree = ElementTree.fromstring(archive.read(part)).find(f"{P}cSld/{P}spTree")
                own.inner, own.outer = relations(archive, part), relations(archive, part, external=True)
                both = whole | {"notes": notes_of(archive, own)}
                drawn = list(tree)
            except Exception as e:  # noqa: BLE001
                yield failed(own, f"s{i:04d}", e) | whole
                continue
            for e in shapes(drawn, IDENTITY, own):
                yield e | both


def notes_of(archive: zipfile.ZipFile, slide: Slide) -> str | None:
    note = next((p for k, p in slide.inner.values() if k == "notesSlide"), None)
    out = None
    for s in ElementTree.fromstring(archive.read(note)).iter(f"{P}sp") if note else ():
        holder = s.find(f"{P}nvSpPr/{P}nvPr/{P}ph")
        if holder is not None and holder.get("type") == "body":
            out = paragraphs(s.find(f"{P}txBody"))
    return out


def media(data: bytes) -> Iterator[tuple[str, str, bytes]]:
    """(part, digest, bytes) of a deck's media; a deck that is no archive has none."""
    try:
        archive = zipfile.ZipFile(io.BytesIO(data))
    except zipfile.BadZipFile:
        return
    with archive:
        for part in sorted(n for n in archive.namelist() if n.startswith("ppt/media/") and not n.endswith("/")):
            content = archive.read(part)
            yield part, sha256(content).hexdigest(), content


def properties(data: bytes) -> dict[str, str]:
    """Core properties of a deck by name."""
    with zipfile.ZipFile(io.BytesIO(data)) as archive:
        try:
            root = ElementTree.fromstring(archive.read("docProps/core.xml"))
        except KeyError:
            return {}
    return {n.tag.rsplit("}", 1)[-1]: n.text for n in root if n.text}


COLUMNS = [re.split(r"\s+", c.strip())[0] for c in SCHEMA.split(",")]


class _File(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


class DeckReader(DataSourceReader):
    def __init__(self, options: dict):
        on = lambda key: str(options.get(key, "false")).lower() == "true"
        self.root, self.images, self.strict = options["path"], on("include_images"), on("strict")

    def partitions(self):
        found = sorted(glob(f"{self.root}/**/*.pptx", recursive=True)) if not self.root.endswith(".pptx") else [self.root]
        return [_File(p) for p in found if not posixpath.basename(p).startswith("~$")]

    def read(self, partition):
        with open(partition.path, "rb") as f:
            data = f.read()
        for e in deck(data, self.images, self.strict):
            yield tuple({"path": partition.path, **e}.get(c) for c in COLUMNS)


class DeckSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "deck"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DeckReader:
        return DeckReader(self.options)


def decks(spark: SparkSession, path: str, images: bool = False, strict: bool = False) -> DataFrame:
    """Elements of all decks below a path of any store."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.pptx").option("recursiveFileLookup", "true").load(path)
    return deck_elements(found.where(~F.element_at(F.split("path", "/"), -1).startswith("~$")), images, strict)


def deck_elements(files: DataFrame, images: bool = False, strict: bool = False) -> DataFrame:
    """The same rows from a binaryFile table (path, content), wherever its files are."""

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for p, c in zip(pdf["path"], pdf["content"], strict=True):
                yield pd.DataFrame([[({"path": p} | e).get(k) for k in COLUMNS] for e in deck(c, images, strict)], columns=COLUMNS, dtype=object)

    return files.select("path", "content").mapInPandas(rows, SCHEMA)


def deck_media(files: DataFrame) -> DataFrame:
    """(path, part, sha256, content): the media parts of decks as rows, one at a time."""

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for p, c in zip(pdf["path"], pdf["content"], strict=True):
                for part, digest, content in media(c):
                    yield pd.DataFrame([(p, part, digest, content)], columns=["path", "part", "sha256", "content"])

    return files.select("path", "content").mapInPandas(rows, MEDIA)
