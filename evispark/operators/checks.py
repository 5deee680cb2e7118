"""Violation queries: rows (check_code, severity, key, detail); none where all is well. fail_closed() turns errors into one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evispark.functions import columns as C
from evispark.functions import patterns
from evispark.functions.udfs import call
from evispark.operators import geometry
from evispark.session import cut


class CheckError(ValueError):
    """Raised where a violation of severity error stands."""


def rows(df: DataFrame, code: str, key: Column, detail: Column | None = None, severity: str = "error") -> DataFrame:
    none = F.lit(None) if detail is None else detail
    return df.select(F.lit(code).alias("check_code"), F.lit(severity).alias("severity"), key.cast("string").alias("key"), none.cast("string").alias("detail"))


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def fail_closed(violations: DataFrame, shown: int = 20) -> None:
    found = violations.where("severity = 'error'").limit(shown).collect()
    if found:
        raise CheckError("; ".join(f"{r.check_code}: {r.key}" for r in found))


def duplicates(df: DataFrame, key: list[str], code: str) -> DataFrame:
    many = df.groupBy(*key).count().where("count > 1")
    return rows(many, code, F.concat_ws("/", *(F.col(c).cast("string") for c in key)), F.col("count"))


def missing(df: DataFrame, known: DataFrame, key: list[str], code: str) -> DataFrame:
    """Rows of df whose key is not known."""
    return rows(df.join(known, key, "left_anti"), code, F.concat_ws("/", *(F.col(c).cast("string") for c in key)))


def bad_values(df: DataFrame, code: str, key: Column, wrong: Column, detail: Column | None = None, severity: str = "error") -> DataFrame:
    return rows(df.where(wrong), code, key, detail, severity)


def slide_checks(elements: DataFrame, width: int, height: int) -> DataFrame:
    """Duplicate ids, boxes outside the slide and numeric conflicts between native and read text."""
    key = F.concat_ws("/", F.col("slide_number").cast("string"), F.col("element_id").cast("string"))
    clash = geometry.numeric_conflicts(geometry.overlaps(elements), geometry.raw_numbers)
    return union([
        duplicates(elements, ["slide_number", "element_id"], "duplicate-element-id"),
        rows(geometry.outside_slide(elements, width, height), "element-outside-slide", key, severity="warning"),
        rows(clash, "numeric-conflict", F.concat_ws("/", F.col("slide_number").cast("string"), F.col("a_element_id").cast("string"), F.col("b_element_id").cast("string")), F.concat_ws("|", F.array_join("a_numbers", ","), F.array_join("b_numbers", ","))),
    ])


def raster_tables(elements: DataFrame) -> DataFrame:
    """Tables read from pictures, whose borders nothing vouches for: element ids with parent_id and kind."""
    parents = elements.select("slide_number", F.col("element_id").alias("parent_id"), F.col("kind").alias("parent_kind"))
    read = elements.where("kind = 'table' and source <> 'native'").join(parents, ["slide_number", "parent_id"])
    return rows(read.where(F.col("parent_kind").isin(*patterns.VISUAL_KINDS)), "raster-table-boundary-unverified", F.concat_ws("/", F.col("slide_number").cast("string"), F.col("element_id").cast("string")), severity="warning")


def table_checks(tables: DataFrame) -> DataFrame:
    """Cells outside the grid and spans beyond it. tables: (table_id, rows, columns, cells)."""
    cell = tables.select("table_id", "rows", "columns", F.posexplode("cells").alias("i", "c")).where("c.is_merge_origin is null or c.is_merge_origin")
    key = F.concat_ws("/", F.col("table_id").cast("string"), F.col("i").cast("string"))
    out = (F.col("c.row") < 0) | (F.col("c.column") < 0) | (F.col("c.row") >= F.col("rows")) | (F.col("c.column") >= F.col("columns"))
    wide = (F.col("c.row_span") < 1) | (F.col("c.column_span") < 1) | (F.col("c.row") + F.col("c.row_span") > F.col("rows")) | (F.col("c.column") + F.col("c.column_span") > F.col("columns"))
    return union([bad_values(cell, "invalid-table-cell", key, out), bad_values(cell, "invalid-table-span", key, ~out & wide)])


def text_checks(df: DataFrame, key: Column, text: Column) -> DataFrame:
    return union([bad_values(df, "dangerous-html", key, C.is_dangerous(text)), bad_values(df, "control-character", key, C.controls_in(text))])


def id_checks(df: DataFrame, column: str) -> DataFrame:
    return bad_values(df, "unsafe-id", F.col(column), ~F.col(column).rlike(patterns.SAFE_ID))


def digest_checks(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files that a manifest lacks, lists in vain, or lists with another digest. Both: (name, sha256)."""
    both = files.withColumnRenamed("sha256", "is").join(manifest.withColumnRenamed("sha256", "should"), "name", "full_outer")
    code = F.when(F.col("should").isNull(), "undeclared-file").when(F.col("is").isNull(), "missing-file").when(F.col("is") != F.col("should"), "digest-mismatch")
    return both.withColumn("check_code", code).where("check_code is not null").select("check_code", F.lit("error").alias("severity"), F.col("name").alias("key"), F.col("is").alias("detail"))


def changed_rows(stored: DataFrame, derived: DataFrame, key: str) -> DataFrame:
    """Rows that only one side has: what a table says against what its sources give."""
    return union([rows(stored.exceptAll(derived), "not-derivable", F.col(key)), rows(derived.exceptAll(stored), "not-stored", F.col(key))])


def grounding(pages: DataFrame, text: str = "body", allowed: str = "citations", evidence: str = "evidence", key: str = "page_id") -> DataFrame:
    """Every breach of the citation contract of pages, a row each."""
    found = pages.select(key, F.explode(call("grounding_errors", text, allowed, evidence)).alias("e"))
    return found.select(F.substring_index("e", ":", 1).alias("check_code"), F.lit("error").alias("severity"), F.col(key).cast("string").alias("key"), F.regexp_replace("e", "^[^:]*:", "").alias("detail"))


def line_grounding(lines: DataFrame, facts: DataFrame) -> DataFrame:
    """Numbers of a line that none of its own citations has. lines: (page_id, line_no, line); facts: (citation, number).

    A line's citations meet its own claims before the facts, so a citation of many facts makes no more rows than there are
    claims; what meets a fact is taken off by an anti join."""
    line = ["page_id", "line_no"]
    claimed = cut(lines.select(*line, F.explode(call("prose_numbers", F.col("line"))).alias("number")))
    cited = lines.select(*line, F.explode(C.citations_in(F.col("line"))).alias("citation"))
    known = claimed.join(cited, line).join(facts, ["citation", "number"], "left_semi").select(*line, "number").distinct()
    return rows(claimed.join(known, [*line, "number"], "left_anti"), "borrowed-number", F.concat_ws("/", F.col("page_id").cast("string"), F.col("line_no").cast("string")), F.col("number"))


def array_checks(df: DataFrame, key: str, stored: str, derived: str, code: str) -> DataFrame:
    """Rows whose stored array is not the derived one, as sets."""
    return bad_values(df, code, F.col(key), F.array_sort(F.array_distinct(stored)) != F.array_sort(F.array_distinct(derived)))
