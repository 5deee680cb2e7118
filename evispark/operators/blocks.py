"""Blocks: reading order, contents, ids, and the pages that show them."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from evispark.functions import columns as C
from evispark.session import cut


def reading_order(elements: DataFrame, deck: list[str], explicit: str = "explicit_order", index: str = "input_index") -> DataFrame:
    """Number elements of a slide from 1: those with an explicit order first, by it; then by y, x, z and input order.

    elements has the deck's columns, y, x, z_index and the two named ones. Numbers are given before empty blocks go.
    """
    w = Window.partitionBy(*deck).orderBy(F.col(explicit).isNull(), explicit, "y", "x", "z_index", index)
    return elements.withColumn("reading_order", F.row_number().over(w))


def without_empty(blocks: DataFrame) -> DataFrame:
    return blocks.where((F.coalesce("content", F.lit("")) != "") | F.col("asset_path").isNotNull())


def keep_elements(elements: DataFrame, include_empty: bool = False) -> DataFrame:
    """Elements that show something: visual kinds, or text that is not blank."""
    from evispark.functions.patterns import VISUAL_KINDS

    return elements if include_empty else elements.where(F.col("kind").isin(*VISUAL_KINDS, "table") | (F.trim(F.coalesce("text", F.lit(""))) != ""))


def visual_targets(elements: DataFrame, policy: str = "auto") -> DataFrame:
    """Elements that a reader of images should see."""
    from evispark.functions.patterns import VISUAL_KINDS

    return elements.where(F.col("kind").isin(*VISUAL_KINDS) & F.lit(policy != "never")).withColumn("task", C.ocr_task(F.col("kind")))


def any_visual(elements: DataFrame) -> bool:
    """Is there anything that a reader of images should see? One row answers, so that rendering can be left out."""
    return not visual_targets(elements).limit(1).isEmpty()


def notes_blocks(blocks: DataFrame, notes: DataFrame, deck: list[str]) -> DataFrame:
    """Speaker notes as blocks behind a slide's kept ones. notes: deck columns and notes."""
    last = blocks.groupBy(*deck).agg(F.max("reading_order").alias("last"))
    return notes.where(F.trim("notes") != "").join(last, deck, "left").select(*deck, F.lit("notes").alias("element_id"), F.lit("notes").alias("kind"), F.col("notes").alias("content"), (F.coalesce("last", F.lit(0)) + 1).alias("reading_order"))


def unique_ids(elements: DataFrame, group: list[str], base: str, order: str, mark: str = "--") -> DataFrame:
    """element ids made unique within a group: the first keeps its id, later ones get --2, --3, ... (or another mark), each the first that
    no earlier id has.

    An id only meets ids of its family, those that differ in such endings. In most families all bases are equal: a number
    within the base tells them apart, and rows stream through a sort. Only families of several bases are gone through one by
    one in memory.
    """
    schema = StructType([*elements.schema.fields, StructField("unique_id", StringType())])
    family = F.regexp_replace(F.col(base), rf"({mark}\d+)+$", "").alias("_family")

    def assign(pdf: pd.DataFrame) -> pd.DataFrame:
        used: set[str] = set()
        out = []
        pdf = pdf.sort_values(order, kind="stable").drop(columns="_family")
        for name in pdf[base]:
            value, n = name, 1
            while value in used:
                n += 1
                value = f"{name}{mark}{n}"
            used.add(value)
            out.append(value)
        return pdf.assign(unique_id=out)

    key = [*group, "_family"]
    named = elements.withColumn("_family", family)
    several = cut(named.groupBy(*key).agg(F.min(base).alias("low"), F.max(base).alias("high")).where("low <> high").select(*key))
    number = F.row_number().over(Window.partitionBy(*group, base).orderBy(order))
    numbered = named.join(several, key, "left_anti").withColumn("n", number)
    plain = numbered.select(*elements.columns, F.when(F.col("n") == 1, F.col(base)).otherwise(F.concat(F.col(base), F.lit(mark), F.col("n").cast("string"))).alias("unique_id"))
    return plain.union(named.join(several, key, "left_semi").groupBy(*key).applyInPandas(assign, schema))


def safe_element_id(value: Column) -> Column:
    out = F.regexp_replace(F.regexp_replace(F.trim(value), r"[\s\]#]+", "-"), r"^-+|-+$", "")
    return F.when(out == "", "element").otherwise(out)


def block_markdown(anchor: Column, kind: Column, content: Column, cited: Column) -> Column:
    """A block between its comments, with its anchor and citation."""
    word = F.when(kind == "table", "TABLE").otherwise("BLOCK")
    return F.concat(F.lit("<!-- BEGIN "), word, F.lit(" "), anchor, F.lit(' -->\n<a id="'), anchor, F.lit('"></a>\n\n'), content, F.lit("\n\n"), cited, F.lit("\n<!-- END "), word, F.lit(" "), anchor, F.lit(" -->"))


def slide_pages(blocks: DataFrame, cited: Column | None = None) -> DataFrame:
    """(source_id, slide_number, page): a Markdown page for each slide, its blocks in rank order, each with its citation or what
    `cited` makes of it."""
    one = block_markdown(F.col("element_id"), F.col("kind"), F.col("content"), F.col("citation") if cited is None else cited)
    parts = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", one.alias("b")))), lambda s: s["b"]), "\n\n")
    head = F.concat(F.lit("# Slide "), F.col("slide_number").cast("string"), F.lit("\n\n"))
    return blocks.groupBy("source_id", "slide_number").agg(parts.alias("body")).select("source_id", "slide_number", F.concat(head, "body").alias("page"))


def cumulative_offsets(cells: DataFrame, group: list[str], index: list[str], size: str) -> DataFrame:
    """Start of every column or row: the sum of the sizes before it."""
    w = Window.partitionBy(*group).orderBy(*index).rowsBetween(Window.unboundedPreceding, -1)
    return cells.withColumn("offset", F.coalesce(F.sum(size).over(w), F.lit(0)))
