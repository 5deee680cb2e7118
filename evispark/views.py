"""Adapters from plain tables to the engine's tables, so that every operator has rows to work on.

blocks: source_id, slide_number, slide_title, citation, element_id, kind, content_format, content, rank.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evispark.functions.columns import citation, sha256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def blocks_conv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as decks: a slide for each turn."""
    t = table(spark, sf_dir, "conversations")
    slide = (F.col("turn") + 1).cast("int")
    return t.select(
        F.concat(F.lit("deck-"), F.col("conv_id").cast("string")).alias("source_id"),
        slide.alias("slide_number"),
        F.lit("").alias("slide_title"),
        citation(slide, F.col("role")).alias("citation"),
        F.col("role").alias("element_id"),
        F.col("role").alias("kind"),
        F.lit("text").alias("content_format"),
        F.col("text").alias("content"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("rank"),
    ).withColumn("content_sha256", sha256(F.col("content")))


def blocks_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as blocks of their source; a slide for each document. A source may hold any share of all documents."""
    element = F.concat(F.lit("doc-"), F.col("doc_id").cast("string"))
    slide = F.col("doc_id") + 1
    return (
        table(spark, sf_dir, "documents")
        .select(
            F.col("source").alias("source_id"),
            slide.alias("slide_number"),
            F.col("lang").alias("slide_title"),
            citation(slide, element).alias("citation"),
            element.alias("element_id"),
            F.lit("text").alias("kind"),
            F.lit("text").alias("content_format"),
            F.col("text").alias("content"),
            F.col("doc_id").alias("rank"),
        )
        .withColumn("content_sha256", sha256(F.col("content")))
    )


def selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in for a model's choice: good and not toxic documents, by citation."""
    chosen = table(spark, sf_dir, "labels").where("quality = 1 and toxic = 0").select(F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("element_id"))
    return blocks_doc(spark, sf_dir).join(chosen, "element_id", "left_semi").select("source_id", "citation")


SLIDE_WIDTH, SLIDE_HEIGHT = 12_192_000, 6_858_000


def elements_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as boxes on the slide of their order: integer places from their keys, native and read ones in turn."""
    t = table(spark, sf_dir, "lineitem")
    return t.select(
        F.col("l_orderkey").alias("slide_number"),
        F.col("l_linenumber").cast("int").alias("element_id"),
        F.when(F.col("l_linenumber") % 2 == 1, "native").otherwise("ocr").alias("source"),
        ((F.col("l_partkey") * 37) % 9000 * 1000).alias("x"),
        ((F.col("l_suppkey") * 91) % 5000 * 1000).alias("y"),
        (F.lit(1_000_000) + F.col("l_linenumber") * 400_000).cast("long").alias("width"),
        (F.lit(600_000) + F.col("l_linenumber") * 300_000).cast("long").alias("height"),
        F.col("l_quantity").cast("long").cast("string").alias("text"),
    )


def order_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table for each order: a head and a row for each line, as (table_id, matrix)."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.array(F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string"), F.col("l_returnflag")).alias("cells"))
    rows = lines.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "cells"))).alias("r"))
    head = F.array(F.array(F.lit("line"), F.lit("part"), F.lit("flag")))
    return rows.select(F.col("l_orderkey").alias("table_id"), F.concat(head, F.col("r.cells")).alias("matrix"))
