"""Exact duplicates, ledgers of request numbers, and the keep, duplicate or omit decision for every block."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evispark.functions.udfs import call
from evispark.session import cut


def content_digests(blocks: DataFrame) -> DataFrame:
    """(source_id, citation, rank, digest): digest of kind, format and content after NFKC, spaces collapsed.

    Spark runs a Python kernel for every row of a branch that names it, so ASCII rows, which NFKC leaves alone, are a branch
    of their own without it.
    """
    ascii_only = ~F.coalesce(F.col("content"), F.lit("")).rlike(r"[^\x00-\x7F]")
    plain = F.trim(F.regexp_replace("content", r"[ \t\n\x0B\f\r\x1c-\x1f]+", " "))
    digest = lambda collapsed: F.sha2(F.concat_ws("\x1f", "kind", "content_format", collapsed), 256).alias("digest")
    key = ["source_id", "citation", "rank"]
    return blocks.where(ascii_only).select(*key, digest(plain)).union(blocks.where(~ascii_only).select(*key, digest(call("collapse_text", F.col("content")))))


def exact_duplicates(blocks: DataFrame, protected: DataFrame | None = None, digests: DataFrame | None = None) -> DataFrame:
    """(source_id, citation, duplicate_of): blocks that repeat an earlier one of their source. Protected blocks are no copies.

    Texts are digested once; their digests and the first of each are cut off as tables of their own, so that the join deals
    out both sides and Spark can split a text that a source repeats very often.
    """
    keyed = cut(content_digests(blocks) if digests is None else digests)
    first = cut(keyed.groupBy("source_id", "digest").agg(F.min_by("citation", "rank").alias("duplicate_of"), F.min("rank").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"))
    copies = keyed.join(first, ["source_id", "digest"]).where("rank > first").select("source_id", "citation", "duplicate_of")
    return cut(copies if protected is None else copies.join(protected, ["source_id", "citation"], "left_anti"))


def request_ledger(blocks: DataFrame) -> DataFrame:
    """(source_id, citation, rank, position, value, canonical_key): distinct request numbers of each block."""
    visible = F.concat_ws("\n", F.coalesce("slide_title", F.lit("")), F.coalesce("content", F.lit("")))
    hits = blocks.where(visible.rlike(r"(?i)pr|의뢰")).select("source_id", "citation", "slide_number", "element_id", "rank", F.posexplode(call("request_numbers", visible)).alias("position", "value"))
    return hits.withColumn("canonical_key", call("request_key", F.col("value")))


def inventory(ledger: DataFrame) -> DataFrame:
    """(source_id, values): a spelling for each key, the first; in the order of first places."""
    first = ledger.groupBy("source_id", "canonical_key").agg(F.min(F.struct("rank", "position", "value")).alias("f"))
    return first.groupBy("source_id").agg(F.transform(F.sort_array(F.collect_list("f")), lambda s: s["value"]).alias("values"))


def by_citation(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("source_id", "citation").agg(F.transform(F.sort_array(F.collect_list(F.struct("position", "value"))), lambda s: s["value"]).alias("values"))


def decisions(blocks: DataFrame, selected: DataFrame, protected: DataFrame, duplicates: DataFrame, complete: bool = False) -> DataFrame:
    """(source_id, citation, disposition, reason_code, duplicate_of) for every block.

    Protected blocks are kept; then copies are duplicates; then selected ones are kept, and so are the originals of
    selected copies. If a source's selection is empty, or `complete` is set, all of it is selected. The rest is omitted.
    """
    key = ["source_id", "citation"]
    promoted = selected.join(duplicates, key).select("source_id", F.col("duplicate_of").alias("citation"))
    # cut, so that each join deals out both sides for itself and Spark can split a source of any size
    chosen = cut(selected.select(*key).union(promoted).union(protected.select(*key)).distinct().withColumn("chosen", F.lit(True)))
    some = cut(chosen.select("source_id").distinct().withColumn("any", F.lit(True)))
    rows = blocks.select(*key).join(protected.select(*key).distinct().withColumn("safe", F.lit(True)), key, "left").join(duplicates, key, "left").join(chosen, key, "left").join(some, "source_id", "left")
    keep = F.col("chosen").isNotNull() | F.lit(complete) | F.col("any").isNull()
    kind = F.when(F.col("safe").isNotNull(), F.struct(F.lit("keep").alias("d"), F.lit("protected").alias("r")))
    kind = kind.when(F.col("duplicate_of").isNotNull(), F.struct(F.lit("duplicate").alias("d"), F.lit("exact_duplicate").alias("r")))
    kind = kind.when(keep, F.struct(F.lit("keep").alias("d"), F.lit("selected").alias("r"))).otherwise(F.struct(F.lit("omit").alias("d"), F.lit("out_of_scope").alias("r")))
    return rows.select(*key, kind.alias("k"), "duplicate_of", "safe").select(*key, F.col("k.d").alias("disposition"), F.col("k.r").alias("reason_code"), F.when(F.col("safe").isNull(), F.col("duplicate_of")).alias("duplicate_of"))


def occurrences(files: DataFrame) -> DataFrame:
    """Group occurrences (path, size, sha256) by digest: one source each, its paths in order."""
    return files.groupBy("sha256").agg(F.count("*").alias("n"), F.sort_array(F.collect_list("path")).alias("paths"))


def source_ids(digests: DataFrame, least: int = 16, step: int = 2) -> DataFrame:
    """(sha256, source_id): deck- and the shortest prefix length at which all distinct digests differ, `least` at least.

    Each length that is tried counts by prefix; only digests that still share one are counted at the next length.
    """
    distinct = cut(digests.select("sha256").distinct())
    length, same = least, distinct
    while length < 64:
        prefix = F.substring("sha256", 1, length)
        shared = same.groupBy(prefix.alias("p")).count().where("count > 1").select("p")
        same = cut(same.withColumn("p", prefix).join(shared, "p", "left_semi").drop("p"))
        if same.isEmpty():
            break
        length += step
    return distinct.select("sha256", F.concat(F.lit("deck-"), F.substring("sha256", 1, min(length, 64))).alias("source_id"))
