"""Corpus pipeline: toxicity, quality, near-duplicates, repeated passages, packing; each stage reads what the one before kept.

SQL can't express the stages (trained models, exact tokenizers). The last three are tested against a brute-force version, the two
filters against held-out labels and the classifiers that they apply.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evispark.llm import jaccard, packing, quality, shared, suffixes, toxicity

ORACLE_SQL = None


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def _keyed(docs: DataFrame) -> DataFrame:
    """With the operators' key of id and text: ids may be null or repeat with other texts."""
    return docs.withColumn("_key", shared.row_key("doc_id", "text"))


def _kept(docs: DataFrame, good: DataFrame) -> DataFrame:
    """Rows of docs whose key is among the k of the good ones."""
    return _keyed(docs).join(good.select(F.col("k").alias("_key")).distinct(), "_key", "left_semi").select(*docs.columns)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects (score 0.3 or more) go."""
    return _kept(docs, toxicity.toxicity_scores(docs, _labels(spark, sf_dir), key=True).where("predicted = 0"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects (score under 0.3) go."""
    return _kept(docs, quality.quality_scores(docs, _labels(spark, sf_dir), key=True).where("predicted = 1"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates stays, the one with the smallest id, a null id last; of rows that
    repeat its id the one with the smallest key, of equal rows one. Texts without words are all components of their own."""
    rows = shared.written(jaccard.members(docs).groupBy("root", "doc_id", "k", "n_shingles").agg(F.count("*").alias("n")), "members")
    least = rows.where("n_shingles > 0").groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "k", "n")).alias("one"))
    first = shared.written(least.select("one.k", "one.n"), "first")
    out = _kept(docs, first.where("n = 1").select("k").union(rows.where("n_shingles = 0").select("k")))
    equal = first.where("n > 1")
    if equal.isEmpty():
        return out
    same = _keyed(docs).join(equal.select(F.col("k").alias("_key")), "_key", "left_semi")
    return out.union(same.groupBy("_key").agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*"))


def repeated_passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that stand in an earlier document go; documents stay, also where no word is left."""
    cut = suffixes.remove_later_copies(docs, others=["lang", "source", "n_chars"])
    chars = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cut.select("doc_id", "text", "lang", "source", chars.alias("n_chars"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, in token sequences of 2048."""
    return packing.best_fit(docs, public_tokenizers.path("word_bpe_49k.json"), 2048)


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("suffix-array dedup", repeated_passage_stage),
    ("best-fit packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each one's rows written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES) - 1:
            docs = shared.written(docs, f"stage{n}")
    return docs
