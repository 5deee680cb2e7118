"""Substring dedup by seed and extend: texts are joined on winnowed anchors, matches are extended both ways by words, and
maximal repeats of the threshold length or longer are kept.

1. Anchors that stand at several places are seeds. Places with one whole reach (all words around the anchor that a window of
   the threshold length can hold) are one occurrence with a count: if it counts more than one place, all of it is repeated.
2. A seed's other occurrences are joined with one of them, its representative, not with each other, and each such match is
   extended word by word to the left and to the right. What both sides share is a maximal repeat within the reach; where it
   has the threshold length, its windows are repeated on both sides.
3. Windows that the representative doesn't share may still be shared by other occurrences: they meet by the digests of
   their words, under the seed. Equal reaches and windows are told by two independent digests of 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evispark.llm import shared
from evispark.llm.spans import common_words, contexts, kept_bytes, keyed, spans, window_rows, without

WIDTH = 35


def repeated_runs(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(k, low, windows): runs of windows whose words also start elsewhere, of (k, doc_id, text) rows."""
    every = shared.written(spans(docs, width), "spans")
    # what is joined is written first: Spark can split a join's hot keys only where both sides are dealt out for it
    seeds = shared.written(every.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "seeds")
    joined = shared.written(every.join(seeds, "anchor", "left_semi"), "joined")
    shared.discard(every, seeds)
    kinds = joined.groupBy("anchor", "span").agg(F.count("*").alias("n"), F.min(F.struct("k", "low", "at", "windows")).alias("one"))
    kinds = shared.written(kinds.select("anchor", "span", "n", "one.*"), "kinds")
    whole = shared.written(joined.join(kinds.where("n > 1").select("anchor", "span"), ["anchor", "span"], "left_semi").select("k", "low", "windows"), "whole")
    shared.discard(joined)
    # anchors with different reaches of which one or more stands alone: these are to be extended
    mixed = kinds.groupBy("anchor").agg(F.count("*").alias("spans"), F.min("n").alias("least")).where("spans > 1 and least = 1").select("anchor")
    mixed = shared.written(mixed, "mixed")
    chosen = kinds.join(mixed, "anchor", "left_semi").drop("span")
    words = shared.written(contexts(docs, chosen, width).withColumn("from_word", F.col("low")), "words")
    shared.discard(kinds, mixed)
    first = words.groupBy("anchor").agg(F.min(F.struct("k", "low")).alias("one")).select("anchor", "one.*")
    first = shared.written(first.join(words, ["anchor", "k", "low"]).select("anchor", F.col("k").alias("r_k"), F.col("low").alias("r_low"), F.col("at").alias("r_at"), F.col("right").alias("r_right"), F.col("left").alias("r_left")).dropDuplicates(["anchor"]), "representatives")
    matched = shared.written(extended(words.join(first, "anchor"), width), "matched")
    shared.discard(words, first)
    repeats = shared.written(matched.where("not open").select("k", "low", "windows"), "repeats")
    left = matched.where("open")
    # of what is open, only windows that stand alone are in question; those of every occurrence may answer
    asked = shared.written(left.where("n = 1").select("anchor").distinct(), "asked")
    looked = shared.written(window_rows(left.join(asked, "anchor", "left_semi"), width, ["k", "n"]), "windows")
    shared.discard(matched, asked)
    again = looked.groupBy("anchor", "window").agg(F.sum("n").alias("total")).where("total > 1").select("anchor", "window")
    again = shared.written(again, "again")
    partly = looked.where("n = 1").join(again, ["anchor", "window"], "left_semi").select("k", F.col("start").alias("low"), F.lit(1).alias("windows"))
    partly = shared.written(partly, "partly")
    shared.discard(looked, again)
    return whole.union(repeats).union(partly)


def extended(pairs: DataFrame, width: int) -> DataFrame:
    """Extend each occurrence (anchor, k, low, at, windows, n, left, right) and its representative (r_k, r_low, r_at, r_left,
    r_right) from their common anchor both ways.

    Rows (anchor, k, low, windows, n, left, right, from_word, open): runs of repeated windows, of the occurrence and of the
    representative, and with `open` the runs of an occurrence's windows of which this match says nothing. A window that is
    equal on both sides counts as the representative's, so open windows are equal only among those of other occurrences.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, low, count, key, is_open = [], [], [], [], []

            def add(i: int, k: int, start: int, n: int, flag: bool) -> None:
                if n > 0:
                    of.append(i), key.append(k), low.append(start), count.append(n), is_open.append(flag)

            for i, r in enumerate(zip(*(batch.column(c).to_pylist() for c in ("k", "low", "at", "windows", "right", "left", "r_k", "r_low", "r_at", "r_right", "r_left")), strict=True)):
                k, at_low, at, windows, right, left, r_k, r_low, r_at, r_right, r_left = r
                if (k, at_low) == (r_k, r_low):
                    continue
                after, before = common_words(right, r_right), common_words(left, r_left)
                a, b = max(0, at - before), min(windows, at + after - width + 1)  # windows a, ..., b - 1 are equal
                if b <= a:
                    a = b = 0
                add(i, k, at_low + a, b - a, False)
                add(i, r_k, r_low + r_at - at + a, b - a, False)
                add(i, k, at_low, a, True)
                add(i, k, at_low + b, windows - b, True)
            take = pa.array(of, pa.int64())
            some = pa.array(is_open, pa.bool_())
            empty = pa.nulls(len(of), pa.binary())
            words = [pc.if_else(some, batch.column(c).take(take), empty) for c in ("left", "right")]
            yield pa.RecordBatch.from_arrays([batch.column("anchor").take(take), pa.array(key, pa.int64()), pa.array(low, pa.int32()), pa.array(count, pa.int32()), batch.column("n").take(take), *words, batch.column("from_word").take(take), some], names=["anchor", "k", "low", "windows", "n", "left", "right", "from_word", "open"])

    return pairs.mapInArrow(shared.tidy(rows), "anchor long, k long, low int, windows int, n long, left binary, right binary, from_word int, open boolean")


def remove_repeats(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) of every whole text: words in a window of `width` words whose sequence also
    starts anywhere else, in the same text or another, are removed; the others are joined by one space.

    Null and empty texts have no words. A row that repeats id and text is another place where its windows start. Null ids
    are ids like others; other columns play no part. An empty table gives no rows.
    """
    own = keyed(docs, id_col, text_col)

    def finish(batch: pa.RecordBatch, texts: list) -> list[pa.Array]:
        return [batch.column(0), *_counts(texts), pa.array([kept_bytes(w, a, b, g).decode("utf-8", "replace") for w, a, b, g, _ in texts])]

    return without(own, repeated_runs(own, width), width, finish, "doc_id long, n_words long, n_removed long, kept_text string")


def repeat_digests(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """As remove_repeats, with the SHA-256 of the kept text in its place."""
    own = keyed(docs, "doc_id", "text")

    def finish(batch: pa.RecordBatch, texts: list) -> list[pa.Array]:
        return [batch.column(0), *_counts(texts), pa.array([hashlib.sha256(kept_bytes(w, a, b, g)).hexdigest() for w, a, b, g, _ in texts])]

    return without(own, repeated_runs(own, width), width, finish, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def _counts(texts: list) -> list[pa.Array]:
    return [pa.array(np.array([b - a for _, a, b, _, _ in texts], dtype=np.int64)), pa.array(np.array([0 if g is None else int(g.sum()) for *_, g, _ in texts], dtype=np.int64))]
