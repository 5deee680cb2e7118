"""Suffix-array dedup on sparse suffix arrays: of every text only the suffixes at content-selected minimiser positions are
kept, sorted over the cluster and compared with their neighbours; what they share is extended right and left.

1. Suffixes are sorted by the digest of their first words (the minimiser) and of their reach, all words around it that a
   window of the threshold length can hold. Those whose minimiser no neighbour shares are dropped; places of one whole reach
   are one entry of the array, and all but the first are later copies as they stand.
2. Entries whose minimiser has several reaches are sorted by their words from the minimiser on. The longest prefix that an
   entry shares with any other is the one it shares with a neighbour, counted in words: it bounds how far a copied passage
   extends to the right. The same array sorted by the words before the minimiser, backwards, bounds the extension to the left.
3. Windows that both bounds allow are few; they are sorted with those of other entries, and the first of equals stays. Equal
   reaches and windows are told by two independent digests of 64 bits, the minimiser's and their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evispark.llm import shared
from evispark.llm.spans import common_words, contexts, keyed, spans, window_rows, without
from evispark.llm.textkit import Words

WIDTH = 50


def neighbours(sorted_rows: DataFrame, first: str, second: str, place: list[str]) -> DataFrame:
    """Add `shared` (a neighbour has the same `first`) and `copy` (the row before has the same `first` and `second`). Rows
    that repeat the row before in these and in `place` are left out.

    Rows come range-sorted. The first and last row of a partition may have neighbours elsewhere: they count as shared, and
    the first as no copy, which the caller settles over the few rows that remain.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, before = None, None

        def compare(batch: pa.RecordBatch, after: tuple | None) -> pa.RecordBatch:
            a, b, *where = (batch.column(c).to_numpy(zero_copy_only=False) for c in (first, second, *place))
            new = np.ones(len(a), dtype=bool)
            if len(a) > 1:
                new[1:] = np.any([x[1:] != x[:-1] for x in (a, b, *where)], axis=0)
            same = np.ones(len(a) + 1, dtype=bool)
            same[1:-1] = a[1:] == a[:-1]
            copy = np.zeros(len(a), dtype=bool)
            copy[1:] = same[1:-1] & (b[1:] == b[:-1])
            if before is not None:
                same[0] = before[0] == a[0]
                copy[0] = before[:2] == (a[0], b[0])
                new[0] = before != (a[0], b[0], *(x[0] for x in where))
            if after is not None:
                same[-1] = after[0] == a[-1]
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(same[:-1] | same[1:]), pa.array(copy)], names=[*batch.schema.names, "shared", "copy"]).filter(pa.array(new))

        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                yield compare(held, (batch.column(first)[0].as_py(), None))
                before = tuple(held.column(c)[-1].as_py() for c in (first, second, *place))
            held = batch
        if held is not None:
            yield compare(held, None)

    return sorted_rows.mapInArrow(shared.tidy(rows), shared.ddl(sorted_rows.schema) + ", shared boolean, copy boolean")


def ranged(df: DataFrame, *by: str) -> DataFrame:
    return df.repartitionByRange(shared.partitions(df.sparkSession), *by).sortWithinPartitions(*by)


def longest_shared(entries: DataFrame, side: str, *before: str) -> DataFrame:
    """Add `common`: how many words of its context `side` a row shares at most with another row of the same `before` columns.

    The array is sorted by `before` and the context's bytes; whatever shares most of a context stands next to it, so only
    neighbours are compared. The first and last row of a partition may have neighbours elsewhere: they keep all words.
    """
    place = [c for c in ("doc_id", "k", "low") if c in entries.columns]
    array = ranged(entries, *before, side, *place)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, link = None, None  # a batch whose last row waits for its neighbour; what its first row shares with the row before

        def finish(batch: pa.RecordBatch, last: int | None, x: list[bytes], links: list[int]) -> pa.RecordBatch:
            n = len(x)
            out = [max(([links[i - 1]] if i else [link if link is not None else x[i].count(b" ")]) + ([links[i]] if i < n - 1 else [last if last is not None else x[i].count(b" ")])) for i in range(n)]
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int32())], names=[*batch.schema.names, "common"])

        for batch in batches:
            if not batch.num_rows:
                continue
            x, own = batch.column(side).to_pylist(), list(zip(*(batch.column(c).to_pylist() for c in before), strict=True)) if before else [()] * batch.num_rows
            links = [common_words(x[i], x[i + 1]) if own[i] == own[i + 1] else 0 for i in range(len(x) - 1)]
            if held is not None:
                last = common_words(held[1][-1], x[0]) if held[3] == own[0] else 0
                yield finish(held[0], last, held[1], held[2])
                link = last
            held = batch, x, links, own[-1]
        if held is not None:
            yield finish(held[0], None, held[1], held[2])

    return array.mapInArrow(shared.tidy(rows), shared.ddl(entries.schema) + ", common int")


def later_copies(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(k, low, windows): runs of windows whose words also start at an earlier place, of (k, doc_id, text) rows.

    Places are ordered by doc_id, then k, then word; a null id comes first.
    """
    at = ["doc_id", "k", "low"]
    every = shared.written(spans(docs, width, with_id=True), "suffixes")
    place = ["anchor", "span", "doc_id", "k", "low"]
    kept = shared.written(neighbours(ranged(every, *place), "anchor", "span", ["k", "low"]).where("shared").drop("shared"), "shared")
    shared.discard(every)
    # the first place of every reach, and others that only stand first in their partition
    heads = kept.where(~F.col("copy"))
    kinds = heads.groupBy("anchor", "span").agg(F.min(F.struct(*at, "at", "windows")).alias("one"), F.count("*").alias("n"))
    kinds = shared.written(kinds.select("anchor", "span", "n", "one.*"), "kinds")
    again = kinds.where("n > 1").select("anchor", "span", *(F.col(c).alias(f"first_{c}") for c in at))
    parted = heads.join(again, ["anchor", "span"]).where(~((F.col("k") == F.col("first_k")) & (F.col("low") == F.col("first_low"))))
    copies = shared.written(kept.where("copy").select("k", "low", "windows").union(parted.select("k", "low", "windows")), "copies")
    shared.discard(kept)
    # what is joined is written first: Spark can split a join's hot keys only where both sides are dealt out for it
    mixed = shared.written(kinds.groupBy("anchor").count().where("count > 1").select("anchor"), "mixed")
    chosen = kinds.join(mixed, "anchor", "left_semi").select("anchor", *at, "at", "windows")
    words = shared.written(contexts(docs, chosen, width), "words")  # a range sort reads its input twice
    # rightwards: a window fits only where the words from the anchor to its end stand elsewhere too
    right = longest_shared(words, "right").withColumn("from_word", F.col("low"))
    right = right.withColumn("windows", F.least(F.col("windows").cast("int"), F.col("at") + F.col("common") - (width - 1))).where("windows > 0")
    right = shared.written(right.drop("common"), "right")
    shared.discard(words, kinds, mixed)
    # leftwards: so must the words before the anchor
    left = longest_shared(right, "left", "anchor").withColumn("skip", F.greatest(F.lit(0), F.col("at") - F.col("common")))
    left = left.withColumn("low", F.col("low") + F.col("skip")).withColumn("windows", F.col("windows") - F.col("skip")).where("windows > 0")
    looked = shared.written(window_rows(left, width, ["doc_id", "k"]), "windows")
    met = neighbours(ranged(looked, "anchor", "window", "doc_id", "k", "start"), "window", "anchor", ["k", "start"]).where("shared")
    met = shared.written(met.drop("shared", "copy"), "met")
    shared.discard(right, looked)
    first = met.groupBy("anchor", "window").agg(F.min(F.struct("doc_id", "k", "start")).alias("one"), F.count("*").alias("n")).where("n > 1")
    first = shared.written(first, "first")
    partly = met.join(first, ["anchor", "window"]).where(~F.struct("doc_id", "k", "start").eqNullSafe(F.col("one")))
    partly = shared.written(partly.select("k", F.col("start").alias("low"), F.lit(1).cast("short").alias("windows")), "partly")
    shared.discard(met, first)
    return copies.union(partly)


def remaining_bytes(words: Words, low: int, high: int, gone: np.ndarray | None, text: int) -> bytes:
    """The text without removed words; each goes with the white space up to the next word."""
    begin, end = int(words.text_at[text]), int(words.text_at[text + 1])
    data = words.bytes[begin:end]
    if gone is None or not gone.any():
        return data.tobytes()
    starts = words.start[low:high] - begin
    ends = np.append(starts[1:], end - begin)
    mark = np.zeros(len(data) + 1, dtype=np.int64)
    np.add.at(mark, starts[gone], 1)
    np.add.at(mark, ends[gone], -1)
    return data[np.cumsum(mark)[:-1] == 0].tobytes()


def remove_later_copies(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text", others: list[str] | None = None) -> DataFrame:
    """(doc_id, n_words, n_removed, text) of every row: passages of at least `width` words that already stand at an earlier
    place go, so that one copy of each is left in the corpus.

    A window goes if its words also start earlier, in a text with a smaller id (a null id is the smallest) or before in
    the same text; the words that such windows cover are removed, with the white space after them. Null texts have no words
    and stay null; rows that repeat id and text are each treated alike, as places of the same windows. Columns named in
    `others` follow each row; no other column plays a part. An empty table gives no rows.
    """
    own = keyed(docs, id_col, text_col, others)

    def finish(batch: pa.RecordBatch, texts: list) -> list[pa.Array]:
        removed = np.array([0 if g is None else int(g.sum()) for *_, g, _ in texts], dtype=np.int64)
        valid = np.asarray(batch.column(1).is_valid())
        left = [remaining_bytes(w, a, b, g, i).decode("utf-8", "replace") if v else None for (w, a, b, g, i), v in zip(texts, valid, strict=True)]
        return [batch.column(0), pa.array(np.array([b - a for _, a, b, _, _ in texts], dtype=np.int64)), pa.array(removed), pa.array(left, pa.string())]

    kind = dict(own.dtypes)["doc_id"]
    out = without(own, later_copies(own.select("k", "doc_id", "text"), width), width, finish, f"doc_id {kind}, n_words long, n_removed long, text string")
    return out.select("doc_id", "n_words", "n_removed", "text", "others.*") if others else out
