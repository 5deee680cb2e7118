"""Importance resampling towards a target's distribution of hashed word n-grams, with overlap chunks for long texts.

1. A text of more than `chunk_words` words is split at word boundaries. Each chunk owns its first chunk_words starting
   positions and carries n - 1 further words, so that every run of words starts in exactly one chunk. Chunks of long texts
   are dealt out over tasks by key and number; short texts are one chunk and stay where they are read.
2. A chunk's features are counted by bucket (CRC-32 of the feature modulo the number of buckets). Counts over all chunks of
   all documents, and over the target, give each bucket's gain, a table of fixed size.
3. A chunk's gains are summed by its counts, and chunks are summed by document.
4. Gumbel noise from a digest of the id makes the highest scores a weighted draw without replacement; ranks come from range
   partitions, so no task sorts more than its range.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evispark.llm import shared
from evispark.llm.textkit import Words, chunks, gather, text_bytes

#: Bytes that part words: all ASCII but digits and letters (texts are lowered first).
BREAKS = np.ones(256, dtype=bool)
BREAKS[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
CHUNK_WORDS = 4096
#: The longest step of the tables that append bytes to a CRC, and the longest word that is read byte by byte with the others.
STEP = 64

_tables: list[np.ndarray] = []


def crc_tables() -> tuple[np.ndarray, np.ndarray]:
    """(CRC-32 of a byte, [n][place][byte value] a CRC's part after n further zero bytes)."""
    if not _tables:
        one = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            one = np.where(one & 1, (one >> 1) ^ np.uint32(0xEDB88320), one >> 1)
        steps = np.zeros((STEP + 1, 4, 256), dtype=np.uint32)
        steps[0] = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]
        for n in range(1, STEP + 1):
            steps[n] = (steps[n - 1] >> 8) ^ one[steps[n - 1] & 255]
        _tables.extend((one, steps))
    return _tables[0], _tables[1]


def appended(crc: np.ndarray, length: np.ndarray, crc_after: np.ndarray) -> np.ndarray:
    """CRC-32 of a || b from those of a and of b, which has `length` bytes."""
    steps, crc, left = crc_tables()[1], crc.copy(), length.copy()
    on = np.flatnonzero(left > 0)
    while len(on):
        n, c = np.minimum(left[on], STEP), crc[on]
        crc[on] = steps[n, 0, c & 255] ^ steps[n, 1, (c >> 8) & 255] ^ steps[n, 2, (c >> 16) & 255] ^ steps[n, 3, c >> 24]
        left[on] -= n
        on = on[left[on] > 0]
    return crc ^ crc_after


def word_crcs(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of every word: step by step over the words by length, longer ones from pieces of STEP bytes."""
    length = end - start
    out = np.zeros(len(start), dtype=np.uint32)
    first = np.minimum(length, STEP)
    order = np.argsort(STEP - first.astype(np.uint8), kind="stable")
    begin, size = start[order], first[order]
    one, crc = crc_tables()[0], np.full(len(order), 0xFFFFFFFF, dtype=np.uint32)
    n = len(order)
    for at in range(int(size[0]) if n else 0):
        n = int(np.searchsorted(-size[:n], -at, side="left"))
        crc[:n] = one[(crc[:n] ^ data[begin[:n] + at]) & 255] ^ (crc[:n] >> 8)
    out[order] = ~crc
    more = np.flatnonzero(length > STEP)
    if len(more):
        rest = word_crcs(data, start[more] + STEP, end[more])
        out[more] = appended(out[more], length[more] - STEP, rest)
    return out


def histograms(words: Words, n: int, buckets: int, starts: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, count), ascending, of all runs of 1 to n words, joined by one space, that start among a text's first
    `starts` words (None: anywhere)."""
    total, doc = len(words.start), words.doc()
    at = np.arange(total)
    mine = np.ones(total, dtype=bool) if starts is None else at - words.of[doc] < starts
    left = words.of[doc + 1] - at if total else at
    length = words.end - words.start
    one = word_crcs(words.bytes, words.start, words.end)
    spaced = appended(np.full(total, 0xE96CCF45, dtype=np.uint32), length, one)  # the constant: the CRC-32 of a space
    found, crc = [doc[mine] * buckets + one[mine] % buckets], one
    for run in range(2, n + 1):
        m = max(total - run + 1, 0)
        crc = appended(crc[:m], length[run - 1 :] + 1, spaced[run - 1 :])
        whole = mine[:m] & (left[:m] >= run)
        found.append(doc[:m][whole] * buckets + crc[whole] % buckets)
    each, count = np.unique(np.concatenate(found), return_counts=True)
    return each // buckets, each % buckets, count


COUNTED = "doc_id long, key binary, chunk int, n_words long, text binary, n_features long, buckets array<int>, counts array<int>"


def _counted_batch(names: list[pa.Array], size: int, found: tuple[np.ndarray, np.ndarray, np.ndarray], text: pa.Array | None = None) -> pa.RecordBatch:
    of, bucket, count = found
    ends = np.searchsorted(of, np.arange(size + 1)).astype(np.int32)
    lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x.astype(np.int32))) for x in (bucket, count)]
    sums = np.concatenate([[0], np.cumsum(count)])[ends]
    return pa.RecordBatch.from_arrays([*names, pa.nulls(size, pa.binary()) if text is None else text, pa.array(np.diff(sums)), *lists], names=[x.split()[0] for x in COUNTED.split(", ")])


def counted(docs: DataFrame, n: int = 2, buckets: int = 10_000, chunk_words: int = CHUNK_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each chunk (columns as COUNTED, text null): the key of its document, its number, its own words (n_words) and
    features (n_features), and the counts by bucket. Texts without words are one chunk without features."""
    shared.tune(docs.sparkSession)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = text_bytes(batch.column(2))
            for a, b in chunks(off):
                words = Words(buf, off[a : b + 1], lower=True, breaks=BREAKS)
                sizes = np.diff(words.of)
                long = sizes > chunk_words
                if long.any():
                    yield _chunks(batch.slice(a, b - a), words, np.flatnonzero(long), n, chunk_words)
                if not long.all():
                    of, bucket, count = histograms(words, n, buckets) if not long.any() else _without(histograms(words, n, buckets), long)
                    own = np.flatnonzero(~long)
                    rows = batch.slice(a, b - a).take(pa.array(own))
                    yield _counted_batch([rows.column(0), rows.column(1), pa.array(np.zeros(len(own), np.int32)), pa.array(sizes[own])], len(own), (of, bucket, count))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = text_bytes(batch.column(4).cast(pa.string()))
            for a, b in chunks(off):
                own = batch.slice(a, b - a)
                words = Words(buf, off[a : b + 1], breaks=BREAKS)
                yield _counted_batch([*own.columns[:4]], b - a, histograms(words, n, buckets, chunk_words))

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), shared.wide_key(id_col, text_col).alias("key"), F.col(f"`{text_col}`").alias("text"))
    first = shared.written(rows.mapInArrow(shared.tidy(split), COUNTED), "chunks")
    dealt = first.where("text is not null").repartition("key", "chunk")
    long = shared.written(dealt.mapInArrow(shared.tidy(count), COUNTED), "long_chunks")
    return first.where("text is null").union(long)


def _chunks(rows: pa.RecordBatch, words: Words, long: np.ndarray, n: int, chunk_words: int) -> pa.RecordBatch:
    """The chunks of long texts, with n - 1 words carried over, still to be counted."""
    of, number, own, text = [], [], [], []
    for i in long:
        low, high = int(words.of[i]), int(words.of[i + 1])
        for k, a in enumerate(range(low, high, chunk_words)):
            last = min(a + chunk_words + n - 1, high) - 1
            of.append(i), number.append(k), own.append(min(chunk_words, high - a))
            text.append(words.bytes[words.start[a] : words.end[last]].tobytes())
    take = rows.take(pa.array(of, pa.int64()))
    empty = (np.zeros(0, np.int64),) * 3
    return _counted_batch([take.column(0), take.column(1), pa.array(number, pa.int32()), pa.array(own, pa.int64())], len(of), empty, pa.array(text, pa.binary()))


def _without(found: tuple[np.ndarray, np.ndarray, np.ndarray], long: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of the other texts, numbered anew."""
    of, bucket, count = found
    keep = ~long[of]
    return (np.cumsum(~long) - 1)[of[keep]], bucket[keep], count[keep]


def totals(rows: DataFrame, buckets: int) -> np.ndarray:
    """Features by bucket over all chunks: summed in each task, then by bucket; an array of fixed size."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            np.add.at(sums, batch.column(0).flatten().to_numpy(), batch.column(1).flatten().to_numpy())
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(sums[at])], names=["bucket", "n"])

    each = rows.select("buckets", "counts").mapInArrow(summed, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, dtype=np.int64)
    for bucket, n in each.collect():
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Of each bucket 1000 times the log ratio of the target's share to the corpus's, both with one added, rounded down."""
    s_all, t_all, size = int(corpus.sum()), int(target.sum()), len(corpus)
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + size) / ((s + 1) * (t_all + size)))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], dtype=np.int64)


def weighted(rows: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, key, chunk, n_words, n_features, gain): the gains of a chunk's features, summed."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, counts = batch.column(5), batch.column(6).flatten().to_numpy().astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            total = np.concatenate([[0], np.cumsum(gain[lists.flatten().to_numpy()] * counts)])[ends]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(np.diff(total))], names=["doc_id", "key", "chunk", "n_words", "n_features", "gain"])

    return rows.select("doc_id", "key", "chunk", "n_words", "n_features", "buckets", "counts").mapInArrow(sums, "doc_id long, key binary, chunk int, n_words long, n_features long, gain long")


def importance(docs: DataFrame, target: DataFrame, seed: int = 7, percent: int = 25, least_words: int = 20, n: int = 2, buckets: int = 10_000, chunk_words: int = CHUNK_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, key, n_words, n_features, weight, score, rank) of every whole text: rank 1, 2, 3, ... of the drawn ones.

    Null and empty texts have no words and a weight of 0. Null ids are ids of their own, with the noise of an empty id; they
    lose ties. Rows that repeat id and text share a key and a score, and count each. Empty tables give no rows; other columns
    play no part. An empty target weighs every bucket by the corpus alone.
    """
    corpus = counted(docs, n, buckets, chunk_words, id_col, text_col)
    wanted = counted(target.select(F.lit(0).alias("i"), F.col(f"`{text_col}`").alias("t")), n, buckets, chunk_words, "i", "t")
    sums = shared.written(weighted(corpus, gains(totals(corpus, buckets), totals(wanted, buckets))), "weights")
    # only long texts have several chunks; rows that repeat one are summed together and divided by their number
    long = sums.where("chunk > 0").select("key").distinct()
    parts = shared.written(sums.join(long, "key", "left_semi"), "parts")
    by_key = parts.groupBy("key").agg(F.sum(F.expr("if(chunk = 0, 1L, 0L)")).alias("_n"), *(F.sum(c).alias(f"_{c}") for c in ("n_words", "n_features", "gain")))
    by_key = shared.written(by_key, "documents")
    whole = parts.where("chunk = 0").join(by_key, "key").select("doc_id", "key", *(F.expr(f"_{c} div _n").alias(c) for c in ("n_words", "n_features", "gain")))
    each = sums.where("chunk = 0").join(long, "key", "left_anti").select(*whole.columns).union(whole)
    weight = F.expr("(gain - pmod(gain, greatest(n_features, 1))) div greatest(n_features, 1)")  # rounded down, also below 0
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")
    scored = shared.written(each.select("doc_id", "key", "n_words", "n_features", weight.alias("weight"), (weight + noise).alias("score")), "scores")
    able = scored.where(F.col("n_words") >= least_words)
    drawn = percent * able.count() // 100
    placed = shared.ranked(able, [F.desc("score"), F.asc_nulls_last("doc_id")], "ranks")
    rank = F.when(F.col("_rank") < drawn, F.col("_rank") + 1).alias("rank")
    return placed.select(*scored.columns, rank).union(scored.where(F.col("n_words") < least_words).select("*", F.lit(None).cast("long").alias("rank")))


def drawn(docs: DataFrame, scores: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The drawn documents with all their columns; rows that repeat id and text are drawn together."""
    keys = shared.written(scores.where("rank is not null").select(F.col("key").alias("_key")).distinct(), "drawn")
    return docs.withColumn("_key", shared.wide_key(id_col, text_col)).join(keys, "_key", "left_semi").select(*docs.columns)
