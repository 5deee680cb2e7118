"""Repeated word windows found through minimisers: what substring dedup and suffix-array dedup share.

A window is `width` consecutive words. Its anchor is the smallest digest among its `seed`-word grams (of equals the
leftmost), so windows with equal words have equal anchors at equal places. Neighbouring windows mostly share an anchor; all
windows of one anchor occurrence form its span. A row for each span stands for up to width - seed + 1 windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from evispark.llm import shared
from evispark.llm.textkit import BASES, Words, chunks, digest, gather, leftmost_minimum, prefix, signed, text_bytes

SEED = 8
SPAN = "anchor long, span long, k long, low int, at short, windows short"


def word_sums(words: Words) -> np.ndarray:
    return prefix(words.hashes(), BASES[2])


def _of_windows(words: Words, sums: np.ndarray, width: int, seed: int):
    """(anchor digests, span digests, text, first window, anchor's place in it, windows), one for each span."""
    of = words.of
    grams = len(sums) - 1 - seed + 1
    if grams < width - seed + 1:
        return None
    start = np.arange(grams)
    h = digest(sums, start, start + seed, BASES[2])
    least = leftmost_minimum(h, width - seed + 1)
    text = np.repeat(np.arange(len(of) - 1), np.diff(of))[: len(least)]
    inside = np.flatnonzero(np.arange(len(least)) + width <= of[text + 1])
    if not len(inside):
        return None
    anchor, text = least[inside], text[inside]
    new = np.ones(len(inside), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(inside)))
    low, anchor, text = inside[first], anchor[first], text[first]
    place = anchor - low
    # the place of the anchor counts too: spans are equal only with equal anchors at equal places
    span = digest(sums, low, low + count + width - 1, BASES[2]) ^ (place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return h[anchor], span, text, low - of[text], place, count


def keyed(docs: DataFrame, id_col: str, text_col: str, others: list[str] | None = None) -> DataFrame:
    """(k, doc_id, text) with a key of id and text; `others` follow as one struct."""
    shared.tune(docs.sparkSession)
    more = [F.struct(*(F.col(f"`{c}`") for c in others)).alias("others")] if others else []
    return docs.select(shared.row_key(id_col, text_col).alias("k"), F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), *more)


def spans(docs: DataFrame, width: int, seed: int = SEED, with_id: bool = False) -> DataFrame:
    """A row for each span of every whole text of (k, doc_id, text), with its doc_id if asked for; texts shorter than a
    window have none."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = text_bytes(batch.column(1))
            key = batch.column(0).to_numpy(zero_copy_only=False)
            for a, b in chunks(off):
                words = Words(buf, off[a : b + 1])
                found = _of_windows(words, word_sums(words), width, seed)
                if found is not None:
                    anchor, span, text, low, place, count = found
                    own = [batch.column(2).take(pa.array(a + text))] if with_id else []
                    yield pa.RecordBatch.from_arrays([pa.array(signed(anchor)), pa.array(signed(span)), pa.array(key[a + text]), pa.array(low.astype(np.int32)), pa.array(place.astype(np.int16)), pa.array(count.astype(np.int16)), *own], names=["anchor", "span", "k", "low", "at", "windows", *["doc_id"] * with_id])

    extra = ["doc_id"] * with_id
    return docs.select("k", "text", *extra).mapInArrow(shared.tidy(rows), SPAN + f", doc_id {dict(docs.dtypes)['doc_id']}" * with_id)


def contexts(docs: DataFrame, chosen: DataFrame, width: int) -> DataFrame:
    """The chosen spans with the words around their anchors, read from their texts: `right` from the anchor on, `left`
    before it and backwards, as far as a window of the span reaches; a space ends each word.

    docs: (k, text, ...). chosen: (k, low, at, windows, others). Rows gather by k, at most as many as the text has spans.
    """
    inner = [c for c in chosen.columns if c != "k"]
    lists = chosen.groupBy("k").agg(F.collect_list(F.struct(*inner)).alias("spans"))
    texts = docs.join(lists, "k").select("k", "text", *(F.col(f"spans.{c}").alias(c) for c in inner))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = {c: batch.column(c) for c in inner}
            size = lists["low"].value_lengths().to_numpy(zero_copy_only=False)
            end = np.cumsum(size)
            flat = {c: x.flatten() for c, x in lists.items()}
            low, at, windows = (flat[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("low", "at", "windows"))
            last = low + windows - 1 + width
            begin, held, right, left = 0, 0, [], []

            def out(i: int, right: list, left: list) -> pa.RecordBatch:
                nonlocal begin
                a, b = (int(end[begin - 1]) if begin else 0), int(end[i])
                k = batch.column("k").slice(begin, i + 1 - begin)
                own = k.take(pa.array(np.repeat(np.arange(len(k)), size[begin : i + 1])))
                begin = i + 1
                return pa.RecordBatch.from_arrays([own, *(flat[c].slice(a, b - a) for c in inner), pa.array(right, pa.binary()), pa.array(left, pa.binary())], names=["k", *inner, "right", "left"])

            for i, text in enumerate(batch.column("text")):
                words = text.as_buffer().to_pybytes().split()
                for x in range(int(end[i] - size[i]), int(end[i])):
                    middle = low[x] + at[x]
                    right.append(b" ".join(words[middle : last[x]]) + b" ")
                    left.append(b" ".join(words[low[x] : middle][::-1]) + b" " * bool(at[x]))
                    held += len(right[-1]) + len(left[-1])
                if held > 1 << 21 or i == batch.num_rows - 1:
                    yield out(i, right, left)
                    held, right, left = 0, [], []

    kind = {f.name: f.dataType.simpleString() for f in chosen.schema}
    return texts.mapInArrow(shared.tidy(rows), "k long, " + ", ".join(f"{c} {kind[c]}" for c in inner) + ", right binary, left binary")


def common_words(a: bytes, b: bytes) -> int:
    """How many words two contexts share from their start on."""
    if a == b:
        return a.count(b" ")
    n = min(len(a), len(b))
    other = np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)
    at = int(other.argmax()) if n else 0
    return a.count(b" ", 0, at if n and other[at] else n)


def window_rows(found: DataFrame, width: int, keep: list[str]) -> DataFrame:
    """(anchor, window digest, start, *keep) for the windows low, ..., low + windows - 1 of rows (anchor, low, windows,
    right, left, from_word); left and right hold the words from from_word on."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            right, left = batch.column("right").to_pylist(), batch.column("left").to_pylist()
            text = [b" ".join([*reversed(x.split()), y]) if x else y for x, y in zip(left, right, strict=True)]
            buf, off = np.frombuffer(b"".join(text), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in text])]).astype(np.int64)
            low, windows, base = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("low", "windows", "from_word"))
            for a, b in chunks(off):
                words = Words(buf, off[a : b + 1])
                sums, n = word_sums(words), windows[a:b]
                each = np.repeat(np.arange(b - a), n)
                start = gather(low[a:b], n)
                place = start - base[a:b][each] + words.of[each]
                window = digest(sums, place, place + width, BASES[2])
                yield pa.RecordBatch.from_arrays([batch.column("anchor").take(pa.array(a + each)), pa.array(signed(window)), pa.array(start.astype(np.int32)), *(batch.column(c).take(pa.array(a + each)) for c in keep)], names=["anchor", "window", "start", *keep])

    kind = {f.name: f.dataType.simpleString() for f in found.schema}
    return found.mapInArrow(shared.tidy(rows), "anchor long, window long, start int" + "".join(f", {c} {kind[c]}" for c in keep))


def covered(lows: np.ndarray, counts: np.ndarray, words: int, width: int) -> np.ndarray:
    """Which of a text's words lie in a window that starts at low, ..., low + count - 1 for any of the runs."""
    mark = np.zeros(words + 1, dtype=np.int64)
    np.add.at(mark, np.minimum(lows, words), 1)
    np.add.at(mark, np.minimum(lows + counts + width - 1, words), -1)
    return np.cumsum(mark)[:words] > 0


def without(docs: DataFrame, runs: DataFrame, width: int, finish, schema: str) -> DataFrame:
    """Apply runs (k, low, windows) of windows to be removed to every text; finish(batch rows) makes the output.

    finish(doc_id array, [(bytes, words, removed flags) for each text]) -> list of arrays for `schema`; a struct column
    `others` of docs goes through the same join and comes at the end.
    """
    # rows that repeat id and text share k and give the same runs each: a set, or its size would grow with their square
    lists = runs.groupBy("k").agg(F.collect_set(F.struct("low", "windows")).alias("runs"))
    more = [c for c in docs.columns if c == "others"]
    texts = docs.join(lists, "k", "left").select("doc_id", "text", F.col("runs.low").alias("lows"), F.col("runs.windows").alias("counts"), *more)
    names = [*(x.strip().split()[0] for x in schema.split(",")), *more]
    schema = DataType.fromDDL(schema)
    for c in more:
        schema = schema.add(docs.schema[c])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = text_bytes(batch.column(1))
            for a, b in chunks(off):
                words = Words(buf, off[a : b + 1])
                out = []
                for i in range(a, b):
                    low, high = words.of[i - a], words.of[i - a + 1]
                    lows = batch.column(2)[i]
                    gone = covered(np.array(lows.as_py(), np.int64), np.array(batch.column(3)[i].as_py(), np.int64), high - low, width) if lows.is_valid else None
                    out.append((words, int(low), int(high), gone, i - a))
                yield pa.RecordBatch.from_arrays([*finish(batch.slice(a, b - a), out), *batch.slice(a, b - a).columns[4:]], names=names)

    return texts.mapInArrow(shared.tidy(rows), schema)


def kept_bytes(words: Words, low: int, high: int, gone: np.ndarray | None) -> bytes:
    """The words that stay, joined by one space."""
    data = words.bytes
    starts, ends = words.start[low:high], words.end[low:high]
    if gone is not None:
        starts, ends = starts[~gone], ends[~gone]
    if not len(starts):
        return b""
    a, b = int(words.start[low]), int(words.end[high - 1])
    # one pass over the text's bytes: word bytes stay, the byte after a kept word becomes a space, the rest goes
    n = b - a + 1
    mark = np.zeros(n + 1, dtype=np.int8)
    mark[starts - a] += 1
    mark[ends - a + 1] -= 1
    copy = np.append(data[a:b], np.uint8(32))
    copy[ends - a] = 32
    return copy[np.cumsum(mark[:n]) > 0].tobytes()[:-1]
