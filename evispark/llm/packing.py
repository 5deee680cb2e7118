"""Best-fit packing of token sequences in bulk-synchronous supersteps over range-sorted pieces and gaps.

Pieces are range-sorted by size once, largest first, which gives each a rank. The supersteps run down ranges of sizes. In each
one the range's pieces and all gaps that may hold one of them are dealt to tasks by rank, so that every task has its share of each
size and no two tasks want the same gap. A task sweeps over its pieces in order: a piece takes the successor, the smallest
gap that holds it, and what is left of it is a gap again; pieces of one size that want one gap take it and the next ones by
rank; where no gap holds a piece a sequence is opened. All updated gaps are ranked and dealt anew in the next superstep.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evispark.llm import shared
from evispark.llm.textkit import text_bytes
from evispark.llm.vocabulary import UnitStore, kept, spread

MARK = "<|endoftext|>"
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Gaps:
    """A task's gaps by size; the successor of a size is found by its lowest set bit above."""

    def __init__(self, capacity: int, fresh):
        self.capacity, self.fresh = capacity, fresh
        self.of: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.sizes = 0

    def put(self, size: int, sequence: int) -> None:
        if not self.of[size]:
            self.sizes |= 1 << size
        self.of[size].append(sequence)

    def place(self, size: int) -> tuple[int, int]:
        """(sequence, offset) for a piece of this size."""
        above = self.sizes >> size
        if above:
            gap = size + (above & -above).bit_length() - 1
            sequence = self.of[gap].pop()
            if not self.of[gap]:
                self.sizes ^= 1 << gap
        else:
            gap, sequence = self.capacity, next(self.fresh)
        self.put(gap - size, sequence)
        return sequence, self.capacity - gap

    def left(self) -> Iterator[tuple[int, int]]:
        """(size, sequence), smallest first; full sequences have no gap."""
        for size in range(1, self.capacity + 1):
            for sequence in self.of[size]:
                yield size, sequence


#: Pieces and gaps of a superstep for each task.
SHARE = 200_000
#: Sizes at most the capacity over this power of two share the last superstep.
STEPS = 5


def pack(pieces: DataFrame, capacity: int, order: list[str], size: str = "length") -> DataFrame:
    """Add sequence_id and offset to pieces, whose `size` lies between 1 and capacity. `order` makes rows distinct.

    Rows of one size may be a third of all: `order` takes part in the ranges and shares are dealt by rank, so they spread
    over tasks. What reaches the driver are counts by size: at most capacity rows. Repeated rows are packed each.
    """
    spark = pieces.sparkSession
    rows = pieces.withColumn("_size", F.col(size).cast("int"))
    ranged = rows.repartitionByRange(F.desc("_size"), *order).sortWithinPartitions(F.desc("_size"), *order)
    ranged = shared.written(ranged.mapInArrow(shared.tidy(shared.numbered), shared.ddl(rows.schema) + ", _part int, _rank long"), "ranged")
    counts = dict(map(tuple, ranged.groupBy("_size").count().collect()))
    if counts and not 1 <= min(counts) <= max(counts) <= capacity:
        raise ValueError("sizes must lie between 1 and the capacity")
    schema = shared.ddl(pieces.schema) + ", sequence_id long, offset long"
    # a piece of more than half the capacity has a sequence of its own, whose rank names it
    bounds = [0, *sorted({capacity >> k for k in range(1, STEPS + 1)} - {0}), capacity]
    own = F.shiftleft(F.col("_part").cast("long"), 40) + F.col("_rank")
    large = ranged.where(F.col("_size") > bounds[-2])
    placed = [large.select(*pieces.columns, own.alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]
    gaps = large.where(F.col("_size") < capacity).select((capacity - F.col("_size")).alias("_gap"), own.alias("_sequence"), (F.col("_part") + F.col("_rank")).alias("_deal"))
    for step in range(len(bounds) - 2, 0, -1):
        low, high = bounds[step - 1], bounds[step]
        sizes = [s for s in counts if low < s <= high]
        if sizes:
            own = ranged.where((F.col("_size") > low) & (F.col("_size") <= high)).withColumn("_deal", F.col("_part") + F.col("_rank")).drop("_part", "_rank")
            wide = gaps.where(F.col("_gap") >= min(sizes))  # no piece of this range fits the others; they wait for smaller ones
            dealt = _dealt(own, wide, sum(counts[s] for s in sizes) + wide.count(), order)
            swept = shared.written(dealt.mapInArrow(shared.tidy(_sweep(capacity, step, pieces.columns)), f"{schema}, _gap int, _sequence long, _deal long"), "swept")
            placed.append(swept.where("_gap is null").drop("_gap", "_sequence", "_deal"))
            gaps = swept.where("_gap is not null").select("_gap", "_sequence", "_deal").union(gaps.where(F.col("_gap") < min(sizes)))
    out = placed[0]
    for p in placed[1:]:
        out = out.union(p)
    return out


def _dealt(own: DataFrame, gaps: DataFrame, number: int, order: list[str]) -> DataFrame:
    """Pieces and gaps by rank over so many tasks that each has SHARE rows; a task's gaps first, then its pieces by size."""
    tasks = -(-number // SHARE)
    both = own.unionByName(gaps, allowMissingColumns=True).withColumn("_deal", F.pmod("_deal", F.lit(tasks)))
    return both.repartitionById(tasks, F.col("_deal").cast("int")).sortWithinPartitions(F.desc("_gap"), F.desc("_size"), *order, "_sequence")


def _sweep(capacity: int, step: int, columns: list[str]):
    """A task's part of a superstep: gaps come first, then pieces, largest first. Rows of placed pieces, then those of gaps."""

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        # steps and tasks number the sequences that they open apart from each other and from those of large pieces
        gaps = Gaps(capacity, count(1 << 62 | step << 58 | part << 36))
        kinds = None
        for batch in batches:
            kinds = [batch.schema.field(c).type for c in columns]
            gap = batch.column("_gap")
            for g, s in zip(gap.drop_null().to_pylist(), batch.column("_sequence").drop_null().to_pylist(), strict=True):
                gaps.put(g, s)
            own = batch.filter(gap.is_null())
            if own.num_rows:
                at = np.array([gaps.place(s) for s in own.column("_size").to_pylist()], dtype=np.int64)
                none = [pa.nulls(len(at), pa.int32()), pa.nulls(len(at), pa.int64()), pa.nulls(len(at), pa.int64())]
                yield pa.RecordBatch.from_arrays([*(own.column(c) for c in columns), pa.array(at[:, 0]), pa.array(at[:, 1]), *none], names=[*columns, "sequence_id", "offset", "_gap", "_sequence", "_deal"])
        left = np.array(list(gaps.left()), dtype=np.int64).reshape(-1, 2)
        for a in range(0, len(left), 50_000):
            x = left[a : a + 50_000]
            none = [pa.nulls(len(x), k) for k in (*kinds, pa.int64(), pa.int64())]
            yield pa.RecordBatch.from_arrays([*none, pa.array(x[:, 0].astype(np.int32)), pa.array(x[:, 1]), pa.array(part + a + np.arange(len(x)))], names=[*columns, "sequence_id", "offset", "_gap", "_sequence", "_deal"])

    return sweep


def word_parts(text: pa.Array) -> pa.Array:
    """Lists of parts that the tokenizer encodes apart: it lowers case and cuts at white space and between a letter and
    the marks after it, so doing both before leaves the ids as they are and makes more parts equal."""
    lower = pc.if_else(pc.match_substring(text, "<|"), text, pc.ascii_lower(text))  # only lower-case marks are special
    return pc.ascii_split_whitespace(pc.replace_substring_regex(lower, r"([a-z])([,.!?%$&*#]+)", r"\1 \2"))


def word_units(path: str):
    """Encoder of new words for UnitStore by a tokenizers file whose pre-tokenizer drops white space."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    mark = tokenizer.token_to_id(MARK)

    def encode(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        parts, sizes = [], []
        for a in range(0, len(words), 512):
            own = words[a : a + 512]
            joined = MARK.join(own)
            if joined.count("<|") != len(own) - 1:  # a word that may hold a mark itself: one by one
                each = [np.array(tokenizer.encode(w, add_special_tokens=False).ids, dtype=np.uint32) for w in own]
                parts += each
                sizes.append(np.array([len(x) for x in each]))
                continue
            ids = np.array(tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, dtype=np.uint32)
            marks = np.flatnonzero(ids == mark)
            parts.append(ids[ids != mark])
            sizes.append(np.diff(np.concatenate([[-1], marks, [len(ids)]])) - 1)
        return np.concatenate(parts), np.concatenate(sizes)

    return encode


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token pieces of whole texts: ids without special tokens, then end_id; texts over capacity are cut into full pieces
    and a last one. Null and empty texts give one piece of the end id alone. Columns as PIECES."""
    shared.tune(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = UnitStore(kept(("words", tokenizer_path), lambda: word_units(tokenizer_path)))
        for batch in batches:
            doc = batch.column(0).to_numpy(zero_copy_only=False)
            null = batch.column(0).is_null()
            text = pc.fill_null(batch.column(1), "")
            size = np.diff(text_bytes(text)[1])
            for a, b in _parts(size):
                words = word_parts(text.slice(a, b - a))
                counts = words.value_lengths().to_numpy(zero_copy_only=False)
                pool, start, length = store.look(words.flatten())
                ids = spread(pool, start, length)
                ends = np.concatenate([[0], np.cumsum(length)])[np.concatenate([[0], np.cumsum(counts)])]
                rows = []
                for i in range(b - a):
                    own = np.append(ids[ends[i] : ends[i + 1]], np.uint32(end_id)).astype("<u4")
                    for k, s in enumerate(range(0, len(own), capacity)):
                        piece = own[s : s + capacity]
                        rows.append((a + i, k, s, len(piece), zlib.crc32(piece.tobytes())))
                at, k, s, n, crc = np.array(rows, dtype=np.int64).T
                yield pa.RecordBatch.from_arrays([pa.array(doc, mask=null.to_numpy(zero_copy_only=False)).cast(pa.int64()).take(pa.array(at)), pa.array(k.astype(np.int32)), pa.array(s), pa.array(n), pa.array(crc)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return source.mapInArrow(shared.tidy(cut), PIECES)


def _parts(size: np.ndarray, most: int = 4 << 20) -> Iterator[tuple[int, int]]:
    ends = np.cumsum(size)
    a = 0
    while a < len(size):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + most, side="right")))
        yield a, b
        a = b


def best_fit(docs: DataFrame, tokenizer_path: str, capacity: int = 2048) -> DataFrame:
    """Pack every document's token pieces into sequences of at most `capacity` tokens; see token_pieces and pack.

    Empty tables give no rows; repeated documents are packed each; other columns play no part.
    """
    pieces = shared.written(token_pieces(docs, tokenizer_path, capacity), "pieces")
    return pack(pieces, capacity, ["doc_id", "piece", "ids_crc32"])
