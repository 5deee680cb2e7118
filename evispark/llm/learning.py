"""Sums over partitions and score calibration that the two classifiers share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evispark.llm import shared

#: First level of the sum tree: so many tasks add the partitions' arrays, one task adds theirs.
BRANCHES = 16
BINS = 4096


def tree_sum(df: DataFrame, of_batch: Callable[[pa.RecordBatch], np.ndarray], size: int) -> np.ndarray:
    """Sum of of_batch over all batches: partitions first, then a two-level tree. One array of `size` reaches the driver."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros(size)
        for batch in batches:
            total += of_batch(batch)
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() % BRANCHES]), pa.array([total.tobytes()])], names=["branch", "total"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for x in batch.column("total"):
                total += np.frombuffer(x.as_py(), dtype=np.float64)
        yield pa.RecordBatch.from_arrays([pa.array([0]), pa.array([total.tobytes()])], names=["branch", "total"])

    schema = "branch long, total binary"
    sums = df.mapInArrow(shared.tidy(each), schema).repartition(BRANCHES, "branch").mapInArrow(shared.tidy(add), schema)
    rows = sums.coalesce(1).mapInArrow(shared.tidy(add), schema).collect()
    return sum((np.frombuffer(r.total, dtype=np.float64) for r in rows), np.zeros(size))


def isotonic(hits: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Pool adjacent violators over bins: a non-decreasing rate for every bin, linear between the centres of its blocks."""
    at = np.flatnonzero(total > 0)
    if not len(at):
        return np.full(len(total), 0.5)
    blocks: list[list[float]] = []  # rate, weight, first bin, last bin
    for i in at:
        blocks.append([hits[i] / total[i], total[i], i, i])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            b, a = blocks.pop(), blocks.pop()
            blocks.append([(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2], b[3]])
    x = [v for b in blocks for v in (b[2], b[3])]
    y = [v for b in blocks for v in (b[0], b[0])]
    return np.interp(np.arange(len(total)), x, y)


class Calibrator:
    """Maps raw values between low and high to rates by isotonic regression over fixed bins; a small slope keeps the order
    of raw values inside a block."""

    SLOPE = 1e-3

    def __init__(self, low: float, high: float):
        self.low, self.high = low, high
        self.rates = np.full(BINS, 0.5)

    def bins(self, raw: np.ndarray) -> np.ndarray:
        return np.clip((raw - self.low) / (self.high - self.low) * BINS, 0, BINS - 1)

    def fit(self, scored: DataFrame, raw: str, label: str) -> Calibrator:
        """From all rows whose label is not null; null raw values don't count."""

        def count(batch: pa.RecordBatch) -> np.ndarray:
            x, y = (batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in (0, 1))
            at = self.bins(x).astype(int)
            return np.concatenate([np.bincount(at, y, BINS), np.bincount(at, minlength=BINS)]) if len(at) else np.zeros(2 * BINS)

        rows = scored.where(F.col(label).isNotNull() & F.col(raw).isNotNull()).select(F.col(raw).cast("double"), F.col(label).cast("double"))
        sums = tree_sum(rows, count, 2 * BINS)
        self.rates = isotonic(sums[:BINS], sums[BINS:])
        return self

    def __call__(self, raw: np.ndarray) -> np.ndarray:
        at = self.bins(raw)
        return (1 - self.SLOPE) * np.interp(at, np.arange(BINS), self.rates) + self.SLOPE * at / BINS


def one_label(labels: DataFrame, id_col: str, label: str) -> DataFrame:
    """One row per id: the mean of its labels that are not null."""
    return labels.where(F.col(f"`{id_col}`").isNotNull() & F.col(f"`{label}`").isNotNull()).groupBy(F.col(f"`{id_col}`").cast("long").alias("doc_id")).agg(F.avg(F.col(f"`{label}`").cast("double")).alias("label"))


def fold(folds: int):
    """crc32 of the id as text, modulo folds; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % folds
