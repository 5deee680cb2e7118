"""Quality classifier: document statistics, random Fourier features of a Gaussian kernel, ridge scores, isotonic calibration."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evispark.llm import shared
from evispark.llm.learning import Calibrator, fold, one_label, tree_sum
from evispark.llm.textkit import Words, chunks, text_bytes

FEATURES = 320
RIDGE = 1e-3
THRESHOLD = 0.3
#: One labelled document in so many calibrates scores and stays out of the ridge.
CALIBRATION_PART = 4

#: Classes of bytes whose shares are statistics.
CLASSES = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b".", b",", b"!", b"#*&%$", b"|", b"\n", b"<>{}[]()=/\\_^~@+", b"'\"-:;?")
CLASS = np.full(256, len(CLASSES), dtype=np.int64)
for _i, _c in enumerate(CLASSES):
    CLASS[list(_c)] = _i
CLASS[0x80:] = len(CLASSES) + 1
N_CLASSES = len(CLASSES) + 2
N_STATS = N_CLASSES + 10


def statistics(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """A row of N_STATS numbers for each text; texts without words have zeros."""
    words = Words(buf, off)
    n = len(off) - 1
    out = np.zeros((n, N_STATS))
    size, count = np.diff(off).astype(float), np.diff(words.of).astype(float)
    has = np.maximum(size, 1)
    text = np.repeat(np.arange(n), np.diff(off))
    out[:, :N_CLASSES] = np.bincount(text * N_CLASSES + CLASS[words.bytes], minlength=n * N_CLASSES).reshape(n, N_CLASSES) / has[:, None]
    doc, h = words.doc(), words.hashes()
    some = np.maximum(count, 1)
    share = lambda flag: np.bincount(doc[flag], minlength=n) / some
    kind_first, kind_last = CLASS[words.bytes[words.start]], CLASS[words.bytes[words.end - 1]]
    same = np.zeros(len(h), dtype=bool)
    same[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    order = np.lexsort((h, doc))
    again = np.zeros(len(h), dtype=bool)
    again[1:] = (h[order][1:] == h[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    long = words.end - words.start
    second = CLASS[words.bytes[np.minimum(words.start + 1, words.end - 1)]]
    stats = [np.log1p(count) / 10, np.bincount(doc, long, n) / some / 10, share(same), np.bincount(doc[order][again], minlength=n) / some, share(kind_last == 5), share(kind_last == 6), share((kind_first == 7) & (long == 1)), share((kind_first == 0) & (second == 0) & (long > 1)), share(kind_last == 3), share(long > 30)]
    for i, x in enumerate(stats):
        out[:, N_CLASSES + i] = x
    return out


def statistic_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: bool = False) -> DataFrame:
    """(doc_id, stats array<double>) of every whole text, with its shared.row_key k if asked for; a null text counts as empty."""
    shared.tune(docs.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = text_bytes(batch.column(1))
            parts = [statistics(buf, off[a : b + 1]) for a, b in chunks(off)]
            flat = np.concatenate(parts).ravel() if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(np.arange(len(off), dtype=np.int32) * N_STATS), pa.array(flat)), *batch.columns[2:]], names=["doc_id", "stats", *own])

    own = ["k"] if key else []
    k = [shared.row_key(id_col, text_col).alias("k")] if key else []
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), *k).mapInArrow(shared.tidy(rows), "doc_id long, stats array<double>" + ", k long" * key)


class FourierRidge:
    """Ridge regression on random Fourier features; fitted by sums over partitions, so any number of rows will do."""

    def __init__(self, features: int = FEATURES, ridge: float = RIDGE, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.normal, self.phase = rng.standard_normal((N_STATS, features)), rng.uniform(0, 2 * np.pi, features)
        self.mean, self.scale, self.weights, self.ridge = np.zeros(N_STATS), np.ones(N_STATS), np.zeros(features + 1), ridge

    def expand(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -5, 5) / np.sqrt(N_STATS)
        return np.hstack([np.cos(z @ self.normal + self.phase) * np.sqrt(2 / len(self.phase)), np.ones((len(x), 1))])

    @staticmethod
    def matrix(column: pa.Array) -> np.ndarray:
        return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, N_STATS)

    def fit(self, rows: DataFrame) -> FourierRidge:
        """rows: (stats, label), labels from 0 to 1."""

        def moments(batch: pa.RecordBatch) -> np.ndarray:
            x = self.matrix(batch.column(0))
            return np.concatenate([[len(x)], x.sum(0), (x * x).sum(0)])

        n, *rest = tree_sum(rows, moments, 1 + 2 * N_STATS)
        if not n:
            self.weights[-1] = 0.5
            return self
        self.mean = np.array(rest[:N_STATS]) / n
        self.scale = np.sqrt(np.maximum(np.array(rest[N_STATS:]) / n - self.mean**2, 0)) + 1e-6
        m = len(self.weights)

        def normal(batch: pa.RecordBatch) -> np.ndarray:
            z, y = self.expand(self.matrix(batch.column(0))), batch.column(1).to_numpy(zero_copy_only=False)
            return np.concatenate([(z.T @ z).ravel(), z.T @ y])

        sums = tree_sum(rows, normal, m * m + m)
        self.weights = np.linalg.solve(sums[: m * m].reshape(m, m) + self.ridge * n * np.diag([1.0] * (m - 1) + [1e-9]), sums[m * m :])
        return self

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self.expand(x) @ self.weights


def quality_scores(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, label: str = "quality", threshold: float = THRESHOLD, key: bool = False) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every document.

    Labels of ids whose crc32 modulo `folds` is `held` take no part. Empty and null texts get the score of their
    statistics, all zero. Without usable labels every score is about 0.5. Repeated rows come back each; repeated labels of
    an id count as their mean; other columns play no part. With `key` a column k has the row's shared.row_key.
    """
    stats = shared.written(statistic_rows(docs, key=key), "statistics")
    known = stats.join(one_label(labels, "doc_id", label), "doc_id").where(fold(folds) != held)
    # a ridge is too sure of the rows that it was fitted on: calibration takes rows of its own
    apart = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(CALIBRATION_PART)) == 0
    model = FourierRidge().fit(known.where(~apart).select("stats", "label"))
    raw = known.where(apart).select("stats", "label").mapInArrow(shared.tidy(_raw(model)), "raw double, label double")
    calibrate = Calibrator(-0.5, 1.5).fit(raw, "raw", "label")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = calibrate(model(FourierRidge.matrix(batch.column(2))))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s), pa.array((s >= threshold).astype(np.int32)), *batch.columns[3:]], names=["doc_id", "held_out", "score", "predicted", *own])

    own = ["k"] if key else []
    return stats.select("doc_id", (fold(folds) == held).alias("held_out"), "stats", *own).mapInArrow(shared.tidy(score), "doc_id long, held_out boolean, score double, predicted int" + ", k long" * key)


def _raw(model: FourierRidge):
    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(model(FourierRidge.matrix(batch.column(0)))), batch.column(1)], names=["raw", "label"])

    return raw
