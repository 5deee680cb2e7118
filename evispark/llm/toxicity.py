"""Toxicity by class-conditional Kneser-Ney models over the characters of words.

Each class has its own counts for the longest contexts; shorter contexts back off to one distribution of continuation
counts (in how many different words an n-gram stands) that both classes share and every document adds to. Where a class
has not seen an n-gram, the shared part cancels out of the comparison, so a rare word is judged by the characters that the
classes do know. A text's statistic is its length-normalised log-likelihood ratio (the mean over its words) plus that of
its most telling word; isotonic calibration turns it into a score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evispark.llm import shared
from evispark.llm.learning import Calibrator, fold, one_label
from evispark.llm.textkit import BASES, U, digest, mix, prefix, signed, text_bytes
from evispark.llm.vocabulary import UnitStore

ORDER = 6
DISCOUNT = 0.75
THRESHOLD = 0.3
#: Labelled documents of a class that the class counts take at most (those with the smallest digest of their id); the
#: shared counts take all documents.
MOST_LABELLED = 20_000
#: One labelled document in so many calibrates scores and stays out of the class counts.
CALIBRATION_PART = 4
TRIM = ".,!?;:*#&%$\"'()|"
#: Words whose ratio a task keeps.
KNOWN_WORDS = 200_000
#: Signs before and after a word; no text has these surrogates.
FIRST, LAST = 0xD800, 0xD801


def word_lists(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-case words without marks around them, and how many each text has; words of marks alone stay out."""
    words = pc.ascii_split_whitespace(pc.utf8_lower(pc.fill_null(text, "")))
    flat = pc.ascii_trim(words.flatten(), TRIM)
    doc = np.repeat(np.arange(len(text)), words.value_lengths().to_numpy(zero_copy_only=False))
    full = pc.greater(pc.binary_length(flat), 0)
    return flat.filter(full), np.bincount(doc[full.to_numpy(zero_copy_only=False)], minlength=len(text))


def grams(words: list[str], order: int = ORDER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points with a sign before and after each word, place of each word's first sign, place in its word)."""
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 2
    begin = np.cumsum(sizes) - sizes
    codes = np.zeros(int(sizes.sum()), dtype=np.uint64)
    inner = np.ones(len(codes), dtype=bool)
    inner[begin] = inner[begin + sizes - 1] = False
    codes[begin], codes[begin + sizes - 1] = FIRST, LAST
    codes[inner] = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return codes, begin, np.arange(len(codes)) - np.repeat(begin, sizes)


def _key(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return digest(sums, start, end, BASES[1])


def _sums(codes: np.ndarray) -> np.ndarray:
    return prefix(mix(codes + U(0x5851F42D4C957F2D)), BASES[1])


def count_words(docs: DataFrame, ids: dict[int, float]) -> DataFrame:
    """(word, toxic, ordinary): in how many labelled documents of a class each word of the corpus stands.

    ids: labels of the bounded sample. All documents' words are there, with zeros unless labelled documents have them.
    """
    spark = docs.sparkSession
    keys = np.array(sorted(ids), dtype=np.int64)
    known = spark.sparkContext.broadcast((keys, np.array([ids[k] for k in keys.tolist()])))
    schema = pa.schema([("word", pa.string()), ("toxic", pa.int64()), ("ordinary", pa.int64())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values = known.value
        held: list[pa.Table] = []
        n = 0

        def flush() -> pa.Table:
            table = pa.concat_tables(held).group_by("word").aggregate([("toxic", "sum"), ("ordinary", "sum")])
            return pa.table([table["word"], table["toxic_sum"], table["ordinary_sum"]], schema=schema)

        for batch in batches:
            flat, counts = word_lists(batch.column(1))
            coded = flat.dictionary_encode()
            code, m = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(coded.dictionary)
            if not m:
                continue
            doc = pc.fill_null(batch.column(0), -1).to_numpy(zero_copy_only=False)
            at = np.minimum(np.searchsorted(keys, doc), max(len(keys) - 1, 0))
            label = np.where(keys[at] == doc, values[at], np.nan) if len(keys) else np.full(len(doc), np.nan)
            label[np.asarray(batch.column(0).is_null())] = np.nan
            of = np.repeat(np.arange(len(doc)), counts)
            own = ~np.isnan(label[of])
            pair = np.unique(of[own] * m + code[own])
            toxic = label[pair // m] >= 0.5
            c1, c0 = (np.bincount((pair % m)[x], minlength=m) for x in (toxic, ~toxic))
            held.append(pa.table([coded.dictionary, pa.array(c1), pa.array(c0)], schema=schema))
            n += m
            if n > 300_000:
                held, n = [flush()], 0
                n = held[0].num_rows
                if n > 150_000:
                    yield from held[0].to_batches()
                    held, n = [], 0
        if held:
            yield from flush().to_batches()

    source = docs.select(F.col("doc_id").cast("long"), "text")
    return source.mapInArrow(shared.tidy(rows), "word string, toxic long, ordinary long").groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def count_grams(words: DataFrame, order: int = ORDER) -> DataFrame:
    """(key, context, suffix, size, types, toxic, ordinary, total, kinds) for the n-grams of words that have class counts.

    types counts the words of the whole corpus that hold the n-gram, total and kinds the n-grams of its context. suffix is
    the n-gram without its first character. Only the longest n-gram that ends at a character has class counts. The rows
    stem from the bounded sample of labelled documents, so their number has a bound; their counts stem from all documents.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0).to_pylist()
            weight = [batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2)]
            for a in range(0, len(words), 20_000):
                own = words[a : a + 20_000]
                codes, begin, place = grams(own)
                word = np.repeat(np.arange(len(own)), np.diff(np.append(begin, len(codes)))) + a
                sums, end = _sums(codes), np.flatnonzero(place > 0)
                for k in range(order):
                    e = end[place[end] >= k]
                    key, first = _key(sums, e - k, e + 1), np.minimum(place[e], order - 1) == k
                    _, one, back, types = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
                    c = [np.bincount(back, w, len(one)).astype(np.int64) for w in (*(np.where(first, w[word[e]], 0) for w in weight), weight[0][word[e]] + weight[1][word[e]])]
                    e = e[one]
                    context, suffix = _key(sums, e - k, e), _key(sums, e - k + (k > 0), e + 1)
                    yield pa.RecordBatch.from_arrays([pa.array(signed(key[one])), pa.array(signed(context)), pa.array(signed(suffix)), pa.array(np.full(len(one), k, np.int32)), pa.array(types.astype(np.int64)), *map(pa.array, c)], names=["key", "context", "suffix", "size", "types", "toxic", "ordinary", "used"])

    spark = words.sparkSession
    # each task sends an n-gram once, so few large tasks send less than many small ones
    made = words.coalesce(2 * spark.sparkContext.defaultParallelism).mapInArrow(shared.tidy(rows), "key long, context long, suffix long, size int, types long, toxic long, ordinary long, used long")
    one = made.groupBy("key", "context", "suffix", "size").agg(*(F.sum(c).alias(c) for c in ("types", "toxic", "ordinary", "used")))
    one = shared.written(one, "grams")
    of_context = one.groupBy("context").agg(F.sum("types").alias("total"), F.count("*").alias("kinds"), F.sum("used").alias("used"))
    return one.where("used > 0").drop("used").join(of_context.where("used > 0").drop("used"), "context")


class KneserNeyRatio:
    """Log-likelihood ratio of words under the two class models: one value for each n-gram that a class has seen, and one for
    each context, which holds for n-grams that no class has seen in it."""

    def __init__(self, key, context, suffix, size, types, toxic, ordinary, total, kinds):
        order = np.argsort(key)
        key, context, suffix, size = key[order], context[order], suffix[order], size[order]
        types, total, kinds, *counts = (x[order].astype(float) for x in (types, total, kinds, toxic, ordinary))
        contexts, one, group = np.unique(context, return_index=True, return_inverse=True)
        at = np.searchsorted(key, suffix)  # the words that give an n-gram give its suffixes too
        floor = 1 / (total[size == 0].max(initial=0) + 200)
        shared_p, lower = np.zeros(len(key)), np.full(len(key), floor)
        for k in range(int(size.max(initial=-1)) + 1):
            own = size == k
            if k:
                lower[own] = shared_p[at[own]]
            shared_p[own] = np.maximum(types[own] - DISCOUNT, 0) / total[own] + DISCOUNT * kinds[own] / total[own] * lower[own]
        logs, off = [], []
        for c in counts:
            n, t = np.bincount(group, c, len(contexts)), np.bincount(group, c > 0, len(contexts))
            free = np.where(n > 0, DISCOUNT * t / np.maximum(n, 1), 1.0)
            logs.append(np.log(np.maximum(c - DISCOUNT, 0) / np.maximum(n[group], 1) + free[group] * lower))
            off.append(np.log(free))
        seen = counts[0] + counts[1] > 0 if len(key) else np.zeros(0, bool)
        self.keys, self.values = np.append(key[seen], U(2**64 - 1)), np.append((logs[0] - logs[1])[seen], 0)
        self.contexts, self.backoff = np.append(contexts, U(2**64 - 1)), np.append(off[0] - off[1], 0)

    @staticmethod
    def _find(keys: np.ndarray, values: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(keys[:-1], key)
        return keys[at] == key, values[at]

    def words(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros(0, np.float32)
        codes, begin, place = grams(words)
        sums, end = _sums(codes), np.flatnonzero(place > 0)
        start = end - np.minimum(place[end], ORDER - 1)
        key, context = _key(sums, start, end + 1), _key(sums, start, end)
        (known, value), (near, free) = self._find(self.keys, self.values, key), self._find(self.contexts, self.backoff, context)
        value = np.where(known, value, np.where(near, free, 0))
        sums = np.concatenate([[0], np.cumsum(_at(len(codes), end, value))])
        return (sums[np.append(begin[1:], len(codes))] - sums[begin]).astype(np.float32)


def _at(n: int, places: np.ndarray, values: np.ndarray) -> np.ndarray:
    out = np.zeros(n)
    out[places] = values
    return out


def statistic(docs: DataFrame, model: KneserNeyRatio) -> DataFrame:
    """(doc_id, mean_ratio, top_ratio, top_word, raw) of every whole text, and its row_key where docs has one; texts without words have zeros."""
    own = [c for c in docs.columns if c == "row_key"]
    spark = docs.sparkSession
    shared.tune(spark)
    sent = spark.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio = sent.value
        store = UnitStore(lambda words: (ratio.words(words).view(np.uint32), np.ones(len(words), dtype=np.int64)), KNOWN_WORDS)
        for batch in batches:
            n = batch.num_rows
            mean, top, word = np.zeros(n), np.zeros(n), np.full(n, None, dtype=object)
            flat, counts = word_lists(batch.column(1))
            if len(flat):
                pool, start, _ = store.look(flat)
                value = pool[start].view(np.float32).astype(float)
                first = np.cumsum(counts) - counts
                has = np.flatnonzero(counts)
                mean[has] = np.add.reduceat(value, first[has]) / counts[has]
                top[has] = np.maximum.reduceat(value, first[has])
                best = np.flatnonzero(value == np.repeat(top, counts))
                of = np.repeat(np.arange(n), counts)[best]
                _, one = np.unique(of, return_index=True)
                word[of[one]] = flat.take(pa.array(best[one])).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(mean), pa.array(top), pa.array(word, pa.string()), pa.array(mean + top), *batch.columns[2:]], names=["doc_id", "mean_ratio", "top_ratio", "top_word", "raw", *own])

    return docs.select(F.col("doc_id").cast("long"), "text", *own).mapInArrow(shared.tidy(rows), "doc_id long, mean_ratio double, top_ratio double, top_word string, raw double" + ", row_key long" * len(own))


def fit(docs: DataFrame, known: DataFrame, most: int = MOST_LABELLED) -> KneserNeyRatio:
    """known: (doc_id, label); of each class at most `most` labels are used, those with the smallest digest of the id."""
    split = known.withColumn("toxic", F.col("label") >= 0.5)
    sample: dict[int, float] = {}
    for flag in (True, False):
        for r in split.where(F.col("toxic") == flag).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).select("doc_id", "label").collect():
            sample[r.doc_id] = r.label
    found = count_grams(count_words(docs, sample)).toArrow()
    arrays = {c: found[c].to_numpy() for c in found.column_names}
    for c in ("key", "context", "suffix"):
        arrays[c] = arrays[c].view(np.uint64)
    return KneserNeyRatio(**arrays)


def toxicity_scores(docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2, label: str = "toxic", threshold: float = THRESHOLD, key: bool = False) -> DataFrame:
    """(doc_id, held_out, score, predicted, top_word) for every document.

    Labels of ids whose crc32 modulo `folds` is `held` take no part. Null and empty texts have the statistic 0. Without
    usable labels every score is about 0.5. Repeated rows come back each; repeated labels of an id count as their mean;
    other columns play no part. With `key` a column k has the row's shared.row_key.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), *([shared.row_key("doc_id", "text").alias("row_key")] if key else []))
    shared.tune(docs.sparkSession)
    known = one_label(labels, "doc_id", label).where(fold(folds) != held)
    # a model knows the words of the documents it was fitted on: calibration takes documents of its own
    apart = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(CALIBRATION_PART)) == 0
    scored = shared.written(statistic(docs, fit(docs, known.where(~apart))), "toxicity")
    calibrate = Calibrator(-20.0, 60.0).fit(scored.join(known.where(apart), "doc_id"), "raw", "label")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = calibrate(batch.column(2).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s), pa.array((s >= threshold).astype(np.int32)), *batch.columns[3:]], names=["doc_id", "held_out", "score", "predicted", "top_word", *own])

    own = ["k"] if key else []
    return scored.select("doc_id", (fold(folds) == held).alias("held_out"), "raw", "top_word", *([F.col("row_key").alias("k")] if key else [])).mapInArrow(shared.tidy(score), "doc_id long, held_out boolean, score double, predicted int, top_word string" + ", k long" * key)
