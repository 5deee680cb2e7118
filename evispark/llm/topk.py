"""Exact top-k inner products: tiled matrix products of query blocks and shards, merged per query in a tree."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evispark.llm import shared

QUERY_BLOCK = 1024
SHARD = 16_384
SLICE = 2048
LONG = np.iinfo(np.int64)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest of each row, ties to smaller ids; rows keep -1 ids where there are fewer."""
    if scores.shape[1] > 4 * k:
        kth = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k]
        rows, cols = np.nonzero(scores >= kth[:, None])
        width = np.bincount(rows, minlength=len(scores)).max(initial=1)
        at = np.arange(len(rows)) - np.searchsorted(rows, rows)
        s, i = np.full((len(scores), width), LONG.min, np.int64), np.full((len(scores), width), -1, np.int64)
        s[rows, at], i[rows, at] = scores[rows, cols], ids[rows, cols]
        # a tie of very many keeps only the smallest ids of it, chosen below
        scores, ids = s, i
    order = np.lexsort((np.where(ids < 0, LONG.max, ids), -(scores + (scores == LONG.min))), axis=1)[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer inner products: by floats where all sums stay below 2**53, else by 64-bit integers, else by long arithmetic
    held within the range of long."""
    bound = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * q.shape[1]
    if bound < 2**53:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    if bound < 2**62:
        return q @ c.T
    exact = q.astype(object) @ c.astype(object).T
    return np.clip(exact, LONG.min + 1, LONG.max).astype(np.int64)


def exact_top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row the k highest integer inner products with all other rows.

    Components become floor(scale * x) as long. Vectors that are null or hold a null or non-finite component, and rows
    without an id, take no part; vectors meet only others of their length. Rows that repeat an id and a vector count once;
    rows with the query's own id are not its candidates. Ties go to smaller ids.
    """
    spark = vectors.sparkSession
    v = F.col(f"`{vector}`")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    whole = vectors.where(F.col(f"`{id_col}`").isNotNull() & v.isNotNull() & fine)
    whole = whole.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v"), is_query.alias("asks")).distinct().withColumn("dim", F.size("v"))
    whole = shared.written(whole, "vectors")
    sizes = whole.agg(F.count("*"), F.count_if("asks")).first()
    shards, blocks = max(1, -(-sizes[0] // SHARD)), max(1, -(-sizes[1] // QUERY_BLOCK))
    shards = max(shards, min(shared.partitions(spark), -(-sizes[0] // SLICE)))
    asked = whole.where("asks").select("dim", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(0).alias("kind"), "id", "v")
    there = whole.select("dim", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(shards)).cast("int").alias("shard"), F.lit(1).alias("kind"), "id", "v")
    tile = ["dim", "block", "shard"]

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, q_ids, q, top = None, [], [], None

        def done() -> Iterator[pa.RecordBatch]:
            if top is not None:
                s, i = top
                row, col = np.nonzero(i >= 0)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(q_ids)[row]), pa.array(i[row, col]), pa.array(s[row, col])], names=["query_id", "vec_id", "score"])

        for batch in batches:
            cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in (*tile, "kind")]
            cut = np.zeros(batch.num_rows, dtype=bool)
            for x in cols:
                cut[1:] |= x[1:] != x[:-1]
            at = np.unique([0, *np.flatnonzero(cut), *range(0, batch.num_rows, SLICE), batch.num_rows])
            for a, b in zip(at[:-1], at[1:], strict=True):
                mine = tuple(int(x[a]) for x in cols[:3])
                if mine != now:
                    yield from done()
                    now, q_ids, q, top = mine, [], [], None
                ids = batch.column("id").slice(a, b - a).to_numpy()
                x = batch.column("v").slice(a, b - a).flatten().to_numpy().reshape(b - a, mine[0])
                if cols[3][a] == 0:
                    q_ids.append(ids)
                    q.append(x)
                elif q:
                    own = np.concatenate(q_ids)
                    s = products(np.concatenate(q), x)
                    i = np.broadcast_to(ids, s.shape).copy()
                    s[own[:, None] == i], i[own[:, None] == i] = LONG.min, -1
                    if top is not None:
                        s, i = np.hstack([top[0], s]), np.hstack([top[1], i])
                    top = best(s, i, k)
        yield from done()

    # a block has about QUERY_BLOCK queries and comes before its shard, which streams past it in slices
    lists = asked.union(there).repartition(shared.partitions(spark), *tile).sortWithinPartitions(*tile, "kind").mapInArrow(shared.tidy(multiply), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    part = Window.partitionBy("query_id", "branch").orderBy(F.desc("score"), "vec_id")
    branch = lists.withColumn("branch", F.pmod(F.xxhash64("vec_id"), F.lit(max(1, round(shards**0.5)))))
    some = branch.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= k).drop("rank", "branch")
    return some.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
