"""Connected components of an undirected graph given as edges, by alternating large-star and small-star rounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evispark.llm import shared

PAIR = "a long, b long"


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition's edges as stars around the smallest node of each of its own components: fewer edges, same reach."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        root = x
        while (y := up.get(root, root)) != root:
            root = y
        while up.get(x, x) != root:
            up[x], x = root, up[x]
        return root

    for batch in batches:
        for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            up.setdefault(x, x), up.setdefault(y, y)
            x, y = top(x), top(y)
            if x != y:
                up[max(x, y)] = min(x, y)
        if len(up) > 2_000_000:  # bounded memory: what is known leaves as stars, which later rounds join
            yield _stars(up, top)
            up.clear()
    yield _stars(up, top)


def _stars(up: dict[int, int], top) -> pa.RecordBatch:
    rows = [(x, top(x)) for x in list(up)]
    a = np.array([r for r in rows if r[0] != r[1]], dtype=np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], names=["a", "b"])


def _least(edges: DataFrame, both_ways: bool) -> DataFrame:
    """(a, m): the smallest of a node and its neighbours, of all of them or of the smaller ones."""
    seen = edges.union(edges.select("b", "a")) if both_ways else edges
    return seen.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))


def _lower(edges: DataFrame, least: DataFrame, both_ways: bool) -> DataFrame:
    """One star step on edges with a > b. Large star: every larger neighbour of a node moves to the node's smallest
    neighbour. Small star: a node and its smaller neighbours move to the smallest of these. The smallest ones are a written
    table, so that the join deals out both sides and Spark can split a node of many edges."""
    if both_ways:
        out = edges.select(F.col("b").alias("a"), F.col("a").alias("v")).join(least, "a").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, component_id) for every node of an edge: component_id is the smallest node that can be reached.

    edges: two long columns, the ends; direction, repeats and loops don't matter; an edge with a null end is none. Nodes
    without another node are left out, also those whose only edges are loops.
    """
    a, b = edges.columns[:2]
    pairs = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    now = shared.written(pairs.mapInArrow(shared.tidy(_contract), PAIR), "edges")
    while not _stars_only(now):
        before = [now]
        for both_ways in (True, False):
            least = shared.written(_least(now, both_ways), "least")
            now = shared.written(_lower(now, least, both_ways), "edges")
            before += [least, now]
        shared.discard(*before[:-1])
    return now.select(F.col("a").alias("id"), F.col("b").alias("component_id")).union(now.select(F.col("b").alias("id"), F.col("b").alias("component_id")).distinct())


def _stars_only(edges: DataFrame) -> bool:
    """Does every node either have one edge, to a smaller node, or only edges from larger ones?"""
    count, ends = edges.agg(F.count("*"), F.countDistinct("a")).first()
    return count == ends and edges.join(edges.select(F.col("b").alias("a")).distinct(), "a", "left_semi").isEmpty()
