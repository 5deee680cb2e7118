"""Near-duplicate embeddings: random-hyperplane signs in several tables, exact cosines inside buckets, components.

A table deals out, for each vector, its bucket, its id and a code of further signs. In a bucket codes are compared by the number
of signs that differ; only vectors with another near them are fetched, and their cosines computed in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evispark.llm import shared
from evispark.llm.components import components
from evispark.llm.textkit import runs

#: Chance that a pair exactly at the threshold shares no bucket; closer pairs are missed far less often.
MISS = 1e-4
#: Vectors of a bucket that one task compares with each other; larger buckets are compared in tiles of this size.
TILE = 2048
#: Signs of a code, by which rows of a bucket are told apart before vectors move.
CODE_BITS = 256


def clean(vectors: DataFrame, vector: str) -> DataFrame:
    """Keep the vector where all components are finite numbers and one is not zero, else null."""
    v = F.col(f"`{vector}`")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.withColumn(vector, F.when(fine, v))


def plan(rows: int, threshold: float) -> tuple[int, int]:
    """(bits of a table, tables) for so many vectors with one label."""
    bits = max(6, min(30, math.ceil(math.log2(max(rows, 1) / 16 + 1))))
    share = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(MISS) / math.log1p(-share)))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def sign_tables(batch: np.ndarray, bits: int, tables: int, seed: int) -> np.ndarray:
    """Bucket of every vector in every table."""
    planes = np.random.default_rng([seed, batch.shape[1]]).standard_normal((batch.shape[1], bits * tables))
    flags = (batch @ planes > 0).reshape(len(batch), tables, bits)
    return (flags * (1 << np.arange(bits, dtype=np.int64))).sum(2).astype(np.int32)


def bucket_links(x: np.ndarray, sig: np.ndarray, table: int, own: np.ndarray, i: int, j: int, threshold: float) -> np.ndarray:
    """Which rows of a tile link: a symmetric boolean matrix without pairs that met in an earlier table."""
    near = x @ x.T >= threshold
    np.fill_diagonal(near, False)
    if i != j:
        near &= own[:, None] != own[None, :]
    a, b = np.nonzero(near)
    if table and len(a):
        old = (sig[a, :table] == sig[b, :table]).any(1)
        near[a[old], b[old]] = False
    return near


def codes(batch: np.ndarray, seed: int) -> np.ndarray:
    """CODE_BITS further signs of every vector, packed into bytes."""
    planes = np.random.default_rng([seed, 1, batch.shape[1]]).standard_normal((batch.shape[1], CODE_BITS))
    return np.packbits(batch @ planes > 0, axis=1)


def most_differing(threshold: float) -> int:
    """In how many signs of a code vectors at the threshold may differ; more have a chance of about 1e-7."""
    share = math.acos(threshold) / math.pi
    return math.ceil(CODE_BITS * share + 5.2 * math.sqrt(CODE_BITS * share * (1 - share)))


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", seed: int = 11) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row; see the module's text for the method.

    Vectors link when their labels are equal and not null, their lengths are equal, and their cosine in double precision is
    at least the threshold. A vector that is null, zero or holds a null or non-finite component links with nothing, nor
    does one without an id. Equal vectors are one node that counts how many there are; a row that repeats id, label and
    vector counts once; rows that repeat an id alone are vectors of their own, with links of their own. Other columns play
    no part.
    """
    v = clean(vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label}`").alias("label"), F.col(f"`{vector}`").cast("array<double>").alias("v")), "v")
    usable = v.where("vec_id is not null and label is not null and v is not null")
    same = usable.distinct().groupBy("label", "v").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    nodes = shared.written(same.withColumn("dim", F.size("v")).withColumn("node", F.monotonically_increasing_id()), "nodes")
    most = nodes.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 0
    bits, tables = plan(most, threshold)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy(zero_copy_only=False)
            for d in np.unique(dims):
                part = batch.filter(pa.array(dims == d))
                x = _matrix(part.column("v"), int(d))
                sig = sign_tables(x, bits, tables, seed)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sig) + 1, dtype=np.int32) * tables), pa.array(sig.ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns, lists, pa.array([c.tobytes() for c in codes(x, seed)], pa.binary())], names=[*part.schema.names, "sig", "code"])

    signed = shared.written(nodes.mapInArrow(shared.tidy(sign), shared.ddl(nodes.schema) + ", sig array<int>, code binary"), "signed")
    place = ["label", "dim", "table", "bucket"]
    dealt = signed.select("label", "dim", "node", "code", F.posexplode("sig").alias("table", "bucket"))
    counts = shared.written(dealt.groupBy(*place).count().where("count > 1").withColumn("tiles", F.ceil(F.col("count") / TILE).cast("int")).drop("count"), "buckets")
    rows = dealt.join(counts, place)
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    key = [*place, "i", "j"]
    rows = rows.select(*place, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "code")
    bound = most_differing(threshold)

    def near_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in sorted_runs(batches, key):
            if run.num_rows < 2:
                continue
            i, j = run.column("i")[0].as_py(), run.column("j")[0].as_py()
            flags = np.unpackbits(np.frombuffer(b"".join(run.column("code").to_pylist()), np.uint8).reshape(run.num_rows, -1), axis=1).astype(np.float32) * 2 - 1
            near = (CODE_BITS - flags @ flags.T) / 2 <= bound
            np.fill_diagonal(near, False)
            if i != j:
                own = run.column("own").to_numpy()
                near &= own[:, None] != own[None, :]
            if near.any():
                yield from run.filter(pa.array(near.any(1))).drop_columns(["code"]).combine_chunks().to_batches()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in sorted_runs(batches, key):
            if run.num_rows < 2:
                continue
            dim, table, i, j = (run.column(c)[0].as_py() for c in ("dim", "table", "i", "j"))
            x = _matrix(run.column("v").combine_chunks(), dim)
            x /= np.sqrt((x * x).sum(1))[:, None]
            own, node, copies = (run.column(c).to_numpy() for c in ("own", "node", "copies"))
            near = bucket_links(x, run.column("sig").combine_chunks().flatten().to_numpy().reshape(len(x), -1), table, own, i, j, threshold)
            some = near.any(1)
            if not some.any():
                continue
            near, node, copies = near[np.ix_(some, some)], node[some], copies[some]
            first = np.where(near, node[None, :], np.iinfo(np.int64).max).min(1)
            # links to the smallest neighbour, and one link back from it: enough to join what hangs together
            reach = np.minimum(first, node)
            while True:
                new = np.minimum(np.where(near, reach[None, :], np.iinfo(np.int64).max).min(1), reach)
                if (new == reach).all():
                    break
                reach = new
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(near.astype(np.int64) @ copies), pa.array(reach)], names=["node", "links", "least"])

    # a tile has at most about 2 x TILE rows; runs are cut from sorted rows, whichever batches they come in. Every table deals
    # out ids and codes only; vectors follow where a code has another near it
    n = shared.partitions(v.sparkSession)
    chosen = shared.written(_tiled(rows, key, n).mapInArrow(shared.tidy(near_codes), shared.ddl(rows.drop("code").schema)), "chosen")
    full = chosen.join(signed.select("node", "copies", "v", "sig"), "node").select(*chosen.columns, "copies", "v", "sig")
    found = shared.written(_tiled(full, key, n).mapInArrow(shared.tidy(compare), "node long, links long, least long"), "links")
    shared.discard(counts, chosen)
    groups = components(found.select("node", "least")).withColumnRenamed("id", "node").withColumnRenamed("component_id", "root")
    grouped = shared.written(nodes.select("node", "label", "v", "copies", "least").join(groups, "node", "left").withColumn("root", F.coalesce("root", "node")), "grouped")
    least = shared.written(grouped.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    done = grouped.join(least, "root").join(links, "node", "left").select("label", "v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    done = shared.written(done, "done")
    shared.discard(signed, nodes, found, grouped, least)
    out = v.where("vec_id is not null").join(done, ["label", "v"], "left").unionByName(v.where("vec_id is null"), allowMissingColumns=True)
    group = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), group.alias("component_id"), F.coalesce(F.col("vec_id") == group, F.lit(True)).alias("kept"))


def _tiled(rows: DataFrame, key: list[str], n: int) -> DataFrame:
    return rows.repartition(n, *key).sortWithinPartitions(*key)


def sorted_runs(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[pa.Table]:
    """Cut sorted rows into tables of equal keys, across batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        cut = np.zeros(n, dtype=bool)
        for c in key:
            x = batch.column(c).to_numpy(zero_copy_only=False)
            cut[1:] |= x[1:] != x[:-1]
        at = [0, *np.flatnonzero(cut), n]
        for a, b in zip(at[:-1], at[1:], strict=True):
            mine = tuple(batch.column(c)[a].as_py() for c in key)
            if mine != last and held:
                yield pa.Table.from_batches(held)
                held = []
            last = mine
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)
