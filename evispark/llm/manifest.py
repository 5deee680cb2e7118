"""Merkle manifest of a table: a tree over each group's rows, a tree over the groups' roots, and every row's proof.

1. A row's leaf is the SHA-256 of its fields, each with its length. Leaves are range-sorted by group and order and ranked.
2. Runs of fanout ** levels consecutive leaves are aligned blocks. A block is one contiguous numpy matrix of 64-byte hex
   digests, which is reshaped by the fanout and hashed row by row, level by level, up to one node. The blocks' nodes are the
   leaves of the next round, of a table so many times smaller, until every group has one node; then the groups' nodes go the
   same way up to the root.
3. The way down goes round by round: a block meets the siblings above it (one row) and its own nodes, and index arithmetic
   names each node's siblings at every level. No task holds more than a block, whatever a group's size.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evispark.llm import shared

FANOUT = 16
#: Levels of a block.
LEVELS = 3
DIGEST = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf(fields: dict[str, Column]) -> Column:
    """Hex SHA-256 of the fields in order: `-` for null, else the UTF-8 byte count, a colon and the value as text."""
    said = []
    for value in fields.values():
        text = value.cast("string")
        said.append(F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)))
    return F.sha2(F.concat(*said), 256)


def climb(digests: np.ndarray, fanout: int, levels: int | None) -> list[np.ndarray]:
    """Matrices of hex digests (n, 64), level by level, up to `levels` levels or, if None, to one node."""
    out = [np.ascontiguousarray(digests)]
    while len(out) <= levels if levels is not None else len(out[-1]) > 1:
        below = out[-1]
        full = len(below) // fanout
        hashed = [sha256(row).hexdigest() for row in below[: full * fanout].reshape(full, fanout * DIGEST)]
        if len(below) % fanout:
            hashed.append(sha256(below[full * fanout :]).hexdigest())
        out.append(np.frombuffer("".join(hashed).encode(), dtype=np.uint8).reshape(-1, DIGEST))
    return out


def siblings(tree: list[np.ndarray], fanout: int) -> Iterator[tuple[bytes, bytes]]:
    """Of every leaf the others of its runs, level by level, and for each level how many stand before it and after it."""
    raw = [(x.tobytes(), len(x)) for x in tree[:-1]]
    for i in range(len(tree[0])):
        own, shape = [], bytearray()
        for data, n in raw:
            low = i - i % fanout
            high = min(low + fanout, n)
            own += (data[low * DIGEST : i * DIGEST], data[(i + 1) * DIGEST : high * DIGEST])
            shape += bytes((i - low, high - i - 1))
            i //= fanout
        yield b"".join(own), bytes(shape)


def folded(claimed: bytes, others: bytes, shape: bytes) -> str:
    """The root that a leaf and its siblings give."""
    at, node = 0, claimed
    for before, after in zip(shape[::2], shape[1::2], strict=True):
        middle, end = at + before * DIGEST, at + (before + after) * DIGEST
        node = sha256(others[at:middle] + node + others[middle:end]).hexdigest().encode()
        at = end
    return node.decode()


def _same(column: pa.Array) -> np.ndarray:
    """Whether each row but the first equals the one before it, nulls being equal."""
    if pa.types.is_null(column.type) or len(column) < 2:
        return np.ones(max(len(column) - 1, 0), dtype=bool)
    codes = column.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
    return codes[1:] == codes[:-1]


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of consecutive rows with equal keys."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        same = np.logical_and.reduce([_same(batch.column(k)) for k in keys])
        bounds = [0, *(np.flatnonzero(~same) + 1).tolist(), batch.num_rows]
        for a, b in zip(bounds, bounds[1:]):
            part = batch.slice(a, b - a)
            if held and any(held[-1].column(k)[0].as_py() != part.column(k)[0].as_py() for k in keys):
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer("".join(column.to_pylist()).encode(), dtype=np.uint8).reshape(-1, DIGEST)


def _tree(run: pa.Table, fanout: int, levels: int) -> list[np.ndarray]:
    """A block's levels. The first block of a group may be all of it and ends at one node; further ones have all levels."""
    return climb(_matrix(run["digest"]), fanout, levels if run["block"][0].as_py() else None)


def ranked(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Add rank (0, 1, 2, ... of each tree) and block to a written table of rows with a column tree (null is a tree).

    Rows are range-sorted, so a tree may span partitions: a partition's first tree goes on from the earlier ones. These
    offsets, one for each partition at most, are broadcast. Rows that are equal in the order must be interchangeable.
    """

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, 0
        for batch in shared.numbered(batches):
            if not batch.num_rows:
                continue
            tree = batch.column("tree")
            change = np.concatenate([[last is None or last[0] != tree[0].as_py()], ~_same(tree)])
            at = np.arange(batch.num_rows)
            begin = np.maximum.accumulate(np.where(change, at, 0 if change[0] else -seen))
            rank = at - begin
            last, seen = (tree[batch.num_rows - 1].as_py(),), int(rank[-1]) + 1
            yield batch.set_column(batch.schema.get_field_index("_rank"), "_rank", pa.array(rank))

    keys = [F.asc_nulls_first("tree"), *order, F.col("_place")]
    sized = rows.withColumn("_place", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_place")
    ranged = shared.written(sized.mapInArrow(shared.tidy(number), shared.ddl(sized.schema) + ", _part int, _rank long"), "ranked")
    each = ranged.groupBy("_part", "tree").agg(F.count("*").alias("n"))
    before = F.expr("sum(n) over (partition by tree order by _part rows between unbounded preceding and 1 preceding)")
    offsets = each.select(F.col("_part").alias("_p"), F.col("tree").alias("_t"), before.alias("_before")).where("_before > 0")
    joined = ranged.join(F.broadcast(offsets), (F.col("_part") == F.col("_p")) & F.col("tree").eqNullSafe(F.col("_t")), "left")
    rank = F.col("_rank") + F.coalesce("_before", F.lit(0))
    return shared.written(joined.withColumn("rank", rank).drop("_part", "_rank", "_p", "_t", "_before"), "leaves")


def _block(fanout: int, levels: int) -> Column:
    return F.expr(f"rank div {fanout**levels}L").alias("block")


def _dealt(nodes: DataFrame) -> DataFrame:
    return nodes.repartition("tree", "block").sortWithinPartitions(F.asc_nulls_first("tree"), "block", "rank")


def rounds_up(nodes: DataFrame, fanout: int, levels: int) -> list[DataFrame]:
    """Tables (tree, rank, digest) of each round, the first one given, the last one with one node for each tree."""

    def up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, blocks, digests = [], [], []
        for run in _runs(batches, ["tree", "block"]):
            trees.append(run["tree"][0].as_py()), blocks.append(run["block"][0].as_py())
            digests.append(_tree(run, fanout, levels)[-1].tobytes().decode())
            if len(trees) == shared.ARROW_ROWS:
                yield batch(trees, blocks, digests)
                trees, blocks, digests = [], [], []
        if trees:
            yield batch(trees, blocks, digests)

    def batch(trees: list, blocks: list, digests: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(trees, pa.string()), pa.array(blocks, pa.int64()), pa.array(digests)], names=["tree", "rank", "digest"])

    out = [nodes]
    while (out[-1].agg(F.max("rank")).first()[0] or 0) > 0:
        below = _dealt(out[-1].select("tree", "rank", "digest", _block(fanout, levels)))
        out.append(shared.written(below.mapInArrow(shared.tidy(up), "tree string, rank long, digest string"), "nodes"))
    return out


PATH = "tree string, rank long, siblings binary, shape binary, subroot string"


def way_down(nodes: DataFrame, above: DataFrame | None, fanout: int, levels: int, carry: list[str]) -> DataFrame:
    """Rows of nodes (tree, rank, *carry) with all siblings on the way up: those in their block, then those of the path that
    `above` (columns as PATH) has for the block's node. Without `above` the block's node is the root."""
    kinds = {f.name: f.dataType.simpleString() for f in nodes.schema}
    own = nodes.select("tree", "rank", "digest", *(c for c in carry if c != "digest"), _block(fanout, levels))
    has_paths = above is not None
    if has_paths:
        paths = above.select("tree", F.lit(-1).cast("long").alias("rank"), F.col("rank").alias("block"), "siblings", "shape", "subroot")
        own = own.unionByName(paths, allowMissingColumns=True)

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches, ["tree", "block"]):
            over, shape_over, subroot = b"", b"", None
            if has_paths:
                over, shape_over, subroot = (run[c][0].as_py() for c in ("siblings", "shape", "subroot"))
                run = run.slice(1)
            found = siblings(_tree(run, fanout, levels), fanout)
            for a in range(0, run.num_rows, 256):
                rows = run.slice(a, 256).combine_chunks().to_batches()[0]
                pairs = [next(found) for _ in range(rows.num_rows)]
                new = [pa.array([x + over for x, _ in pairs], pa.binary()), pa.array([x + shape_over for _, x in pairs], pa.binary()), pa.array([subroot] * len(pairs), pa.string())]
                yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in ("tree", "rank", *carry)), *new], names=["tree", "rank", *carry, "siblings", "shape", "subroot"])

    schema = "tree string, rank long" + "".join(f", `{c}` {kinds[c]}" for c in carry) + ", siblings binary, shape binary, subroot string"
    return _dealt(own).mapInArrow(shared.tidy(down), schema)


def proofs(rows: DataFrame, fanout: int = FANOUT, levels: int = LEVELS, carry: list[str] | None = None) -> DataFrame:
    """Of rows (tree, ord, digest, *carry), each tree's nodes in the order of ord and then the digest:
    (tree, rank, digest, *carry, siblings, shape, subroot, root). `siblings` holds hex digests, `shape` for each level how
    many stand before and after."""
    carry = carry or []
    leaves = ranked(shared.written(rows, "digests"), [F.asc_nulls_first("ord"), F.col("digest"), *(F.col(c) for c in carry if c != "ord")])
    each = rounds_up(leaves, fanout, levels)
    tops = each[-1].select(F.lit("").alias("tree"), F.col("tree").alias("group"), "digest")
    tops = ranked(shared.written(tops, "subroots"), [F.asc_nulls_first("group")])
    high = rounds_up(tops, fanout, levels)
    first = high[-1].first()
    root = first.digest if first else ""
    path = None
    for nodes in reversed(high):
        path = shared.written(way_down(nodes, path, fanout, levels, ["group", "digest"] if nodes is high[0] else []), "paths")
    path = path.select(F.col("group").alias("tree"), F.lit(0).cast("long").alias("rank"), "siblings", "shape", F.col("digest").alias("subroot"))
    for nodes in reversed(each[1:]):
        path = shared.written(way_down(nodes, path, fanout, levels, []), "paths")
    return way_down(leaves, path, fanout, levels, ["digest", *carry]).withColumn("root", F.lit(root))


def manifest(docs: DataFrame, group: str = "source", order: str = "doc_id", fields: tuple[str, ...] = FIELDS, fanout: int = FANOUT, levels: int = LEVELS, claims: dict[str, Column] | None = None) -> DataFrame:
    """(tree, order column, leaf, claimed, siblings, shape, subroot, root) of every row of docs.

    The tree is the group as text; a null group is one and comes first, a null order value stands first in its tree, and rows
    that repeat it follow by their leaves. Equal rows are leaves each. Columns that are not named take no part, whatever they
    are called. An empty table gives no rows. `claims` replaces fields for the column `claimed`, the leaf of a changed row.
    """
    own = {c: F.col(f"`{c}`") for c in fields}
    claimed = leaf(own | (claims or {}))
    rows = docs.select(F.col(f"`{group}`").cast("string").alias("tree"), F.col(f"`{order}`").alias("ord"), leaf(own).alias("digest"), claimed.alias("claimed"))
    return proofs(rows, fanout, levels, ["ord", "claimed"]).select("tree", F.col("ord").alias(order), F.col("digest").alias("leaf"), "claimed", "siblings", "shape", "subroot", "root")


def verified(rows: DataFrame, leaf_col: str = "claimed") -> DataFrame:
    """Add folded_root, what the leaf and the siblings give, and verified, whether it is the root."""
    names = [*rows.columns, "folded_root", "verified"]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, others, shape = (batch.column(c).to_pylist() for c in (leaf_col, "siblings", "shape"))
            roots = pa.array([folded(x.encode(), y, z) for x, y, z in zip(own, others, shape, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, roots, pc.equal(roots, batch.column("root"))], names=names)

    return rows.mapInArrow(shared.tidy(fold), shared.ddl(rows.schema) + ", folded_root string, verified boolean")
