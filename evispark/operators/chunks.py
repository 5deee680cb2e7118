"""Evidence chunks: whole blocks packed in order under a budget of characters; oversize ones come in fragments.

Greedy packing goes from one chunk's start to the next, yet no task holds a group. Running sums of sizes place every fragment
on a line. The line is cut into bins of equal width, in which each fragment's successor, the first that no longer fits its
chunk, is found by search, and paths of successors are followed by pointer doubling to the first start behind the bin. Only
fragments near a bin's begin can be entered, so a bin shrinks to a small table of entries and exits. Tables of neighbouring
bins are composed until a group has one; then the way goes back, from the entry of all to the entry of each bin.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evispark.functions.udfs import call
from evispark.session import cut

SEPARATOR = 2
#: Characters of a bin, at least; and how many bins' tables a task composes.
BIN = 1 << 22
FAN = 64
#: Stands for the place behind a group's last chunk.
END = 1 << 62

TABLE = "group string, bin long, at long, to long, n long"
ENTRY = "group string, bin long, at long, n long"


def chunk_blocks(blocks: DataFrame, budget: int, group: str = "source_id", order: str = "rank", text: str = "content", header: int = 0) -> DataFrame:
    """(group, order, fragment, chunk): the chunk of every fragment, numbered from 1 in each group.

    A fragment joins the current chunk while both and a separator fit the budget; otherwise it opens the next. Texts over
    the room of a fragment, max(128, budget - header - 32), are split. `order` is to be distinct in its group. A null text is
    an empty one; a null group is a group. See the module for how a group of any size is dealt out.
    """
    room = max(128, budget - header - 32)
    rows = blocks.select(F.col(group).cast("string").alias("group"), F.col(order).cast("long").alias("ord"), F.posexplode(call("fragment_sizes", F.coalesce(text, F.lit("")), F.lit(room))).alias("fragment", "size"))
    rows = rows.select("group", "ord", (F.col("fragment") + 1).alias("fragment"), (F.col("size") + header).cast("long").alias("size"))
    reach = max(budget, header + room) + SEPARATOR  # the next start lies within so many characters
    width = max(BIN, 8 * reach)
    placed = cut(running(rows, ["ord", "fragment"], F.col("size") + SEPARATOR).withColumn("bin", F.expr(f"before div {width}L")))
    own = placed.withColumn("home", F.col("bin"))
    entry = _entries_of_bins(own, budget, width, reach)
    both = own.unionByName(entry.select("group", "bin", F.col("at").alias("before"), "n"), allowMissingColumns=True)
    out = both.groupBy("group", "bin").applyInArrow(_numbered(budget), "group string, ord long, fragment int, chunk long")
    return out.select(F.col("group").alias(group), F.col("ord").alias(order), "fragment", "chunk")


def _entries_of_bins(own: DataFrame, budget: int, width: int, reach: int) -> DataFrame:
    """(group, bin, at, n): the first chunk start of each bin and the chunks before it."""
    most = own.agg(F.max("bin")).first()[0] or 0
    if most == 0:  # every group is one bin, which begins with its first fragment
        zero = F.lit(0).cast("long")
        return own.select("group", zero.alias("bin"), zero.alias("at"), zero.alias("n")).distinct()
    early = own.where((F.col("bin") > 0) & (F.col("before") % width < reach)).withColumn("bin", F.col("bin") - 1)
    tables = [cut(own.union(early).groupBy("group", "bin").applyInArrow(_entries(budget, width, reach), TABLE))]
    while most > 0:
        tables.append(cut(tables[-1].withColumn("part", F.expr(f"bin div {FAN}L")).groupBy("group", "part").applyInArrow(_composed, TABLE)))
        most //= FAN
    entry = tables[-1].where("at = 0").select("group", "bin", "at", F.lit(0).cast("long").alias("n"))
    for below in reversed(tables[:-1]):
        both = below.withColumn("part", F.expr(f"bin div {FAN}L")).unionByName(entry.select("group", F.col("bin").alias("part"), "at", "n"), allowMissingColumns=True)
        entry = cut(both.groupBy("group", "part").applyInArrow(_entered, ENTRY))
    return entry


def running(rows: DataFrame, order: list[str], value: Column) -> DataFrame:
    """Rows with `before`, the sum of value over the earlier rows of their group, by ranges: local sums, and for the range in
    which a group goes on the sum of its earlier ranges, of which there is one for each partition at most."""
    ranged = cut(rows.repartitionByRange(F.asc_nulls_first("group"), *order).withColumn("range", F.spark_partition_id()).withColumn("value", value))
    local = F.sum("value").over(Window.partitionBy("range", "group").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)) - F.col("value")
    sums = ranged.groupBy("range", "group").agg(F.sum("value").alias("value"))
    earlier = sums.select(F.col("range").alias("r"), F.col("group").alias("g"), F.sum("value").over(Window.partitionBy("group").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)).alias("more")).where("more > 0")
    joined = ranged.withColumn("before", local).join(F.broadcast(earlier), (F.col("range") == F.col("r")) & F.col("group").eqNullSafe(F.col("g")), "left")
    return joined.withColumn("before", F.col("before") + F.coalesce("more", F.lit(0))).drop("r", "g", "more", "range", "value")


def _arrays(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [table[c].fill_null(-1).to_numpy().astype(np.int64) for c in names]


def _successors(before: np.ndarray, size: np.ndarray, budget: int) -> np.ndarray:
    """Of each fragment the place of the first after it that doesn't fit its chunk; len(before) if all fit."""
    return np.maximum(np.searchsorted(before + size, before + budget, side="right"), np.arange(len(before)) + 1)


def followed(to: np.ndarray, n: np.ndarray, inside: int) -> tuple[np.ndarray, np.ndarray]:
    """By pointer doubling: the first place at or after `inside` that every place leads to, and the sum of n on the way."""
    to, n = to.copy(), n.copy()
    while (on := np.flatnonzero(to[:inside] < inside)).size:
        n[on], to[on] = n[on] + n[to[on]], to[to[on]]
    return to, n


def _entries(budget: int, width: int, reach: int):
    """A bin's table: for each fragment that a chunk from before the bin can end at, the next start behind the bin (null: the
    group ends) and the number of chunks on the way."""

    def make(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("before")
        before, size, home, own_bin = _arrays(rows, "before", "size", "home", "bin")
        inside = int((home == own_bin).sum())
        to, n = followed(_successors(before, size, budget), np.ones(len(before), np.int64), inside)
        start = own_bin[0] * width
        use = np.flatnonzero(before[:inside] - start < reach) if own_bin[0] else np.array([0])
        out = np.append(before, -1)[to[use]]
        return _table(rows["group"][0], own_bin[0], before[use], out, n[use])

    return make


def _table(group: pa.Scalar, own_bin: int, at: np.ndarray, to: np.ndarray, n: np.ndarray) -> pa.Table:
    return pa.table({"group": pa.array([group.as_py()] * len(at), pa.string()), "bin": pa.array(np.full(len(at), own_bin)), "at": pa.array(at), "to": pa.array(to, mask=to < 0), "n": pa.array(n)})


def _composed(key: tuple, rows: pa.Table) -> pa.Table:
    """The table of neighbouring bins as one bin: the entries of the first one, followed through all."""
    rows = rows.sort_by("at")
    at, to, n, bins, part = _arrays(rows, "at", "to", "n", "bin", "part")
    inside = len(at)
    out = (to < 0) | (to > at[-1])
    last, count = followed(np.where(out, inside + np.arange(inside), np.searchsorted(at, to)), n, inside)
    use = np.flatnonzero(bins == bins.min())
    return _table(rows["group"][0], part[0], at[use], to[last[use] - inside], count[use])


def _entered(key: tuple, rows: pa.Table) -> pa.Table:
    """The entry of each bin of a part from the part's own (a row without a bin): its place, and the chunks before it. Where the
    last chunk has begun the next bin, which may hold the rest of it, has END."""
    named = rows["bin"].is_null().to_numpy()
    at, to, n, bins = _arrays(rows, "at", "to", "n", "bin")
    i = int(np.flatnonzero(named)[0]) if named.any() else None
    order = np.flatnonzero(~named)[np.argsort(at[~named], kind="stable")]
    own, out = at[order], []
    if i is not None and len(own):
        now, base, b = int(at[i]), int(n[i]), int(bins[order[0]]) - 1
        while (k := int(np.searchsorted(own, now))) < len(own) and own[k] == now:
            b = int(bins[order[k]])
            out.append((b, now, base))
            now, base = int(to[order[k]]), base + int(n[order[k]])
            now = END if now < 0 else now
        if now == END:
            out.append((b + 1, END, base))
    b, a, c = np.array(out, dtype=np.int64).reshape(-1, 3).T
    return pa.table({"group": pa.array([rows["group"][0].as_py()] * len(out), pa.string()), "bin": pa.array(b), "at": pa.array(a), "n": pa.array(c)})


def _numbered(budget: int):
    """The chunk of every fragment of a bin. The row without a fragment is the entry; what stands before it is of the chunk that
    began in an earlier bin."""

    def make(key: tuple, rows: pa.Table) -> pa.Table:
        entry = rows.filter(rows["fragment"].is_null())
        rows = rows.filter(rows["fragment"].is_valid()).sort_by("before")
        before, size = _arrays(rows, "before", "size")
        begin, base = (entry["before"][0].as_py(), entry["n"][0].as_py()) if entry.num_rows else (None, 0)
        starts = np.zeros(len(before), dtype=np.int64)
        i = len(before) if begin is None else int(np.searchsorted(before, begin))
        to = _successors(before, size, budget)
        while i < len(before):
            starts[i] = 1
            i = int(to[i])
        chunk = base + np.cumsum(starts)
        return pa.Table.from_arrays([rows["group"], rows["ord"], rows["fragment"].cast(pa.int32()), pa.chunked_array([pa.array(chunk)])], names=["group", "ord", "fragment", "chunk"])

    return make
