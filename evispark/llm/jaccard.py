"""N-gram Jaccard join: documents link when their word-shingle sets overlap enough; count vectors in R-trees bound overlaps.

1. A count sketch of fixed size orders shingles from rare to common. Of each set only the first shingles in this order
   meet in blocks, enough of them that no linking pair stays apart (prefix filtering by size).
2. Each document first meets hubs of its blocks, documents with the fewest shingles that are rarer. Exact verification of
   these few pairs finds most links, and components follow.
3. Only blocks in which components still differ go on. Every document there is a point of group counts (its shingles,
   hashed into groups); an R-tree over a block's points bounds each overlap by summed coordinate minima. First every
   document of a smaller component meets the partner with the best bound; when what links has joined, all pairs of
   different components that the bound cannot rule out are verified exactly. So no link between components is lost, while
   pairs inside a component, which can be quadratically many, are never enumerated.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evispark.llm import shared
from evispark.llm.components import components
from evispark.llm.learning import BRANCHES
from evispark.llm.spans import keyed
from evispark.llm.textkit import BASES, U, Words, chunks, digest, gather, mix, prefix, signed, text_bytes

WORDS = 5
SKETCH_BITS = 22
#: Bits of a shingle's digest that name its block; blocks that share a name by chance only mean more pairs to bound.
TOKEN_BITS = 48
GROUPS = 512
TILE = 2048
LEAF = 16
#: Blocks up to this size are one leaf: all their pairs are bounded at once.
SMALL = 32
#: Pairs that a task holds at once.
PORTION = 200_000
#: Bits of the filter over candidate ids, which spares the shuffle the texts of most others; a full one lets all pass.
FILTER_BITS = 24


def shingle_sets(buf: np.ndarray, off: np.ndarray, n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(start of each text's set with the total at the end, sorted distinct digests) of n-word shingles, case of A-Z apart.

    A text with fewer words has the whole sequence as its one shingle; without words the set is empty."""
    words = Words(buf, off, lower=True)
    sums = prefix(words.hashes(), BASES[2])
    count = np.diff(words.of)
    each = np.where(count >= n, count - n + 1, (count > 0).astype(np.int64))
    text = np.repeat(np.arange(len(count)), each)
    start = np.arange(len(text)) - np.repeat(np.cumsum(each) - each, each) + words.of[text]
    h = digest(sums, start, np.minimum(start + n, words.of[text + 1]), BASES[2])
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    h, text = h[new], text[new]
    return np.searchsorted(text, np.arange(len(count) + 1)), h


def sketch(docs: DataFrame) -> np.ndarray:
    """Rank of commonness for each of 2**SKETCH_BITS slots of shingles: log2 of how many fall there, 2**16 at most. Of fixed
    size; where slots fill up the order says less, and blocks grow, but no pair is lost."""
    size, parts = 1 << SKETCH_BITS, 64

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.uint32)
        for batch in batches:
            buf, off = text_bytes(batch.column(0))
            for a, b in chunks(off):
                np.add.at(total, (shingle_sets(buf, off[a : b + 1])[1] >> U(64 - SKETCH_BITS)).astype(np.int64), 1)
        yield from sent(enumerate(np.split(total, parts)))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[part] = total.get(part, 0) + np.frombuffer(counts, dtype=np.uint16).astype(np.uint32)
        if total:
            yield from sent(total.items())

    def sent(counts) -> Iterator[pa.RecordBatch]:
        keys, values = zip(*((k, np.minimum(x, 2**16 - 1).astype(np.uint16).tobytes()) for k, x in counts), strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(values)], names=["part", "counts"])

    schema = "part long, counts binary"
    out = np.zeros(size, dtype=np.uint8)
    for r in docs.select("text").mapInArrow(shared.tidy(count), schema).repartition(BRANCHES, "part").mapInArrow(shared.tidy(add), schema).collect():
        out[r.part * size // parts : (r.part + 1) * size // parts] = np.log2(np.frombuffer(r.counts, dtype=np.uint16) + 1.0)
    return out


def needed(a, b, threshold: Fraction):
    """Smallest overlap with which sets of these sizes link."""
    up, down = threshold.numerator, threshold.numerator + threshold.denominator
    return -(-(a + b) * up // down)


def prefixes(docs: DataFrame, rank: np.ndarray, threshold: Fraction) -> DataFrame:
    """(k, set1, set2, n, tokens, own) of every row: two digests of its set, the set's size, and its first shingles, of
    which the first `own` also stand for it as the smaller set of a pair. Of equal sets in a task one has tokens."""
    sent = docs.sparkSession.sparkContext.broadcast(rank)
    p, q = threshold.numerator, threshold.denominator

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, seen = sent.value, set()
        for batch in batches:
            buf, off = text_bytes(batch.column(1))
            key = batch.column(0)
            for a, b in chunks(off):
                of, h = shingle_sets(buf, off[a : b + 1])
                n = np.diff(of)
                text = np.repeat(np.arange(b - a), n)
                both = []
                for salt in (0x9E37, 0x85EB):
                    sums = np.concatenate([[U(0)], np.cumsum(mix(h ^ U(salt * 0x10001)), dtype=np.uint64)])
                    both.append(mix(sums[of[1:]] - sums[of[:-1]] + n.astype(np.uint64)))
                fresh = np.zeros(b - a, dtype=bool)
                for i, s in enumerate(zip(both[0].tolist(), both[1].tolist(), strict=True)):
                    if n[i] and s not in seen:
                        seen.add(s)
                        fresh[i] = True
                order = np.lexsort((h, rank[(h >> U(64 - SKETCH_BITS)).astype(np.int64)], text))
                take = np.where(fresh, n + (-n * p // q) + 1, 0)  # n - ceil(t n) + 1
                own = np.where(fresh, n + (-n * 2 * p // (p + q)) + 1, 0)  # n - ceil(2 t / (1 + t) n) + 1
                place = np.arange(len(h)) - of[text]
                first = h[order][place < take[text]] >> U(64 - TOKEN_BITS)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(take)]).astype(np.int32)), pa.array(signed(first)))
                yield pa.RecordBatch.from_arrays([key.slice(a, b - a), pa.array(signed(both[0])), pa.array(signed(both[1])), pa.array(n.astype(np.int32)), lists, pa.array(own.astype(np.int32))], names=["k", "set1", "set2", "n", "tokens", "own"])

    return docs.select("k", "text").mapInArrow(shared.tidy(rows), "k long, set1 long, set2 long, n int, tokens array<long>, own int")


class CountTree:
    """R-tree over points of group counts: packed by size, then by the widest coordinate; inner nodes keep coordinate
    maxima and the range of sizes. search() finds all points that a query's overlap bound cannot rule out."""

    def __init__(self, counts: np.ndarray, sizes: np.ndarray, threshold: Fraction):
        self.threshold = threshold
        order = np.argsort(sizes, kind="stable")
        slab = LEAF * max(1, int(np.sqrt(len(sizes) / LEAF)))
        wide = int(counts.astype(np.float64).var(axis=0).argmax()) if len(sizes) else 0
        order = np.concatenate([part[np.argsort(counts[part, wide], kind="stable")] for part in (order[i : i + slab] for i in range(0, len(order), slab))])
        self.order, self.counts, self.sizes = order, counts[order], sizes[order]
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        top, low, high = self.counts, self.sizes, self.sizes
        while len(top) > 1:
            cut = np.arange(0, len(top), LEAF)
            top, low, high = np.maximum.reduceat(top, cut), np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut)
            self.levels.append((top, low, high))

    def _open(self, q: np.ndarray, n: int, top: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which boxes may hold a partner, and by what bound: the overlap is at most the sum of coordinate minima, and at
        most either size."""
        best = np.minimum(np.minimum(top, q).sum(axis=1, dtype=np.int64), np.minimum(high, n))
        return best >= needed(n, low, self.threshold), best

    def search(self, q: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(points that may link, bounds of their overlaps)."""
        at = np.arange(len(self.levels[-1][0]) if self.levels else len(self.order))
        for depth in range(len(self.levels) - 1, -1, -1):
            top, low, high = self.levels[depth]
            at = at[self._open(q, n, top[at], low[at], high[at])[0]]
            at = (at[:, None] * LEAF + np.arange(LEAF)).ravel()
            at = at[at < (len(self.levels[depth - 1][0]) if depth else len(self.order))]
        fits, best = self._open(q, n, self.counts[at], self.sizes[at], self.sizes[at])
        return self.order[at[fits]], best[fits]


def group_counts(h: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(text * GROUPS + (mix(h) & U(GROUPS - 1)).astype(np.int64), minlength=n * GROUPS).reshape(n, GROUPS)


def packed(counts: np.ndarray) -> bytes:
    """A point as bytes, one for each group where that is enough."""
    return counts.astype(np.uint8 if counts.max(initial=0) < 1 << 8 else np.uint32).tobytes()


def points(column: list[bytes]) -> np.ndarray:
    if all(len(x) == GROUPS for x in column):
        return np.frombuffer(b"".join(column), dtype=np.uint8).reshape(-1, GROUPS)
    return np.array([np.frombuffer(x, dtype=np.uint8 if len(x) == GROUPS else np.uint32) for x in column], dtype=np.uint32).reshape(-1, GROUPS)


def whole_runs(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """(table, start of each run of equal keys and the end), every run whole; rows come sorted by key."""
    held: list[pa.RecordBatch] = []
    done = False
    batches = iter(batches)
    while not done:
        batch = next(batches, None)
        done = batch is None
        if batch is not None and batch.num_rows:
            held.append(batch)
            if sum(b.num_rows for b in held) < 4000:
                continue
        if not held:
            continue
        table = pa.Table.from_batches(held)
        cut = np.zeros(table.num_rows, dtype=bool)
        cut[0] = True
        for c in key:
            x = table.column(c).to_numpy()
            cut[1:] |= x[1:] != x[:-1]
        at = np.flatnonzero(cut)
        if done:
            yield table, np.append(at, table.num_rows)
        else:
            held = table.slice(at[-1]).to_batches()
            if len(at) > 1:
                yield table.slice(0, at[-1]), at


class Block:
    """Columns of the rows of many blocks."""

    def __init__(self, table: pa.Table, counts: np.ndarray | None = None):
        self.k, self.n, self.own, self.mine, self.group, self.i, self.j = (table.column(c).to_numpy() for c in ("k", "n", "own", "mine", "component", "i", "j"))
        self.points = counts

    def pairs(self, x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
        a, b = self.k[x], self.k[y]
        found = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1])], names=["a", "b"])

    def fit(self, x: np.ndarray, y: np.ndarray, threshold: Fraction) -> np.ndarray:
        """Which pairs of rows may link, by components, tiles, sizes and roles: the smaller set must meet its partner with
        its own part."""
        roles = np.where(self.n[y] < self.n[x], self.own[y], np.where(self.n[y] > self.n[x], self.own[x], self.own[x] | self.own[y]))
        tiles = (self.i[x] == self.j[x]) | (self.mine[x] != self.mine[y])
        return (self.group[x] != self.group[y]) & roles & tiles & (np.minimum(self.n[x], self.n[y]) >= needed(self.n[x].astype(np.int64), self.n[y], threshold))

    def small(self, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All pairs of rows of the same small block."""
        size = ends - starts
        row = gather(starts, size)
        after = np.repeat(ends, size) - row - 1
        return np.repeat(row, after), gather(row + 1, after)

    def large(self, a: int, b: int, threshold: Fraction, best: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of a large block that its R-tree cannot rule out, each from the side that is not in the largest component,
        in portions; with `best` the best one of each such row."""
        tree = CountTree(self.points[a:b], self.n[a:b].astype(np.int64), threshold)
        values, number = np.unique(self.group[a:b], return_counts=True)
        most = values[number.argmax()]
        one, two, held = [], [], 0
        for x in np.flatnonzero(self.group[a:b] != most):
            y, bound = tree.search(self.points[a + x], int(self.n[a + x]))
            other = self.fit(np.full(len(y), a + x), a + y, threshold)
            if best:
                y, bound = y[other], bound[other]
                y = y[[np.argmax(bound / needed(int(self.n[a + x]), self.n[a + y].astype(np.int64), threshold))]] if len(y) else y
            else:
                y = y[other & ((self.group[a + y] == most) | (y > x))]
            one.append(np.full(len(y), a + x))
            two.append(a + y)
            held += len(y)
            if held > PORTION:
                yield np.concatenate(one), np.concatenate(two)
                one, two, held = [], [], 0
        if held:
            yield np.concatenate(one), np.concatenate(two)


def small_pairs(blocks: DataFrame, threshold: Fraction) -> DataFrame:
    """(a, b) of different components and fitting sizes in small blocks; blocks: as for open_pairs, without counts."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, at in whole_runs(batches, ["token"]):
            block = Block(table)
            x, y = block.small(at[:-1], at[1:])
            keep = block.fit(x, y, threshold)
            yield block.pairs(x[keep], y[keep])

    return blocks.repartition(shared.partitions(blocks.sparkSession), "token").sortWithinPartitions("token").mapInArrow(shared.tidy(rows), "a long, b long").distinct()


def bounded(pairs: DataFrame, counted: DataFrame, threshold: Fraction) -> DataFrame:
    """The pairs (a, b) that summed coordinate minima cannot rule out."""
    one, two = (counted.select(F.col("k").alias(c), F.col("counts").alias(f"{c}_counts")) for c in ("a", "b"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p, q = (points(batch.column(c).to_pylist()) for c in ("a_counts", "b_counts"))
            most = np.minimum(p, q).sum(axis=1, dtype=np.int64)
            fits = most >= needed(p.sum(axis=1, dtype=np.int64), q.sum(axis=1, dtype=np.int64), threshold)
            yield batch.select(["a", "b"]).filter(pa.array(fits & (most > 0)))

    return pairs.join(one, "a").join(two, "b").select("a", "b", "a_counts", "b_counts").mapInArrow(shared.tidy(rows), "a long, b long")


def open_pairs(blocks: DataFrame, threshold: Fraction, best: bool) -> DataFrame:
    """(a, b) of different components that a block's bound cannot rule out; with `best`, of each document's partners in a
    block only the one with the best bound. blocks: (token, i, j, mine, k, n, own, component, counts), a tile (i, j) of a
    token's documents."""
    key = ["token", "i", "j"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, at in whole_runs(batches, key):
            block = Block(table, points(table.column("counts").to_pylist()))
            for a, b in zip(at[:-1], at[1:], strict=True):
                for x, y in block.large(a, b, threshold, best):
                    yield block.pairs(x, y)

    return blocks.repartition(shared.partitions(blocks.sparkSession), *key).sortWithinPartitions(*key).mapInArrow(shared.tidy(rows), "a long, b long").distinct()


def verified(pairs: DataFrame, texts: DataFrame, threshold: Fraction) -> DataFrame:
    """The pairs (a, b), a written table, whose sets link. Only texts of the pairs are dealt out; a hub's text travels once
    for each salt, next to the texts it is compared with."""
    texts = candidate_texts(texts, pairs.select(F.col("a").alias("k")).union(pairs.select("b")))
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(64)))
    others = salted.join(texts, salted.b == texts.k).select("a", "salt", F.lit(1).alias("kind"), F.col("b").alias("k"), "text")
    hubs = salted.select("a", "salt").distinct().join(texts, F.col("a") == texts.k).select("a", "salt", F.lit(0).alias("kind"), "k", "text")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, hub = None, np.zeros(0, np.uint64)
        for batch in batches:
            a, kind, k = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("a", "kind", "k"))
            buf, off = text_bytes(batch.column("text"))
            one, two = [], []
            for i, j in chunks(off):
                of, h = shingle_sets(buf, off[i : j + 1])
                for x in range(i, j):
                    own = h[of[x - i] : of[x - i + 1]]
                    if kind[x] == 0:
                        now, hub = a[x], own
                    elif now == a[x]:
                        both = len(hub) + len(own) - len(np.union1d(hub, own)) if len(own) and len(hub) else 0
                        if both and both >= needed(len(hub), len(own), threshold):
                            one.append(a[x]), two.append(k[x])
            if one:
                yield pa.RecordBatch.from_arrays([pa.array(np.array(one, np.int64)), pa.array(np.array(two, np.int64))], names=["a", "b"])

    return hubs.union(others).repartition(shared.partitions(pairs.sparkSession), "a", "salt").sortWithinPartitions("a", "salt", "kind").mapInArrow(shared.tidy(rows), "a long, b long")


def candidate_texts(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """(k, text) of the chosen keys, and of a few others that a filter of fixed size lets through; a key comes once for each
    task that has it."""
    bits = 1 << FILTER_BITS

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(bits // 8, dtype=np.uint8)
        for batch in batches:
            x = batch.column(0).to_numpy() & (bits - 1)
            np.bitwise_or.at(seen, x >> 3, (1 << (x & 7)).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array([seen.tobytes()])], names=["seen"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(bits // 8, dtype=np.uint8)
        for batch in batches:
            for x in batch.column(0):
                seen |= np.frombuffer(x.as_py(), dtype=np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([seen.tobytes()])], names=["seen"])

    seen = chosen.mapInArrow(shared.tidy(mark), "seen binary").repartition(4).mapInArrow(shared.tidy(join), "seen binary").coalesce(1).mapInArrow(shared.tidy(join), "seen binary").collect()
    sent = docs.sparkSession.sparkContext.broadcast(seen[0].seen if seen else bytes(bits // 8))

    def few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.frombuffer(sent.value, dtype=np.uint8)
        seen: set[int] = set()
        for batch in batches:
            k = batch.column(0).to_numpy()
            x = k & (bits - 1)
            keep = (flags[x >> 3] >> (x & 7)) & 1 == 1
            for i in np.flatnonzero(keep):
                if int(k[i]) in seen:
                    keep[i] = False
                seen.add(int(k[i]))
            yield batch.filter(pa.array(keep))

    return docs.select("k", "text").mapInArrow(shared.tidy(few), "k long, text string")


def _counted(texts: DataFrame) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = text_bytes(batch.column(1))
            for a, b in chunks(off):
                of, h = shingle_sets(buf, off[a : b + 1])
                c = group_counts(h, np.repeat(np.arange(b - a), np.diff(of)), b - a)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array([packed(x) for x in c], pa.binary())], names=["k", "counts"])

    return texts.mapInArrow(shared.tidy(rows), "k long, counts binary").groupBy("k").agg(F.first("counts").alias("counts"))


def linked(docs: DataFrame, threshold: Fraction = Fraction(4, 5), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row: the size of its shingle set and the smallest id it reaches by links.

    Rows link when the Jaccard similarity of their sets is at least the threshold, exactly (up to digests of 64 bits).
    Null texts and texts without words link with nothing. Rows that repeat an id are rows of their own, which may lie in
    different components; a row whose component has no other id than null has a null component_id. Other columns play no
    part.
    """
    # written first, as all aggregates here that are joined back by their key: Spark splits a hot key only in a join that
    # deals out both sides
    rows = shared.written(members(docs, threshold, id_col, text_col), "members")
    least = shared.written(rows.groupBy("root").agg(F.min("doc_id").alias("component_id")), "least")
    # rows without words have no links: each stands for itself even where such rows are equal
    return rows.join(least, "root").select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def members(docs: DataFrame, threshold: Fraction = Fraction(4, 5), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(k, doc_id, n_shingles, root) of every row: its shared.row_key, and a key that the rows of its component share."""
    own = keyed(docs, id_col, text_col)
    # equal rows share k, so that they are one node
    t = shared.written(prefixes(own, sketch(own), threshold), "prefixes")
    equal = shared.written(t.where("n > 0").groupBy("set1", "set2").agg(F.min("k").alias("a"), F.count("*").alias("c")).where("c > 1").drop("c"), "equal")
    edges = [equal.join(t.where("n > 0").select("set1", "set2", F.col("k").alias("b")), ["set1", "set2"]).where("a <> b").select("a", "b")]
    held = t.where(F.size("tokens") > 0).select("k", "n", "own", F.posexplode("tokens").alias("place", "token"))
    held = held.select("token", "k", "n", "place", (F.col("place") < F.col("own")).alias("own"))
    # how many, and how many with their own part, in one number
    both = held.groupBy("token").agg(F.sum(F.when(F.col("own"), F.lit((1 << 32) + 1)).otherwise(F.lit(1))).alias("s"))
    often = both.select("token", F.expr(f"s & {(1 << 32) - 1}").alias("c"), F.expr("shiftright(s, 32)").alias("own")).where("c > 1 and own > 0").select("token", "c")
    often = shared.written(often, "often")
    blocks = shared.written(held.join(often, "token"), "blocks")
    # the hub of a block: the document that has the shingle furthest in front, so with the fewest rarer ones before it
    hubs = shared.written(blocks.groupBy("token").agg(F.min(F.struct("place", "k", "n")).alias("hub")), "hubs")
    near = blocks.join(hubs, "token").where("k <> hub.k").where(F.least("n", "hub.n") >= needed_column(F.col("n"), F.col("hub.n"), threshold))
    stars = near.groupBy("k").agg(F.max(F.struct("c", -F.col("hub.place"), "hub.k")).alias("one"), F.min(F.struct("hub.place", "hub.k")).alias("two"))
    stars = stars.select(F.explode(F.array("one.k", "two.k")).alias("a"), F.col("k").alias("b")).distinct()
    stars = shared.written(stars, "stars")
    shared.discard(often, hubs)
    texts = shared.written(candidate_texts(own, blocks.select("k").distinct()), "texts")
    counted = shared.written(_counted(texts), "points")
    # merge joins here and below: the same plan at every size
    edges.append(verified(shared.written(bounded(stars, counted, threshold), "pairs").hint("merge"), texts, threshold))
    groups = components(_union(edges))
    tested = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    mixed = _mixed(blocks, groups)
    large = mixed.where(F.col("c") > SMALL)
    # in large blocks each document first meets its best partners in its most common and its rarest block
    ends = large.groupBy("k").agg(F.max(F.struct("c", "token")).alias("high"), F.min(F.struct("c", "token")).alias("low"))
    ends = ends.select("k", F.explode(F.array_distinct(F.array("high.token", "low.token"))).alias("token"))
    best = open_pairs(_comparable(_tiles(large.join(ends, ["k", "token"], "left_semi")), threshold).join(counted, "k"), threshold, True)
    little = bounded(small_pairs(_tiles(mixed.where(F.col("c") <= SMALL)), threshold).join(tested, ["a", "b"], "left_anti"), counted, threshold)
    pairs = shared.written(best.join(tested, ["a", "b"], "left_anti").union(little).distinct(), "pairs")
    groups = components(_union([groups.select("id", "component_id"), verified(pairs, texts, threshold)]))
    rest = open_pairs(_comparable(_tiles(_mixed(large.drop("component"), groups)), threshold).join(counted, "k"), threshold, False)
    pairs = shared.written(rest.join(tested.union(pairs), ["a", "b"], "left_anti"), "pairs")
    groups = components(_union([groups.select("id", "component_id"), verified(pairs, texts, threshold)]))
    nodes = t.join(groups.withColumnRenamed("id", "k"), "k", "left").select("k", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "k").alias("root")).distinct()
    return own.select("k", "doc_id").join(nodes, "k")


def _mixed(blocks: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows of blocks whose documents lie in different components, with these."""
    named = blocks.select("k", "token", "n", "own", "c").join(groups.withColumnRenamed("id", "k").hint("merge"), "k", "left").withColumn("component", F.coalesce("component_id", "k")).drop("component_id")
    named = shared.written(named, "named")
    mixed = shared.written(named.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("token"), "mixed")
    out = shared.written(named.join(mixed, "token", "left_semi"), "open")
    shared.discard(named, mixed)
    return out


def _tiles(blocks: DataFrame) -> DataFrame:
    """Rows (token, i, j, mine, k, n, own, component): large blocks in tiles, each row in all tiles of its part."""
    tiles = F.ceil(F.col("c") / TILE).cast("int")
    cut = blocks.withColumn("tiles", tiles).withColumn("mine", F.pmod(F.xxhash64("k"), F.col("tiles")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    return cut.select("token", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "k", "n", "own", "component")


def _comparable(tiles: DataFrame, threshold: Fraction) -> DataFrame:
    """Only rows that have a partner of another component and of a fitting size in their tile."""
    key = ["token", "i", "j"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, at in whole_runs(batches, key):
            n, group = table.column("n").to_numpy().astype(np.int64), table.column("component").to_numpy()
            run = np.repeat(np.arange(len(at) - 1), np.diff(at))
            # sizes lie within (t n, n / t); runs are sorted by size, so partners are neighbours
            place = run * (int(n.max()) * 4 + 4) + n * 1.0
            low = np.searchsorted(place, place - n + np.floor(n * float(threshold)), side="left")
            high = np.searchsorted(place, place - n + np.ceil(n / float(threshold)), side="right")
            change = np.concatenate([[0], np.cumsum(group[1:] != group[:-1])])
            yield from table.filter(pa.array(change[high - 1] > change[low])).to_batches()

    return tiles.repartition(shared.partitions(tiles.sparkSession), *key).sortWithinPartitions(*key, "n").mapInArrow(shared.tidy(rows), shared.ddl(tiles.schema))


def needed_column(a, b, threshold: Fraction):
    up, down = threshold.numerator, threshold.numerator + threshold.denominator
    return F.ceil((a + b) * up / down)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0].toDF("a", "b")
    for p in parts[1:]:
        out = out.union(p.toDF("a", "b"))
    return out
