"""Vectorised words, digests and minimisers over the UTF-8 bytes of whole texts (numpy, no Python loop over words).

Digests are polynomial hashes modulo 2**64 over random byte (or word) values, finished by a bijective mixer, so that the
digest of any run of words comes from two prefix sums.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
#: White space that ends a word: space and 0x09 to 0x0D.
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
BYTE_VALUES = np.random.default_rng(20240607).integers(1, 2**63, size=256, dtype=np.uint64) * U(2) + U(1)
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F)
CHUNK_BYTES = 1 << 18

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd base and of its inverse modulo 2**64; kept and grown as needed."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        n = max(n, 1 << 16)
        up, down = np.full(n, base, dtype=np.uint64), np.full(n, pow(base, -1, 2**64), dtype=np.uint64)
        up[0] = down[0] = 1
        have = _powers[base] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every input bit reaches every output bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def prefix(values: np.ndarray, base: int) -> np.ndarray:
    """Prefix sums from which digest() reads any run."""
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers(base, len(values) + 1)[0][: len(values)], out=out[1:])
    return out


def digest(sums: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """64-bit digest of values[start:end] for arrays of bounds; the length counts too."""
    down = powers(base, len(sums))[1]
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64) * U(0x2545F4914F6CDD1D))


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and each row's bounds in them; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    off = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), off


def chunks(off: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about `most` bytes; a longer text is a range of its own."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + most, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


class Words:
    """Words of consecutive texts: byte bounds of each and the first word of each text (with the total at the end).

    `breaks` says of each byte value (of lowered texts, where `lower`) whether it parts words."""

    def __init__(self, buf: np.ndarray, off: np.ndarray, lower: bool = False, breaks: np.ndarray = IS_SPACE):
        self.base = int(off[0])
        b = buf[self.base : int(off[-1])]
        self.bytes = LOWER[b] if lower else b
        at = (off - off[0]).astype(np.int64)
        solid = ~breaks[self.bytes]
        edge = np.zeros(len(b) + 1, dtype=bool)
        edge[at] = True
        first, last = solid.copy(), solid.copy()
        first[1:] &= ~solid[:-1] | edge[1:-1] if len(b) else False
        last[:-1] &= ~solid[1:] | edge[1:-1] if len(b) else False
        self.start, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.of = np.searchsorted(self.start, at)  # first word of each text
        self.text_at = at

    def hashes(self) -> np.ndarray:
        return digest(prefix(BYTE_VALUES[self.bytes], BASES[0]), self.start, self.end, BASES[0])

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.of) - 1), np.diff(self.of))


def runs(values: np.ndarray) -> np.ndarray:
    """Start of every run of equal neighbours, and the length at the end."""
    if not len(values):
        return np.zeros(1, dtype=np.int64)
    return np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1, [len(values)]])


def leftmost_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """For each start of a window of `width` values, the place of its smallest value (of equals the leftmost), by doubling."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    at, have = np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        a, b = at[: len(at) - step], at[step:]
        at = np.where(values[b] < values[a], b, a)
        have += step
    return at[:n]


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places start, start + 1, ... of every run, run after run."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    keep = lengths > 0
    starts, lengths = starts[keep], lengths[keep]
    step = np.ones(total, dtype=np.int64)
    step[0] = starts[0]
    ends = np.cumsum(lengths)
    step[ends[:-1]] = starts[1:] - (starts[:-1] + lengths[:-1] - 1)
    return np.cumsum(step)
