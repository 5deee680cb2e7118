"""Token ids of whole texts through the distinct words of each batch.

Both public tokenizers used here never join characters across white space of one kind, so a text's ids are its units' ids in
order. A batch's distinct units are found by Arrow's dictionary encoding, only new ones are encoded, and the ids of every
text are gathered with numpy. The store of known units is bounded and starts anew when it is full.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import repeat

import numpy as np
import pyarrow as pa

from evispark.llm.textkit import gather

#: Units that a store keeps before it starts anew, about 100 MB.
KNOWN_UNITS = 400_000


class UnitStore:
    """Values (ids, or bytes) of units; encode(new units) gives all their values in one array and how many each has."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], most: int = KNOWN_UNITS):
        self.encode, self.most = encode, most
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.pool, self.used = np.zeros(1 << 16, dtype=np.uint32), 0
        self.start, self.length = np.zeros(1 << 14, dtype=np.int64), np.zeros(1 << 14, dtype=np.int64)

    @staticmethod
    def _room(a: np.ndarray, need: int) -> np.ndarray:
        return a if need <= len(a) else np.concatenate([a, np.zeros(max(need, 2 * len(a)) - len(a), dtype=a.dtype)])

    def look(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pool of values, start, number) for each row of a string array without nulls."""
        coded = units.dictionary_encode()
        words = coded.dictionary.to_pylist()
        at = np.fromiter(map(self.known.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        if (at < 0).any():
            if len(self.known) + int((at < 0).sum()) > self.most:
                self._clear()
                at[:] = -1
            new = np.flatnonzero(at < 0)
            own = [words[i] for i in new]
            values, lengths = self.encode(own)
            n, m = len(self.known), len(own)
            self.pool = self._room(self.pool, self.used + len(values))
            self.start, self.length = self._room(self.start, n + m), self._room(self.length, n + m)
            self.pool[self.used : self.used + len(values)] = values
            self.length[n : n + m] = lengths
            self.start[n : n + m] = self.used + np.cumsum(lengths) - lengths
            self.used += len(values)
            at[new] = np.arange(n, n + m)
            self.known.update(zip(own, range(n, n + m), strict=True))
        row = at[coded.indices.to_numpy(zero_copy_only=False)]
        return self.pool, self.start[row], self.length[row]


def spread(pool: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    return pool[gather(start, length)]


_kept: dict[tuple, object] = {}


def kept(key: tuple, make: Callable[[], object]) -> object:
    """What make() gives, once for each Python worker: later tasks of the worker find it again. One object per kind of key."""
    if key not in _kept:
        for old in [k for k in _kept if k[0] == key[0]]:
            del _kept[old]
        _kept[key] = make()
    return _kept[key]
