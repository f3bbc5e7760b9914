"""What the byte-pair operators share: a hashed table of pairs, and results kept by chunk."""

from __future__ import annotations

from collections.abc import Callable, Hashable
from itertools import islice

import numpy as np

from slicecheck.llm.common import gather, starts_of

NONE = np.int64(1) << 62
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """From a pair of ids to an index, by open addressing in numpy arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray):
        keys = self._keys(left, right)
        self.bits = max(4, int(2 * len(keys) - 1).bit_length() + 1)
        self.slots = np.full(1 << self.bits, _EMPTY, np.uint64)
        self.index = np.zeros(1 << self.bits, np.int64)
        todo, at = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            free = self.slots[at] == _EMPTY
            slots, first = np.unique(at[free], return_index=True)
            placed = np.flatnonzero(free)[first]
            self.slots[slots] = keys[todo[placed]]
            self.index[slots] = todo[placed]
            rest = np.ones(len(todo), bool)
            rest[placed] = False
            todo, at = todo[rest], at[rest]
            taken = self.slots[at] != _EMPTY
            at = np.where(taken, (at + 1) & (len(self.slots) - 1), at)

    @staticmethod
    def _keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _FACTOR) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Index of each pair, or ``NONE``."""
        keys = self._keys(left, right)
        at = self._slot(keys)
        seen = self.slots[at]
        out = np.where(seen == keys, self.index[at], NONE)
        todo = np.flatnonzero((seen != keys) & (seen != _EMPTY))
        while len(todo):
            at[todo] = (at[todo] + 1) & (len(self.slots) - 1)
            seen = self.slots[at[todo]]
            hit = seen == keys[todo]
            out[todo[hit]] = self.index[at[todo[hit]]]
            todo = todo[~hit & (seen != _EMPTY)]
        return out


class _Numbers(dict):
    """Gives a key that is new the next number."""

    def __missing__(self, key: Hashable) -> int:
        number = self[key] = len(self)
        return number


class Chunks:
    """Ids of the chunks seen so far, as ragged rows. A chunk is encoded once; after
    ``limit`` chunks the rows are dropped, so memory is bounded and results stay the same.
    """

    def __init__(
        self,
        encode: Callable[[list], tuple[np.ndarray, np.ndarray]],
        limit: int = 600_000,
    ):
        self.encode, self.limit = encode, limit
        self._clear()

    def _clear(self) -> None:
        self.number = _Numbers()
        self.flat = np.zeros(0, np.int64)
        self.starts = np.zeros(1, np.int64)

    def numbers(self, chunks: list) -> np.ndarray:
        """Row number of each chunk."""
        if len(self.number) > self.limit:
            self._clear()
        known = len(self.number)
        numbers = np.fromiter(map(self.number.__getitem__, chunks), np.int64, len(chunks))
        new = list(islice(self.number, known, None))
        if new:
            flat, lengths = self.encode(new)
            self.flat = np.concatenate([self.flat, flat])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(lengths)])
        return numbers

    def lengths(self, numbers: np.ndarray) -> np.ndarray:
        return self.starts[numbers + 1] - self.starts[numbers]

    def ids(self, rows: list[list]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of rows of chunks, one row after the other, and the rows' offsets."""
        numbers = self.numbers([c for row in rows for c in row])
        return self.ids_of(numbers, np.array([len(r) for r in rows], np.int64))

    def ids_of(self, numbers: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for chunks by number; ``sizes`` has how many each row has."""
        flat, starts = gather(self.flat, self.starts, numbers)
        return flat, starts[starts_of(sizes)]

