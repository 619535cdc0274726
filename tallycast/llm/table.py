"""A hash table from 64-bit keys to numbers that looks up and adds whole arrays."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

SCATTER = np.uint64(0x9E3779B97F4A7C15)


class Table:
    """Open addressing; ``room`` slots at first, and more as soon as over half would be used."""

    def __init__(self, room: int) -> None:
        self.used = 0
        self._clear(room)

    def _clear(self, room: int) -> None:
        bits = max(int(room - 1).bit_length(), 4)
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.zeros(1 << bits, np.uint64)  # one more than the key: 0 marks an empty slot
        self.values = np.full(1 << bits, -1, np.int64)

    @classmethod
    def of(cls, keys: Iterable[int] | np.ndarray, values: Iterable[int] | np.ndarray) -> Table:
        keys = np.array(keys if isinstance(keys, np.ndarray) else list(keys), np.uint64)
        table = cls(4 * len(keys) + 16)
        table.put(keys, np.array(values if isinstance(values, np.ndarray) else list(values), np.int64))
        return table

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * SCATTER) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, -1 if it isn't there."""
        keys = keys + np.uint64(1)
        slots = self._slots(keys)
        held = self.keys[slots]
        out = self.values[slots]
        at = np.flatnonzero(held != keys)
        out[at] = -1
        at = at[held[at] != 0]
        slots = slots[at]
        while len(at):
            slots = slots + 1 & self.mask
            held = self.keys[slots]
            same = held == keys[at]
            out[at[same]] = self.values[slots[same]]
            go = ~same & (held != 0)
            at, slots = at[go], slots[go]
        return out

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Add keys, each given once and not there yet."""
        self.used += len(keys)
        if 2 * self.used > len(self.keys):
            held = np.flatnonzero(self.keys)
            keys = np.concatenate([self.keys[held] - np.uint64(1), keys])
            values = np.concatenate([self.values[held], values])
            self._clear(4 * self.used)
        keys = keys + np.uint64(1)
        slots = self._slots(keys)
        while len(keys):
            empty = self.keys[slots] == 0
            self.keys[slots[empty]] = keys[empty]
            won = empty & (self.keys[slots] == keys)
            self.values[slots[won]] = values[won]
            keys, values, slots = keys[~won], values[~won], slots[~won] + 1 & self.mask
