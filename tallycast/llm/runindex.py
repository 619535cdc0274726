"""A run-length index of a small collection of byte strings: where each place's longest match lies.

The Burrows-Wheeler transform of the collection is cut into runs of equal symbols. In the order of suffixes, the neighbour before a
place's suffix moves along with the place, except where a run begins; so the neighbour and the length of the match are kept for
the places at run borders alone, and any other place reads its own off the next kept place. In a repetitive collection there
are far fewer runs than places.
"""

from __future__ import annotations

import numpy as np


class RunIndex:
    """Index of strings that lie one after the other in ``data``; matches end with their string."""

    def __init__(self, data: np.ndarray, lengths: np.ndarray) -> None:
        ends = np.cumsum(lengths)
        self.starts = ends - lengths + np.arange(len(lengths))
        size = len(data) + len(lengths)
        closing = ends + np.arange(len(lengths))
        symbols = np.empty(size, np.int64)
        inside = np.ones(size, bool)
        inside[closing] = False
        symbols[inside] = data.astype(np.int64) + len(lengths)
        symbols[closing] = np.arange(len(lengths))  # each string's end is a symbol of its own
        self.size = size
        self.until = np.repeat(closing, lengths + 1)  # each place's end
        order = self._sorted(symbols, len(lengths) + 256)
        self._sample(symbols, order)

    def _sorted(self, symbols: np.ndarray, kinds: int) -> np.ndarray:
        """Suffixes in order, by doubling the compared length; keeps each round's ranks to measure matches."""
        bits = int(kinds).bit_length()
        first = max(1, min(4, 62 // bits))
        key = np.zeros(self.size, np.int64)
        for j in range(first):
            key = key << bits
            key[: self.size - j] += symbols[j:] + 1
        self.levels: list[tuple[int, np.ndarray]] = [(1, symbols)]
        length = first
        while True:
            order = np.argsort(key, kind="stable")
            ordered = key[order]
            new = np.empty(self.size, bool)
            new[0] = True
            new[1:] = ordered[1:] != ordered[:-1]
            rank = np.empty(self.size, np.int64)
            rank[order] = np.cumsum(new)
            if new.all():
                self.rank = rank - 1
                return order
            self.levels.append((length, rank))
            key = rank * (self.size + 1)
            key[: self.size - length] += rank[length:]
            length *= 2

    def _match(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How long the suffixes at ``a`` and ``b`` are equal."""
        out = np.zeros(len(a), np.int64)
        for length, rank in reversed(self.levels):
            again = True
            while again:
                x, y = a + out, b + out
                inside = (x + length <= self.size) & (y + length <= self.size)
                same = np.zeros(len(a), bool)
                same[inside] = rank[x[inside]] == rank[y[inside]]
                out += same * length
                again = length == 1 and bool(same.any())
        return out

    def _sample(self, symbols: np.ndarray, order: np.ndarray) -> None:
        before = np.where(order > 0, symbols[order - 1], -1)
        heads = np.ones(self.size, bool)
        heads[1:] = before[1:] != before[:-1]
        self.runs = int(heads.sum())
        at = np.unique(np.append(order[heads] - 1, self.size - 1))
        self.kept = at[at >= 0]
        row = self.rank[self.kept]
        self.neighbour = np.where(row > 0, order[row - 1], -1)
        self.length = np.zeros(len(row), np.int64)
        real = row > 0
        self.length[real] = self._match(self.kept[real], self.neighbour[real])
        self.levels = []

    def matches(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each place the neighbour before its suffix and the length of their match."""
        next_kept = np.searchsorted(self.kept, places)
        ahead = self.kept[next_kept] - places
        return self.neighbour[next_kept] - ahead, self.length[next_kept] + ahead

    def repeated(self, length: int) -> np.ndarray:
        """Places whose next ``length`` bytes also stand at an earlier place, in the order of the collection."""
        places = np.arange(self.size)
        places = places[places + length <= self.until]
        neighbour, matched = self.matches(places)
        link = np.arange(self.size)
        long = matched >= length
        link[places[long]] = neighbour[long]
        while True:  # follow the neighbours to the first one in suffix order
            further = link[link]
            if (further == link).all():
                break
            link = further
        least = np.arange(self.size)
        np.minimum.at(least, link[places], places)
        return places[least[link[places]] < places]
