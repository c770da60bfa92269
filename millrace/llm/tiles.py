"""Exact comparison of all rows of neighbouring cells, in tiles of a bounded number of rows.

Cells have a known, bounded number; their sizes are counted first. A large cell is cut into tiles,
and each pair of tiles that must meet is one group of at most two tiles' rows. Groups are dealt to
tasks by the pair and are read as a sorted stream.
"""

from __future__ import annotations

import numpy as np


class TilePlan:
    """Which tile a row falls into, and which pairs of tiles it takes part in."""

    def __init__(self, sizes: np.ndarray, rows: int):
        self.splits = -(-sizes.astype(np.int64) // rows)
        self.first = np.cumsum(self.splits) - self.splits
        self.total = int(self.splits.sum())

    def own(self, cells: np.ndarray, spread: np.ndarray) -> np.ndarray:
        """The tile of each row; `spread` is a hash that deals a cell's rows evenly."""
        within = spread % np.maximum(self.splits[cells], 1).astype(np.uint64)
        return self.first[cells] + within.astype(np.int64)

    def meetings(self, own: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For rows of the tiles `own` that meet `cells`: indexes of rows, and numbers of tile pairs."""
        times = self.splits[cells]
        row = np.repeat(np.arange(len(own)), times)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
        other = self.first[cells][row] + nth
        mine = own[row]
        return row, np.minimum(mine, other) * self.total + np.maximum(mine, other)

    def sides(self, pair: int, own: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
        """Row numbers of the two tiles of a pair; None for the second where it is the first."""
        a, b = divmod(pair, self.total)
        return np.flatnonzero(own == a), None if a == b else np.flatnonzero(own == b)


class Stars:
    """Links among the rows of one group, kept as a label per row: the first row of its star."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def add(self, left: np.ndarray, right: np.ndarray) -> None:
        while len(left):
            a, b = self.label[left], self.label[right]
            apart = a != b
            left, right, a, b = left[apart], right[apart], a[apart], b[apart]
            np.minimum.at(self.label, np.maximum(a, b), np.minimum(a, b))
            while (up := self.label[self.label] != self.label).any():
                self.label[up] = self.label[self.label[up]]

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """(row, root) for every row that is not its own root."""
        row = np.flatnonzero(self.label != np.arange(len(self.label)))
        return row, self.label[row]
