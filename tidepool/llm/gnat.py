"""Nearest entries by a geometric near-neighbour access tree.

A node has a few split points and one child per split point with the entries that are nearest to it. For each pair (split point, child)
it stores the least and greatest distance between the split point and the child's entries. A query at distance d from a split point
is at least ``d - greatest`` and ``least - d`` away from everything in the child; a child for which any split point says
more than the best distance so far goes as a whole.

Distances are kept squared, as whole numbers. A bound is taken from square roots, each rounded against elimination, and
must exceed the best distance strictly; so entries that tie with the best are always reached, and ties are told by whole numbers:
the lower index wins.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

FAN = 12
LEAF = 24
#: Relative slack of a square root and of a difference of two, many times a double's rounding.
SLACK = 1e-14
_EXACT = 1 << 53


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances (len(a), len(b)) of rows of whole numbers.

    A product of doubles is exact while every partial sum stays below 2^53; larger components are
    subtracted as 64-bit integers, in stretches of bounded size.
    """
    if not len(a) or not len(b) or not a.shape[1]:
        return np.zeros((len(a), len(b)), np.int64)
    top = max(int(np.abs(a).max()), int(np.abs(b).max()))
    if 4 * a.shape[1] * top * top < _EXACT:
        x, y = a.astype(np.float64), b.astype(np.float64)
        out = x @ y.T
        out *= -2
        out += np.einsum("ij,ij->i", x, x)[:, None]
        out += np.einsum("ij,ij->i", y, y)[None, :]
        return out.astype(np.int64)
    out = np.empty((len(a), len(b)), np.int64)
    step = max(1, (1 << 22) // max(1, b.size))
    for k in range(0, len(a), step):
        gap = a[k:k + step, None, :] - b[None, :, :]
        out[k:k + step] = (gap * gap).sum(axis=2)
    return out


@dataclass
class Node:
    splits: np.ndarray            # entry numbers of the split points
    children: list                # a Node, an array of entry numbers (a leaf), or None
    least: np.ndarray             # (split, child), rounded down
    greatest: np.ndarray          # rounded up


class Gnat:
    """The tree over the rows of ``entries`` (whole numbers, bounded in number: a codebook)."""

    def __init__(self, entries: np.ndarray, fan: int = FAN, leaf: int = LEAF):
        self.entries, self.fan, self.leaf = np.ascontiguousarray(entries, np.int64), fan, leaf
        self.root = self._build(np.arange(len(entries)))

    def _build(self, rows: np.ndarray):
        if len(rows) <= max(self.leaf, self.fan):
            return rows
        # Split points far from each other: each one is the entry farthest from those before.
        chosen, near = [0], squared(self.entries[rows], self.entries[rows[:1]])[:, 0]
        while len(chosen) < self.fan and near.max() > 0:
            chosen.append(int(near.argmax()))
            near = np.minimum(near, squared(self.entries[rows], self.entries[rows[chosen[-1:]]])[:, 0])
        if len(chosen) == 1:  # all entries are alike: the first one wins every tie
            return rows[:1]
        splits = rows[chosen]
        far = squared(self.entries[rows], self.entries[splits])
        owner = far.argmin(axis=1)
        rest = np.ones(len(rows), bool)
        rest[chosen] = False
        size = len(splits)
        children, least, greatest = [], np.full((size, size), np.inf), np.full((size, size), -np.inf)
        for j in range(size):
            mine = np.flatnonzero(rest & (owner == j))
            if len(mine):
                least[:, j] = np.sqrt(far[mine].min(axis=0)) * (1 - SLACK)
                greatest[:, j] = np.sqrt(far[mine].max(axis=0)) * (1 + SLACK)
            children.append(self._build(rows[mine]) if len(mine) else None)
        return Node(splits, children, least, greatest)

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) for each row; ties go to the lower entry."""
        best = np.full(len(queries), np.iinfo(np.int64).max)
        at = np.full(len(queries), len(self.entries))
        self._visit(self.root, queries, np.arange(len(queries)), best, at)
        return at, best

    def _offer(self, far: np.ndarray, entries: np.ndarray, rows: np.ndarray, best: np.ndarray, at: np.ndarray) -> None:
        low = far.min(axis=1)
        # The lowest entry of those at the least distance, whatever their order here.
        first = np.where(far == low[:, None], entries[None, :], len(self.entries)).min(axis=1)
        better = (low < best[rows]) | ((low == best[rows]) & (first < at[rows]))
        best[rows[better]], at[rows[better]] = low[better], first[better]

    def _visit(self, node, queries: np.ndarray, rows: np.ndarray, best: np.ndarray, at: np.ndarray) -> None:
        if not len(rows):
            return
        if isinstance(node, np.ndarray):
            self._offer(squared(queries[rows], self.entries[node]), node, rows, best, at)
            return
        far = squared(queries[rows], self.entries[node.splits])
        self._offer(far, node.splits, rows, best, at)
        closest, root = far.argmin(axis=1), np.sqrt(far)
        low, high = root * (1 - SLACK), root * (1 + SLACK)
        # First every query's own child, which leaves a small best distance; then the others, as far as they are not eliminated.
        for j, child in enumerate(node.children):
            if child is not None:
                self._visit(child, queries, rows[closest == j], best, at)
        for j, child in enumerate(node.children):
            if child is None:
                continue
            other = np.flatnonzero(closest != j)
            bound = np.maximum(low[other] - node.greatest[:, j], node.least[:, j] - high[other]).max(axis=1)
            open_ = bound * (1 - SLACK) <= np.sqrt(best[rows[other]]) * (1 + SLACK)
            self._visit(child, queries, rows[other[open_]], best, at)
