"""Signature trees over sets of token hashes, and their dual traversal.

A leaf is a set with a bitmap of its hashes; a node holds the OR of its children's bitmaps, the range of
their sizes, and the most hashes that share a bit inside one set. Two nodes are compared by the largest
overlap that any two sets below them can have; pairs of nodes that cannot reach the threshold, or whose
sets are all connected already, are not opened.
"""

from __future__ import annotations

import numpy as np

BITS = 4096
WORDS = BITS // 64
FAN_OUT = 8
FRONTIER = 4096  # node pairs that are compared at a time


class Links:
    """Which of n sets are connected, as a forest with the smallest number at each root."""

    def __init__(self, n: int) -> None:
        self.up = np.arange(n)

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return int(i)

    def connect(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)

    def roots(self) -> np.ndarray:
        while True:
            up = self.up[self.up]
            if np.array_equal(up, self.up):
                return up
            self.up = up


class Tree:
    """Levels of nodes, leaves first. `order` gives the set of each leaf: by size band, then least hash,
    so that sets alike share nodes."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        sizes = np.array([len(s) for s in sets], np.int64)
        least = np.array([s[0] if len(s) else 0 for s in sets], np.uint64)
        self.order = np.lexsort((sizes, least, np.floor(np.log(np.maximum(sizes, 1)) / np.log(4 / 3))))
        maps, bits = np.zeros((len(sets), WORDS), np.uint64), np.zeros(BITS, bool)
        for leaf, i in enumerate(self.order):
            at = (sets[i] % np.uint64(BITS)).astype(np.int64)
            bits[at] = True
            maps[leaf] = np.packbits(bits).view(np.uint64)
            bits[at] = False
        sizes = sizes[self.order]
        shared = sizes - np.bitwise_count(maps).sum(1).astype(np.int64)
        self.levels = [(maps, sizes, sizes, shared)]
        while len(self.levels[-1][0]) > 1:
            maps, low, high, shared = self.levels[-1]
            at = np.arange(0, len(maps), FAN_OUT)
            self.levels.append((
                np.bitwise_or.reduceat(maps, at), np.minimum.reduceat(low, at),
                np.maximum.reduceat(high, at), np.maximum.reduceat(shared, at),
            ))

    def uniform(self, level: int, roots: np.ndarray) -> np.ndarray:
        """Per node the root that all its sets have, or -1."""
        first = last = roots[self.order]
        for _ in range(level):
            at = np.arange(0, len(first), FAN_OUT)
            first, last = np.minimum.reduceat(first, at), np.maximum.reduceat(last, at)
        return np.where(first == last, first, -1)


def reachable(a: tuple, b: tuple, left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets below a pair of nodes can have 100 * overlap >= percent * union."""
    need = percent * (a[1][left] + b[1][right])  # of the smallest sets; overlap / union >= p means o * (1 + p) >= p * sum
    sizes = (100 * a[2][left] >= percent * b[1][right]) & (100 * b[2][right] >= percent * a[1][left])
    common = np.bitwise_count(a[0][left] & b[0][right]).sum(1).astype(np.int64)
    most = common + np.minimum(a[3][left], b[3][right])
    return sizes & ((100 + percent) * most >= need)


def alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """The exact check of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < percent * len(b):
        return False
    place = np.minimum(np.searchsorted(b, a), len(b) - 1)
    overlap = int((b[place] == a).sum()) if len(b) else 0
    return overlap > 0 and 100 * overlap >= percent * (len(a) + len(b) - overlap)


def link(
    left: Tree, right: Tree, left_sets: list[np.ndarray], right_sets: list[np.ndarray], shift: int, links: Links, percent: int
) -> None:
    """Dual traversal from both roots: connects all sets of the trees that links connect.

    Sets of the left tree have the numbers of their places, those of the right tree `shift` more; a tree
    against itself has shift 0. Node pairs wait on a stack and are opened level by level; a pair of
    leaves that may reach the threshold is checked exactly unless both are connected by then.
    """
    own = left is right
    roots = links.roots()
    stack = [(len(left.levels) - 1, len(right.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        up, across, a, b = stack.pop()
        if len(a) > FRONTIER:
            stack.append((up, across, a[FRONTIER:], b[FRONTIER:]))
            a, b = a[:FRONTIER], b[:FRONTIER]
        one = left.uniform(up, roots[: len(left.order)])[a]
        other = right.uniform(across, roots[shift : shift + len(right.order)])[b]
        open_ = (one < 0) | (one != other)
        a, b = a[open_], b[open_]
        if own and up == 0:
            apart = a != b
            a, b = a[apart], b[apart]
        kept = reachable(left.levels[up], right.levels[across], a, b, percent)
        if own and up:
            kept |= a == b
        a, b = a[kept], b[kept]
        if not len(a):
            continue
        if up == across == 0:
            for i, j in zip(left.order[a].tolist(), right.order[b].tolist()):
                if links.root(i) != links.root(j + shift) and alike(left_sets[i], right_sets[j], percent):
                    links.connect(i, j + shift)
            roots = links.roots()
            continue
        if up >= across:
            a, b = _children(a, b, len(left.levels[up - 1][0]))
            up -= 1
            if own:  # the right side follows, and only pairs in order are kept
                b, a = _children(b, a, len(right.levels[across - 1][0]))
                across -= 1
                ordered = a <= b
                a, b = a[ordered], b[ordered]
        else:
            b, a = _children(b, a, len(right.levels[across - 1][0]))
            across -= 1
        stack.append((up, across, a, b))


def _children(opened: np.ndarray, kept: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    children = (opened[:, None] * FAN_OUT + np.arange(FAN_OUT)).ravel()
    inside = children < n
    return children[inside], np.repeat(kept, FAN_OUT)[inside]
