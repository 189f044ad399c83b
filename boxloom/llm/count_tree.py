"""Rows of one shared shingle, searched through an R-tree of their group counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

GROUPS = 64
#: Counts stop here; a row that reaches it is not bounded by its counts.
FULL = 255
LEAF = 32
FAN = 16


class CountTree:
    """Points are count vectors; boxes hold the largest count of each group and the range of set sizes.

    The overlap of two sets is at most the sum of the smaller counts of each group, and for two boxes at most the sum
    of the smaller maxima.
    """

    def __init__(
        self,
        sizes: np.ndarray,
        counts: np.ndarray,
        percent: int,
        parts: np.ndarray | None = None,
        rests: np.ndarray | None = None,
        bits: np.ndarray | None = None,
        sides: np.ndarray | None = None,
    ):
        """Rows of one part, or of one side, make no pair.

        ``rests`` are the shingles of a row from the shared one on, in the common order: where it is the first that two
        rows share, they share no more than the smaller rest.  ``bits`` are parities of hash groups, as 64-bit numbers;
        each that differs is a shingle that one row has alone.
        """
        self.sizes, self.counts, self.percent = sizes.astype(np.int64), counts, percent
        self.full = (counts == FULL).any(axis=1)
        self.parts, self.rests, self.bits, self.sides = parts, rests, bits, sides

    def _build(self) -> None:
        sizes, counts, parts = self.sizes, self.counts, self.parts
        spread = counts[:, int(np.argmax(counts.astype(np.float32).var(axis=0)))]
        slab = np.zeros(len(sizes), dtype=np.int64)
        by_size = np.lexsort([sizes, *(x for x in (parts, self.sides) if x is not None)])
        slab[by_size] = np.arange(len(sizes)) // (LEAF * FAN)
        self.order = np.lexsort((spread, slab))
        self.leaves = self._boxes(LEAF)
        self.nodes = self._boxes(LEAF * FAN)

    def _boxes(self, width: int):
        at = np.arange(0, len(self.order), width)
        own = self.order
        top = np.maximum.reduceat(self.counts[own], at).astype(np.int32)
        top[np.logical_or.reduceat(self.full[own], at)] = 1 << 24
        least, most = np.minimum.reduceat(self.sizes[own], at), np.maximum.reduceat(self.sizes[own], at)
        apart = [(np.minimum.reduceat(x[own], at), np.maximum.reduceat(x[own], at)) for x in (self.parts, self.sides) if x is not None]
        return top, least, most, apart

    def near(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Whether pairs of points may reach the similarity."""
        a, b, p = self.sizes[one], self.sizes[two], self.percent
        fit = 100 * np.minimum(a, b) >= p * np.maximum(a, b)
        for apart in (self.parts, self.sides):
            if apart is not None:
                fit &= apart[one] != apart[two]
        if self.rests is not None:
            fit &= (100 + p) * np.minimum(self.rests[one], self.rests[two]) >= p * (a + b)
        at = np.flatnonzero(fit)
        i, j = one[at], two[at]
        bound = np.minimum(self.counts[i], self.counts[j]).sum(axis=1, dtype=np.int64)
        good = (100 + p) * bound >= p * (self.sizes[i] + self.sizes[j])
        fit[at] = good | self.full[i] | self.full[j]
        if self.bits is not None:
            at = np.flatnonzero(fit)
            i, j = one[at], two[at]
            total = self.sizes[i] + self.sizes[j]
            alone = np.bitwise_count(self.bits[i] ^ self.bits[j]).sum(axis=1, dtype=np.int64)
            fit[at] = (100 + p) * (total - alone) >= 2 * p * total
        return fit

    def _may_meet(self, boxes, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        top, least, most, apart = boxes
        p = self.percent
        fit = (100 * most[one] >= p * least[two]) & (100 * most[two] >= p * least[one])
        for low, high in apart:
            fit &= ~((low[one] == high[one]) & (low[two] == high[two]) & (low[one] == low[two]))
        at = np.flatnonzero(fit)
        bound = np.minimum(top[one[at]], top[two[at]]).sum(axis=1, dtype=np.int64)
        fit[at] = (100 + p) * bound >= p * (least[one[at]] + least[two[at]])
        return fit

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of points that may reach the similarity, in portions."""
        self._build()
        n_nodes, n_leaves, n = len(self.nodes[1]), len(self.leaves[1]), len(self.order)
        for node in range(n_nodes):
            others = np.arange(node, n_nodes)
            others = others[self._may_meet(self.nodes, np.full(len(others), node), others)]
            for other in others.tolist():
                one = np.arange(node * FAN, min((node + 1) * FAN, n_leaves))
                two = np.arange(other * FAN, min((other + 1) * FAN, n_leaves))
                a, b = (x.ravel() for x in np.meshgrid(one, two, indexing="ij"))
                keep = a <= b
                a, b = a[keep], b[keep]
                keep = self._may_meet(self.leaves, a, b)
                for x, y in zip(a[keep].tolist(), b[keep].tolist(), strict=True):
                    i = np.arange(x * LEAF, min((x + 1) * LEAF, n))
                    j = np.arange(y * LEAF, min((y + 1) * LEAF, n))
                    i, j = (z.ravel() for z in np.meshgrid(i, j, indexing="ij"))
                    if x == y:
                        keep_points = i < j
                        i, j = i[keep_points], j[keep_points]
                    i, j = self.order[i], self.order[j]
                    good = self.near(i, j)
                    if good.any():
                        yield i[good], j[good]

    def stars(self, leaders: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Some of the pairs: each leader, the point nearest the middle of what is left, with its near points."""
        left = np.arange(len(self.sizes))
        for _ in range(leaders):
            if len(left) < 2:
                return
            middle = np.median(self.counts[left], axis=0)
            leader = left[int(np.abs(self.counts[left] - middle).sum(axis=1).argmin())]
            others = left[left != leader]
            near = self.near(np.full(len(others), leader), others)
            if near.any():
                yield np.full(int(near.sum()), leader), others[near]
            left = others[~near]


def small_groups(starts: np.ndarray, sizes: np.ndarray, tree: CountTree) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs inside many small groups of neighbouring rows at once."""
    last = np.repeat(starts + sizes, sizes)
    rows = np.repeat(starts, sizes) + (np.arange(len(last)) - np.repeat(np.cumsum(sizes) - sizes, sizes))
    for step in range(1, int(sizes.max()) if len(sizes) else 0):
        one = rows[rows + step < last]
        good = tree.near(one, one + step)
        if good.any():
            yield one[good], one[good] + step
