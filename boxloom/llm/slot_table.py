"""Minimal perfect hash of digests, and prefix digests modulo a Mersenne prime.

Digests are pairs of numbers below 2**61 - 1, held as two uint64 arrays.
"""

from __future__ import annotations

import numpy as np

PRIME = (1 << 61) - 1
_P = np.uint64(PRIME)
_LOW31 = np.uint64((1 << 31) - 1)
_LOW30 = np.uint64((1 << 30) - 1)
_LOW32 = np.uint64((1 << 32) - 1)
_U30, _U31, _U32, _U61 = np.uint64(30), np.uint64(31), np.uint64(32), np.uint64(61)


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & _P) + (x >> _U61)
    return np.where(x >= _P, x - _P, x)


def times(a, b) -> np.ndarray:
    """Product modulo the prime."""
    a, b = np.asarray(a, np.uint64), np.asarray(b, np.uint64)
    a1, a0, b1, b0 = a >> _U31, a & _LOW31, b >> _U31, b & _LOW31
    middle = a1 * b0 + a0 * b1
    # 2**62 is 2 and 2**61 is 1 modulo the prime.
    high = np.uint64(2) * (a1 * b1) + (middle >> _U30) + ((middle & _LOW30) << _U31)
    return _reduced(_reduced(high) + _reduced(a0 * b0))


def plus(a, b) -> np.ndarray:
    return _reduced(np.asarray(a, np.uint64) + np.asarray(b, np.uint64))


def minus(a, b) -> np.ndarray:
    return _reduced(np.asarray(a, np.uint64) + (_P - np.asarray(b, np.uint64)))


def powers(base: int, exponents: np.ndarray) -> np.ndarray:
    """``base`` to each exponent, modulo the prime."""
    exponents = np.asarray(exponents, np.uint64)
    out, square = np.ones(len(exponents), np.uint64), base % PRIME
    for bit in range(int(exponents.max(initial=0)).bit_length()):
        chosen = (exponents >> np.uint64(bit)) & np.uint64(1) == 1
        out[chosen] = times(out[chosen], np.uint64(square))
        square = square * square % PRIME
    return out


def running(values: np.ndarray) -> np.ndarray:
    """Sums of all values up to each one, modulo the prime."""
    low = np.cumsum(values & _LOW32, dtype=np.uint64)
    high = np.cumsum(values >> _U32, dtype=np.uint64)
    return plus(_reduced(low), times(_reduced(high), np.uint64(1 << 32)))


def mixed(first: np.ndarray, second: np.ndarray, seed: int) -> np.ndarray:
    """64 well mixed bits of each pair."""
    x = first * np.uint64(0x9E3779B97F4A7C15) ^ (second + np.uint64(seed)) * np.uint64(0xC2B2AE3D27D4EB4F)
    for shift, odd in ((32, 0xD6E8FEB86659FD93), (29, 0xBF58476D1CE4E5B9)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(odd)
    return x ^ (x >> _U32)


class SlotTable:
    """Slots 0 to n - 1 of n distinct pairs, without gaps.

    Pairs that are alone at their place of a level's bits settle there, the others go to the next level; the slot is
    the rank of the set bit.  Every slot keeps its pair, so a lookup of an unknown pair is told apart (-1).
    """

    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.levels: list[tuple[np.ndarray, int]] = []
        left, base, slot = np.arange(len(first)), 0, np.empty(len(first), np.int64)
        while len(left):
            size = max(1, 2 * len(left))
            place = (mixed(first[left], second[left], len(self.levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(place, minlength=size) == 1
            ranks = np.where(alone, base + np.cumsum(alone) - 1, -1)
            self.levels.append((ranks, size))
            settled = alone[place]
            slot[left[settled]] = ranks[place[settled]]
            base += int(alone.sum())
            left = left[~settled]
        self.first, self.second = np.empty(len(first), np.uint64), np.empty(len(first), np.uint64)
        self.first[slot], self.second[slot] = first, second

    def __len__(self) -> int:
        return len(self.first)

    def find(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Slot of each pair, -1 for pairs that are not in the table."""
        slot, left = np.full(len(first), -1, np.int64), np.arange(len(first))
        for level, (ranks, size) in enumerate(self.levels):
            place = (mixed(first[left], second[left], level) % np.uint64(size)).astype(np.int64)
            found = ranks[place]
            slot[left[found >= 0]] = found[found >= 0]
            left = left[found < 0]
            if not len(left):
                break
        known = slot >= 0
        right = (self.first[slot[known]] == first[known]) & (self.second[slot[known]] == second[known])
        slot[np.flatnonzero(known)[~right]] = -1
        return slot
