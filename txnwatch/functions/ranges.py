"""Counting points in rectangles without looking at each of them."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


class RankIndex:
    """A permutation of 0 ... n - 1, bit by bit: how many of the values at places [l, r) are below x, and which of them is
    the k-th smallest, for many questions at once and in as many steps as n has bits."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(max(len(values) - 1, 1)).bit_length())
        self.zeros: list[np.ndarray] = []
        values = np.asarray(values, np.int64)
        for b in range(self.bits - 1, -1, -1):
            low = (values >> b & 1) == 0
            self.zeros.append(np.concatenate([[0], np.cumsum(low)]))
            values = np.concatenate([values[low], values[~low]])

    def below(self, l: np.ndarray, r: np.ndarray, x: np.ndarray) -> np.ndarray:
        every, count = r - l, np.zeros(len(l), np.int64)
        for b, zeros in zip(range(self.bits - 1, -1, -1), self.zeros):
            l0, r0, one = zeros[l], zeros[r], (x >> b & 1) == 1
            count += np.where(one, r0 - l0, 0)
            l, r = np.where(one, zeros[-1] + l - l0, l0), np.where(one, zeros[-1] + r - r0, r0)
        return np.where(x >= 1 << self.bits, every, count)

    def smallest(self, l: np.ndarray, r: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Only for places that hold more than ``k`` values."""
        k, out = k.copy(), np.zeros(len(l), np.int64)
        for b, zeros in zip(range(self.bits - 1, -1, -1), self.zeros):
            l0, r0 = zeros[l], zeros[r]
            one = k >= r0 - l0
            k -= np.where(one, r0 - l0, 0)
            out |= one.astype(np.int64) << b
            l, r = np.where(one, zeros[-1] + l - l0, l0), np.where(one, zeros[-1] + r - r0, r0)
        return out


def first_true(n: int, test: Callable[[np.ndarray], np.ndarray], questions: int) -> np.ndarray:
    """For each question the first of ``n`` places where ``test(places)`` holds, n if none; tests are false, then true."""
    lo, hi = np.zeros(questions, np.int64), np.full(questions, n, np.int64)
    while (open_ := lo < hi).any():
        middle = (lo + hi) // 2
        yes = test(np.minimum(middle, n - 1))
        lo, hi = np.where(open_ & ~yes, middle + 1, lo), np.where(open_ & yes, middle, hi)
    return lo


def count_and_first(at: np.ndarray, order: np.ndarray, start: np.ndarray, stop: np.ndarray, low: np.ndarray, high: np.ndarray):
    """Points have ascending times ``at`` and, by ``order``, an order of sizes. For every question: how many points lie within
    times [start, stop) and places [low, high) of that order, and the first of them (-1 if none)."""
    index = RankIndex(order)
    a, b = np.searchsorted(at, start), np.searchsorted(at, stop)
    high, b = np.maximum(high, low), np.maximum(a, b)
    before = index.below(low, high, a)
    n = index.below(low, high, b) - before
    return n, np.where(n > 0, index.smallest(low, high, np.where(n > 0, before, 0)), -1)
