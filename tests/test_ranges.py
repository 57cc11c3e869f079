"""Counts in rectangles against looking at every point."""

import numpy as np
from hypothesis import given, settings, strategies as st

from txnwatch.functions.ranges import RankIndex, count_and_first, first_true


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 40), st.integers(0, 10**6))
def test_rank_index(n, seed):
    rng = np.random.default_rng(seed)
    values = rng.permutation(n)
    index = RankIndex(values)
    l = rng.integers(0, n + 1, 30)
    r = np.maximum(l, rng.integers(0, n + 1, 30))
    x = rng.integers(0, n + 1, 30)
    assert index.below(l, r, x).tolist() == [int((values[a:b] < c).sum()) for a, b, c in zip(l, r, x)]
    held = r > l
    k = np.array([rng.integers(0, b - a) for a, b in zip(l[held], r[held])], np.int64)
    assert index.smallest(l[held], r[held], k).tolist() == [int(np.sort(values[a:b])[c]) for a, b, c in zip(l[held], r[held], k)]


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 60), st.integers(0, 10**6))
def test_count_and_first(n, seed):
    rng = np.random.default_rng(seed)
    at, size = np.sort(rng.integers(0, 20, n)), rng.integers(0, 10, n)
    order = np.argsort(size, kind="stable")
    start, low = rng.integers(-2, 22, 25), rng.integers(0, n + 1, 25)
    stop, high = start + rng.integers(-1, 15, 25), rng.integers(0, n + 1, 25)
    rank = np.empty(n, int)
    rank[order] = np.arange(n)
    inside = (at >= start[:, None]) & (at < stop[:, None]) & (rank >= low[:, None]) & (rank < high[:, None])
    count, first = count_and_first(at, order, start, stop, low, high)
    assert count.tolist() == inside.sum(1).tolist()
    assert first.tolist() == [int(np.flatnonzero(i)[0]) if i.any() else -1 for i in inside]


def test_first_true():
    steps = np.array([1, 3, 3, 8])
    asked = np.array([0, 3, 4, 9])
    assert first_true(4, lambda k: steps[k] >= asked, 4).tolist() == [0, 1, 3, 4]
