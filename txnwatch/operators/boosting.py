"""Boosted trees for a yes-or-no label, fitted as Spark jobs, and walking trees over many rows at once.

The trees are those of Spark ML's ``GBTClassifier``: logistic loss, regression trees by variance, at most 32 bins an input
with bounds from a sample of the values, the first tree with weight one. What differs is how a row is kept: one byte per
input, the bin it falls in, its label and its margin so far. Each level of each tree is a pass over these blocks; a task
gives out one histogram (inputs * bins * open nodes, whatever the number of rows) and the driver picks the splits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch_path

BINS, SAMPLE, EPSILON = 32, 10_000, 2.0 ** -52
BLOCK = 1 << 15  # rows, so that a block's work stays in a core's cache
KEEP = 4  # margins are stored after so many trees; the trees since then are walked again in each pass
RESTART = 20  # after so many trees margins start again from the stored rows, so lineage stays short
TREE_SCHEMA = "tree int, node int, feature int, threshold double, value double, weight double"


# ---- walking -------------------------------------------------------------------------------------------


def padded(feature: np.ndarray, threshold: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trees (one a row, children of i at 2i+1 and 2i+2, leaves with feature -1) with all leaves on the last level: what
    ends above goes left all the way down and finds its value on both sides."""
    height = max(1, int(feature.shape[1]).bit_length() - 1)
    nodes = (2 << height) - 1
    grown = [np.full((len(feature), nodes), fill, kind) for fill, kind in ((-1, np.int64), (np.inf, float), (0.0, float))]
    for full, given in zip(grown, (feature, threshold, value)):
        full[:, :given.shape[1]] = given
    feature, threshold, value = grown
    for node in range((1 << height) - 1):
        ends = feature[:, node] < 0
        feature[ends, node], threshold[ends, node] = 0, np.inf
        for child in (2 * node + 1, 2 * node + 2):
            feature[ends, child], value[ends, child] = -1, value[ends, node]
    return feature, threshold, value


def tree_sums(points: np.ndarray, trees: tuple[np.ndarray, np.ndarray, np.ndarray], weights: np.ndarray | None = None,
              chunk: int = 4096) -> np.ndarray:
    """Sum of the trees' values, times their weights, for each row of ``points``; ``trees`` are padded."""
    feature, threshold, value = trees
    height = feature.shape[1].bit_length() - 1
    out = np.zeros(len(points))
    for lo in range(0, len(points), chunk):
        part = np.ascontiguousarray(points[lo:lo + chunk])
        flat, first, columns = part.ravel(), np.arange(len(part)) * part.shape[1], part.T.copy()
        for tree in range(len(feature)):
            f, t, v = feature[tree], threshold[tree], value[tree]
            at = (columns[f[0]] > t[0]) + 1
            for _ in range(height - 1):
                right = flat.take(first + f.take(at, mode="clip"), mode="clip") > t.take(at, mode="clip")
                at += at
                at += 1
                at += right
            found = v.take(at, mode="clip")
            out[lo:lo + chunk] += found if weights is None else found * weights[tree]
    return out


# ---- the model -----------------------------------------------------------------------------------------


@dataclass
class BoostedTrees:
    """One tree a row; its size is bounded by rounds and depth."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    weights: np.ndarray

    def node_counts(self) -> list[int]:
        """Nodes of each tree that can be reached."""
        live = np.zeros(self.feature.shape, bool)
        live[:, 0] = True
        for node in range(1, live.shape[1]):
            live[:, node] = live[:, (node - 1) // 2] & (self.feature[:, (node - 1) // 2] >= 0)
        return live.sum(axis=1).tolist()

    def to_rows(self, spark: SparkSession) -> DataFrame:
        rows = [(i, k, int(self.feature[i, k]), float(self.threshold[i, k]), float(self.value[i, k]), float(self.weights[i]))
                for i in range(len(self.feature)) for k in range(self.feature.shape[1])]
        return spark.createDataFrame(rows, TREE_SCHEMA)

    @classmethod
    def from_rows(cls, rows: DataFrame) -> "BoostedTrees":
        pdf = rows.select("tree", "node", "feature", "threshold", "value", "weight").toPandas().sort_values(["tree", "node"])
        shape = (pdf["tree"].nunique(), pdf["node"].nunique())
        feature, threshold, value, weight = (pdf[c].to_numpy().reshape(shape) for c in ("feature", "threshold", "value", "weight"))
        return cls(feature, threshold, value, weight[:, 0].copy())


# ---- fitting -------------------------------------------------------------------------------------------


def bounds_of(values: np.ndarray, bins: int) -> np.ndarray:
    """Upper bounds of all bins but the last, halfway between neighbouring values: between all of them if they are few, else
    where their counts come nearest to equal shares."""
    found, n = np.unique(values, return_counts=True)
    half = (found[:-1] + found[1:]) / 2.0
    if len(half) < bins:
        return half
    share, cuts, target, count = len(values) / bins, [], len(values) / bins, n[0]
    for k in range(1, len(found)):
        before, count = count, count + n[k]
        if abs(before - target) < abs(count - target):
            cuts.append(half[k - 1])
            target += share
    return np.array(cuts)


def bin_bounds(rows: DataFrame, inputs: list[str], seed: int) -> list[np.ndarray]:
    """Bounds of each input from about ``SAMPLE`` rows; the rows themselves all take part in every pass."""
    total = rows.count()
    if not total:
        raise ValueError("no rows to fit trees on")
    some = rows if total <= SAMPLE else rows.sample(False, SAMPLE / total, seed)
    points = some.select(*inputs).toPandas().to_numpy(float)
    if not len(points):
        points = rows.select(*inputs).limit(SAMPLE).toPandas().to_numpy(float)
    return [bounds_of(column, min(BINS, total)) for column in points.T]


def binned(rows: DataFrame, inputs: list[str], label: str, bounds: list[np.ndarray]) -> DataFrame:
    """Blocks of rows: ``codes``, a byte for each input and row, input by input, and ``label`` as -1 or 1, a byte a row."""
    def block(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def packed(held: list) -> pa.RecordBatch:
            codes, labels = np.concatenate([h[0] for h in held], axis=1), np.concatenate([h[1] for h in held])
            return pa.RecordBatch.from_arrays(
                [pa.array([codes.tobytes()], pa.binary()), pa.array([labels.tobytes()], pa.binary())], ["codes", "label"])

        held, n = [], 0
        for batch in batches:
            if not len(batch):
                continue
            *columns, truth = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(batch.num_columns))
            if any(np.isnan(c).any() for c in columns):
                raise ValueError("inputs hold nulls or NaN")
            if not np.isin(truth, (0.0, 1.0)).all():
                raise ValueError("labels are 0 or 1")
            held.append((np.stack([np.searchsorted(b, c).astype(np.uint8) for b, c in zip(bounds, columns)]),
                         (2 * truth - 1).astype(np.int8)))
            n += len(batch)
            if n >= BLOCK:
                yield packed(held)
                held, n = [], 0
        if held:
            yield packed(held)

    return rows.select(*inputs, label).mapInArrow(block, "codes binary, label binary")


def _walker(feature: np.ndarray, cut: np.ndarray, levels: int, found) -> Callable[[np.ndarray], np.ndarray]:
    """Gives ``found(node, ended)`` of the node where each row of a block is after so many levels; ``ended`` if its branch has
    ended before. Up to three levels are walked at once: every split within them answers with a bit, a table knows the rest."""
    def under(node: int, left: int):
        if left > 3 and feature[node] >= 0:
            yes, no = under(2 * node + 2, left - 1), under(2 * node + 1, left - 1)
            return lambda codes: np.where(codes[feature[node]] > cut[node], yes(codes), no(codes))
        splits, below = [], [(node, left)] if left <= 3 else []
        for at, more in below:
            if more and feature[at] >= 0:
                splits.append(at)
                below += [(2 * at + 1, more - 1), (2 * at + 2, more - 1)]

        def end(bits: int):
            at, more = node, left
            while more and feature[at] >= 0:
                at, more = 2 * at + 1 + (bits >> splits.index(at) & 1), more - 1
            return found(at, more > 0)

        ends = np.array([end(bits) for bits in range(1 << len(splits))])

        def walk(codes: np.ndarray) -> np.ndarray:
            bits = np.zeros(codes.shape[1], np.uint8)
            for bit, at in enumerate(splits):
                bits |= (codes[feature[at]] > cut[at]).view(np.uint8) << np.uint8(bit)
            return ends.take(bits, mode="clip")

        return walk

    return under(0, levels)


def _margins(trees: list[tuple], weights: list[float], inputs: int) -> Callable[[tuple], tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Codes, labels and margins of a block after ``trees``; blocks from the store have no margin yet."""
    steps = [_walker(feature, cut.astype(np.uint8), len(feature).bit_length() - 1, lambda node, ended, v=weight * value: v[node])
             for (feature, cut, _, value), weight in zip(trees, weights)]

    def after(block: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        codes, label, *margin = block
        grid = np.frombuffer(codes, np.uint8).reshape(inputs, -1)
        total = np.frombuffer(margin[0], float).copy() if margin else np.zeros(grid.shape[1])
        for step in steps:
            total += step(grid)
        return grid, np.frombuffer(label, np.int8), total

    return after


def _advanced(trees: list[tuple], weights: list[float], inputs: int):
    """Blocks with their margins after ``trees``."""
    def advance(blocks: Iterator) -> Iterator:
        after = _margins(trees, weights, inputs)
        for block in blocks:
            yield bytes(block[0]), bytes(block[1]), after(block)[2].tobytes()

    return advance


def _histograms(state: RDD, pending: tuple[list, list], feature: np.ndarray, cut: np.ndarray, open_: list[int], level: int,
                first: bool, inputs: int):
    """Count of the residuals after the ``pending`` trees, their sum and that of their squares, by open node, input and bin."""
    def collect(blocks: Iterator) -> Iterator:
        k = len(open_)
        slot = {node: BINS * j for j, node in enumerate(open_)}  # rows of other nodes are counted behind them and left out
        size = (k + 1) * BINS
        count, total, square = (np.zeros((inputs, size)) for _ in range(3))
        after = _margins(*pending, inputs)
        place_of = _walker(feature, cut.astype(np.uint8), level, lambda node, ended: slot.get(-1 if ended else node, k * BINS))
        for block in blocks:
            grid, label, margin = after(block)
            y = label.astype(float)
            residual = y if first else 4.0 * y / (1.0 + np.exp(2.0 * y * margin))
            squared, place = residual * residual, place_of(grid)
            for f in range(inputs):
                at = place + grid[f]
                count[f] += np.bincount(at, minlength=size)
                total[f] += np.bincount(at, residual, size)
                square[f] += np.bincount(at, squared, size)
        yield tuple(a[:, :k * BINS] for a in (count, total, square))

    parts = state.mapPartitions(collect).collect()
    count, total, square = (sum(p[j] for p in parts) for j in range(3))
    by_node = lambda a: a.reshape(inputs, len(open_), BINS).transpose(1, 0, 2)
    return by_node(count), by_node(total), by_node(square)


def _grow(state: RDD, pending: tuple[list, list], bounds: list[np.ndarray], depth: int, first: bool) -> tuple[np.ndarray, ...]:
    """One tree on the residuals: feature, bin and value it splits at, and the mean of each node."""
    size, inputs = (2 << depth) - 1, len(bounds)
    feature, cut = np.full(size, -1, np.int64), np.zeros(size, np.int64)
    threshold, value = np.zeros(size), np.zeros(size)
    variance = np.zeros(size)
    of = lambda n, s, q: (q - s * s / n) / n
    open_ = [0]
    for level in range(depth):
        if not open_:
            break
        counts, sums, squares = _histograms(state, pending, feature, cut, open_, level, first, inputs)
        children = []
        for node, *stats in zip(open_, counts, sums, squares):
            left = [a.cumsum(axis=1) for a in stats]
            whole = [a[:, -1:] for a in left]
            if node == 0:
                n, s, q = (a[0, 0] for a in whole)
                value[0], variance[0] = s / n, of(n, s, q)
            left = [a[:, :-1] for a in left]
            right = [w - a for w, a in zip(whole, left)]
            with np.errstate(divide="ignore", invalid="ignore"):
                spread = of(*left), of(*right)
                gain = variance[node] - left[0] / whole[0] * spread[0] - right[0] / whole[0] * spread[1]
            gain = np.where((left[0] > 0) & (right[0] > 0), gain, -np.inf)
            f, c = np.unravel_index(int(gain.argmax()), gain.shape)
            if not gain[f, c] > 0:
                continue
            feature[node], cut[node], threshold[node] = f, c, bounds[f][c]
            for child, (n, s, _), v in zip((2 * node + 1, 2 * node + 2), (left, right), spread):
                value[child], variance[child] = s[f, c] / n[f, c], v[f, c]
                if abs(v[f, c]) >= EPSILON:
                    children.append(child)
        open_ = children
    for node in reversed(range(size // 2)):  # leaves of one value are one leaf
        a, b = 2 * node + 1, 2 * node + 2
        if feature[node] >= 0 and feature[a] < 0 and feature[b] < 0 and value[a] == value[b]:
            feature[node], value[node] = -1, value[a]
    return feature, cut, threshold, value


def fit(rows: DataFrame, inputs: list[str], label: str, rounds: int, depth: int, lr: float, seed: int) -> BoostedTrees:
    spark = rows.sparkSession
    bounds = bin_bounds(rows, inputs, seed)
    path = scratch_path(spark, "binned")
    # few large partitions: there are three passes a tree, and a block is never split
    binned(rows, inputs, label, bounds).repartition(spark.sparkContext.defaultParallelism).write.parquet(path)
    stored = spark.read.schema("codes binary, label binary").parquet(path).rdd.map(tuple)
    trees, weights, state, kept = [], [], None, 0
    for m in range(rounds):
        if m % KEEP == 0:
            since = 0 if m % RESTART == 0 else kept
            source = stored if m % RESTART == 0 else state
            after = source.mapPartitions(_advanced(trees[since:], weights[since:], len(inputs))).persist(StorageLevel.MEMORY_AND_DISK)
            kept = m
        trees.append(_grow(after, (trees[kept:], weights[kept:]), bounds, depth, m == 0))
        weights.append(1.0 if m == 0 else lr)
        if m == kept:
            if state is not None:
                state.unpersist()
            state = after
    if state is not None:
        state.unpersist()
    feature, _, threshold, value = (np.stack(columns) for columns in zip(*trees))
    return BoostedTrees(feature, threshold, value, np.array(weights))
