"""Whitening of embeddings by an incremental eigendecomposition.

Every partition of the distinct vectors keeps the spectrum of its scatter matrix and brings it up to date by centred
rank-one updates: the secular equation gives the new eigenvalues, entries that do not change are deflated, and the new
eigenvectors follow from weights computed back from the eigenvalues, so they stay orthogonal. Spectra are combined a few
at a time in tasks, again by rank-one updates: one for every eigenpair of the other and one for the distance of the means.
A distributed Rayleigh-Ritz step in the basis found that way gives the components to double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from .common import staged

EPS = float(np.finfo(float).eps)
SPECTRUM = "part long, n long, sums array<decimal(38,0)>, values binary, basis binary"
LONGEST = (1 << 63) - 1


def secular_roots(d: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The roots of 1 + sum(w^2 / (d - x)), one above every pole: (the pole each is measured from, the distance to it).

    ``d`` ascends strictly and no ``w`` is zero. The sums on both sides of a root are interpolated by one pole each, which
    converges quadratically; steps that leave the bracket are replaced by bisection.
    """
    k = len(d)
    w2 = w * w
    total = w2.sum()
    gap = np.append(np.diff(d), total)
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        middle = 1 + (w2 / (d - (d + gap / 2)[:, None])).sum(1)
        right = middle < 0
        right[-1] = False  # the last root has a pole on its left only
        origin = np.where(right, np.append(d[1:], d[-1]), d)
        delta = d - origin[:, None]
        lo, hi = np.where(right, -gap / 2, 0.0), np.where(right, 0.0, gap / 2)
        hi[-1] = total if middle[-1] < 0 else gap[-1] / 2
        left_pole, right_pole = np.where(right, -gap, 0.0), np.where(right, 0.0, gap)
        mine = np.tri(k, dtype=bool)
        x = (lo + hi) / 2
        for _ in range(100):
            away = delta - x[:, None]
            terms = w2 / away
            slopes = terms / away
            f = 1 + terms.sum(1)
            done = np.abs(f) <= 4 * EPS * (1 + np.abs(terms).sum(1))
            narrow = hi - lo <= 2 * EPS * np.maximum(np.abs(lo), np.abs(hi))
            if (done | narrow).all():
                break
            lo, hi = np.where(f < 0, x, lo), np.where(f > 0, x, hi)
            psi, psi1 = np.where(mine, terms, 0).sum(1), np.where(mine, slopes, 0).sum(1)
            phi, phi1 = f - 1 - psi, np.where(mine, 0, slopes).sum(1)
            a1, a2 = left_pole - x, right_pole - x
            s1, s2 = psi1 * a1 * a1, phi1 * a2 * a2
            s2[-1] = 0.0
            c = 1 + psi - psi1 * a1 + phi - phi1 * a2
            c[-1] = 1 + psi[-1] - psi1[-1] * a1[-1]
            b, e = c * (left_pole + right_pole) + s1 + s2, s1 * right_pole + s2 * left_pole
            root = np.sqrt(np.maximum(b * b - 4 * c * e, 0))
            big = b + np.where(b < 0, -root, root)
            one, two = 2 * e / big, big / (2 * c)
            one[-1] = two[-1] = s1[-1] / c[-1]
            inside = lambda y: (y > lo) & (y < hi)
            step = np.where(inside(one), one, np.where(inside(two), two, (lo + hi) / 2))
            x = np.where(done | narrow, x, step)
    return origin, x


def rank_one(values: np.ndarray, basis: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, ascending, and eigenvectors of basis * diag(values) * basis' + v * v'."""
    d, q, w = values.copy(), basis.copy(), basis.T @ v
    norm = float(np.linalg.norm(w))
    tolerance = 8 * EPS * max(float(np.abs(d).max(initial=0)), norm * norm)
    active, last = [], -1
    for j in np.flatnonzero(norm * np.abs(w) > tolerance).tolist():
        if last >= 0:
            size = float(np.hypot(w[j], w[last]))
            c, s = w[j] / size, -w[last] / size
            if abs((d[j] - d[last]) * c * s) <= tolerance:  # as good as one eigenvalue: turn the weight onto one vector
                w[j], w[last] = size, 0.0
                q[:, last], q[:, j] = c * q[:, last] + s * q[:, j], c * q[:, j] - s * q[:, last]
                d[last], d[j] = d[last] * c * c + d[j] * s * s, d[last] * s * s + d[j] * c * c
                active.pop()
        active.append(j)
        last = j
    if active:
        at = np.array(active)
        at = at[np.argsort(d[at], kind="stable")]
        poles, weights = d[at], w[at]
        origin, x = secular_roots(poles, weights)
        away = (origin - poles[:, None]) + x  # [i, j]: root j less pole i
        # the weights whose exact roots these are
        below = np.tri(len(at), k=-1, dtype=bool)  # j < i
        with np.errstate(divide="ignore", invalid="ignore"):
            gaps = poles - poles[:, None]
            after = np.append(poles[1:], 0) - poles[:, None]
            ratio = np.where(below, away / gaps, away / after)
        ratio[:, -1] = away[:, -1]
        exact = np.sqrt(np.abs(np.prod(ratio, axis=1))) * np.sign(weights)
        with np.errstate(divide="ignore", invalid="ignore"):
            vectors = exact[:, None] / away
        vectors /= np.linalg.norm(vectors, axis=0)
        q[:, at] = q[:, at] @ vectors
        d[at] = origin + x
    order = np.argsort(d, kind="stable")
    return d[order], q[:, order]


@dataclass
class Spectrum:
    """Number of vectors, their exact sums, and the eigenpairs of their centred scatter matrix."""

    n: int
    sums: list[int]
    values: np.ndarray
    basis: np.ndarray

    @classmethod
    def empty(cls, dims: int) -> "Spectrum":
        return cls(0, [0] * dims, np.zeros(dims), np.eye(dims))

    def _shift(self, n: int, sums: list[int]) -> None:
        """Count ``n`` more vectors with these sums; their mean differs from ours, which is one update."""
        if self.n and n:
            apart = np.array([a / self.n - b / n for a, b in zip(self.sums, sums)])
            self.values, self.basis = rank_one(self.values, self.basis, apart * np.sqrt(self.n * n / (self.n + n)))
        self.n, self.sums = self.n + n, [a + b for a, b in zip(self.sums, sums)]

    def add(self, x: np.ndarray) -> None:
        """The rows of ``x``, whole numbers. More rows than dimensions are first turned by an orthogonal matrix into as many
        as there are dimensions, which leaves their scatter as it is."""
        sums = column_sums(x)
        rows = x - np.array([s / len(x) for s in sums])
        if len(rows) > rows.shape[1]:
            rows = np.linalg.qr(rows, mode="r")
        for row in rows:
            self.values, self.basis = rank_one(self.values, self.basis, row)
        self._shift(len(x), sums)

    def merge(self, other: "Spectrum") -> None:
        for value, vector in zip(other.values, other.basis.T):
            if value > 0:
                self.values, self.basis = rank_one(self.values, self.basis, np.sqrt(value) * vector)
        self._shift(other.n, other.sums)

    def row(self, part: int) -> tuple:
        return part, self.n, [Decimal(s) for s in self.sums], self.values.tobytes(), self.basis.tobytes()

    @classmethod
    def of(cls, n: int, sums: list, values: bytes, basis: bytes) -> "Spectrum":
        d = len(sums)
        return cls(n, [int(s) for s in sums], np.frombuffer(values).copy(), np.frombuffer(basis).reshape(d, d).copy())


def column_sums(x: np.ndarray) -> list[int]:
    """Exact, whatever the size of the entries."""
    if not x.size or float(np.abs(x.astype(float)).max()) * len(x) < 2.0 ** 62:
        return [int(s) for s in x.sum(0)]
    return [sum(map(int, column)) for column in x.T]


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Of every row the sum of (n x - S)^2, exact; beyond 64 bits the job stops."""
    most = n * int(np.abs(x.astype(float)).max(initial=0)) + max(map(abs, sums), default=0)
    if most * most * max(1, x.shape[1]) < LONGEST // 2:
        apart = n * x - np.array(sums, np.int64)
        return (apart * apart).sum(1).tolist()
    out = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
    if max(out, default=0) > LONGEST:
        raise OverflowError("a deviation does not fit 64 bits")
    return out


def whole_vectors(vectors: DataFrame, vec: Column, scale: int = 256) -> Column:
    """``vec`` as whole numbers, floor(scale * entry); null where it is null, empty or holds a null or non-finite entry. An
    entry beyond 2^62 after scaling stops the job."""
    finite = lambda e: e.isNotNull() & ~F.isnan(e.cast("double")) & (F.abs(e.cast("double")) != float("inf"))
    scaled = lambda e: e.cast("double") * float(scale)
    whole = lambda e: F.when(F.abs(scaled(e)) < 2.0 ** 62, F.floor(scaled(e))).otherwise(
        F.raise_error("an entry is too large for a whole number").cast("long"))
    return F.when((F.size(vec) > 0) & F.forall(vec, finite), F.transform(vec, whole))


def _matrix(column, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _summed(fit: DataFrame, dims: int, of) -> np.ndarray:
    """The sum over all fitted vectors of the symmetric matrix that ``of`` gives for a batch; cells are added up in Spark."""
    def cells(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total = None
        for batch in batches:
            if batch.num_rows:
                m = of(_matrix(batch.column(0), dims))
                total = m if total is None else total + m
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], ["i", "j", "v"])

    got = fit.mapInArrow(cells, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    size = 1 + max(r["j"] for r in got)
    out = np.zeros((size, size))
    for r in got:
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["v"]
    return out


def spectrum(fit: DataFrame, dims: int, block: int = 4096, fan_in: int = 8) -> Spectrum:
    """Of all rows of ``fit`` (column x). Tasks hold one spectrum and one block of rows; each round merges ``fan_in`` spectra
    in a task, and the last round's single one, of the size of a covariance matrix, comes to the driver."""
    def build(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        own = Spectrum.empty(dims)
        for batch in batches:
            x = _matrix(batch.column(0), dims)
            for k in range(0, len(x), block):
                own.add(x[k:k + block])
        if own.n:
            yield pa.RecordBatch.from_pylist([dict(zip(("part", "n", "sums", "values", "basis"), own.row(TaskContext.get().partitionId())))], SCHEMA)

    def merge(group):
        import pyarrow as pa

        rows = group.sort_by("part").to_pylist()
        first, *others = [Spectrum.of(r["n"], r["sums"], r["values"], r["basis"]) for r in rows]
        for other in others:
            first.merge(other)
        return pa.Table.from_pylist([dict(zip(("part", "n", "sums", "values", "basis"), first.row(rows[0]["part"] // fan_in)))], SCHEMA)

    import pyarrow as pa

    SCHEMA = pa.schema([("part", pa.int64()), ("n", pa.int64()), ("sums", pa.list_(pa.decimal128(38, 0))),
                        ("values", pa.binary()), ("basis", pa.binary())])
    parts = staged(fit.mapInArrow(build, SPECTRUM), "spectra")
    while (parts.agg(F.max("part")).first()[0] or 0) > 0:  # as many rounds as the logarithm of the number of tasks
        groups = parts.withColumn("__to", F.floor(F.col("part") / fan_in)).groupBy("__to")
        parts = staged(groups.applyInArrow(merge, SPECTRUM), "spectra")
    r = parts.first()
    return Spectrum.of(r["n"], r["sums"], r["values"], r["basis"])


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", top: int = 4, scale: int = 256) -> DataFrame:
    """For each usable row and each of the first ``top`` components: ``__id``, component (from 1), n, deviation, whitened,
    explained, identity_error.

    Vectors that are null or empty, hold a null or non-finite entry, or are not of the commonest length (of the longest of
    such) are left out. Entries become whole numbers; each distinct vector counts once in the fit, however often it stands in
    the table, so ties and repeated rows change nothing and every repeated row gets its own result. A component without
    variance has a null ``whitened`` and does not count in ``identity_error``; where nothing varies, ``explained`` and
    ``identity_error`` are null too. Ids may be null. No usable row gives no rows. Other columns are not read.
    """
    spark = vectors.sparkSession
    out = StructType([StructField("__id", vectors.schema[id_col].dataType), StructField("component", IntegerType()),
                      StructField("n", LongType()), StructField("deviation", LongType()), StructField("whitened", DoubleType()),
                      StructField("explained", DoubleType()), StructField("identity_error", DoubleType())])
    rows = vectors.select(F.col(id_col).alias("__id"), whole_vectors(vectors, F.col(vec_col), scale).alias("x")).where("x is not null")
    length = rows.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    if length is None:
        return spark.createDataFrame([], out)
    dims = length["dims"]
    rows = rows.where(F.size("x") == dims)
    fit = staged(rows.select("x").distinct(), "vectors")

    found = spectrum(fit, dims)
    n, sums = found.n, found.sums
    mean = np.array([s / n for s in sums])
    basis = np.linalg.qr(found.basis)[0]

    def scatter(x: np.ndarray) -> np.ndarray:
        y = (x - mean) @ basis
        return y.T @ y

    values, turn = np.linalg.eigh(_summed(fit, dims, scatter) / n)
    values, components = np.maximum(values[::-1], 0), (basis @ turn)[:, ::-1]
    trace, top = float(values.sum()), min(top, dims)
    values, components = values[:top], components[:, :top]
    live = values > dims * EPS * values[0] if trace > 0 else np.zeros(top, bool)
    project = components[:, live] / np.sqrt(values[live])

    def identity(x: np.ndarray) -> np.ndarray:
        y = (x - mean) @ project
        return y.T @ y

    error = float(np.abs(_summed(fit, dims, identity) / n - np.eye(int(live.sum()))).max()) if live.any() else None
    explained = [float(v) / trace if trace > 0 else None for v in values]
    alive = live.tolist()

    def apply(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            x = _matrix(batch.column(1), dims)
            white = np.zeros((len(x), top))
            white[:, alive] = (x - mean) @ project
            m = batch.num_rows
            arrays = [batch.column(0).take(pa.array(np.repeat(np.arange(m), top))),
                      pa.array(np.tile(np.arange(1, top + 1, dtype=np.int32), m)), pa.array(np.full(m * top, n, np.int64)),
                      pa.array(np.repeat(np.array(deviations(x, n, sums), np.int64), top)),
                      pa.array(white.ravel(), mask=np.tile(~np.array(alive), m)),
                      pa.array(explained * m, pa.float64()), pa.array([error] * (m * top), pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, out.names)

    return rows.mapInArrow(apply, out)
