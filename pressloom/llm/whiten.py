"""Embedding whitening: every partition keeps the spectrum of its rows by centred
rank-one updates, spectra are combined by rank-one updates as well, and a distributed
Rayleigh-Ritz step over all rows refines the result."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import spread
from .vectors import floors, matrix, usable

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Spectra or matrices that one task of a round combines.
FAN = 8
#: Components with a smaller part of the largest variance count as constant.
CONSTANT = 1e-11
_EPS = np.finfo(float).eps
PACKED = "part int, n long, mean binary, values binary, vectors binary"


@dataclass
class Spectrum:
    """Eigenvalues, ascending, and eigenvectors (columns) of the scatter of ``n`` rows
    about their mean."""

    n: int
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @staticmethod
    def empty(width: int) -> Spectrum:
        return Spectrum(0, np.zeros(width), np.zeros(width), np.eye(width))

    def add(self, row: np.ndarray, times: int = 1) -> None:
        """Take in ``times`` copies of a row: the scatter grows by one centred square."""
        total, gap = self.n + times, row - self.mean
        self.values, self.vectors = rank_one(self.values, self.vectors, gap, self.n * times / total)
        self.mean = self.mean + gap * (times / total)
        self.n = total

    def merge(self, other: Spectrum) -> None:
        """Take in another spectrum: one update for each of its components that varies
        and one for the gap between the means."""
        for value, vector in zip(other.values, other.vectors.T, strict=True):
            if value > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, vector, value)
        total, gap = self.n + other.n, other.mean - self.mean
        self.values, self.vectors = rank_one(self.values, self.vectors, gap, self.n * other.n / total)
        self.mean = self.mean + gap * (other.n / total)
        self.n = total


def secular_roots(poles: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of ``1 + sum(weights / (poles - x))`` for ascending poles and positive weights.

    One root lies right of each pole. Each is found as its distance from the nearer pole,
    by rational interpolation with the two poles around it, inside a bracket. Returns the
    roots and the matrix ``poles[j] - roots[i]``, which keeps its relative accuracy.
    """
    k = len(poles)
    at = np.arange(k)
    reach = weights.sum()
    gap = np.append(np.diff(poles), reach)
    left = at <= at[:, None]
    half = gap / 2
    middle = 1 + (weights / (poles - poles[:, None] - half[:, None])).sum(1)
    near_left = middle >= 0
    near_left[-1] = True
    origin = np.where(near_left, at, np.minimum(at + 1, k - 1))
    low = np.where(near_left, 0.0, -half)
    high = np.where(near_left, np.where(at == k - 1, reach, half), 0.0)
    shifted = poles - poles[origin][:, None]
    own = shifted[at, at]
    following = np.append(shifted[at[:-1], at[1:]], reach)
    tau = (low + high) / 2
    for _ in range(120):
        away = shifted - tau[:, None]
        part = weights / away
        slope = part / away
        psi, dpsi = (part * left).sum(1), (slope * left).sum(1)
        phi, dphi = part.sum(1) - psi, slope.sum(1) - dpsi
        value = 1 + psi + phi
        low, high = np.where(value < 0, tau, low), np.where(value < 0, high, tau)
        done = (np.abs(value) <= 4 * k * _EPS * (1 + np.abs(psi) + np.abs(phi))) | (
            high - low <= 2 * _EPS * np.abs(tau))
        if done.all():
            break
        with np.errstate(all="ignore"):
            a1, a2 = own - tau, following - tau
            c = value - a1 * dpsi - a2 * dphi
            a = (a1 + a2) * value - a1 * a2 * (dpsi + dphi)
            b = a1 * a2 * value
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = tau + np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
        inside = np.where(low == 0, high / 64, np.where(high == 0, low / 64, (low + high) / 2))
        step = np.where(np.isfinite(step) & (step > low) & (step < high), step, inside)
        tau = np.where(done, tau, step)
    return poles[origin] + tau, shifted - tau[:, None]


def rank_one(
    values: np.ndarray, vectors: np.ndarray, vector: np.ndarray, weight: float
) -> tuple[np.ndarray, np.ndarray]:
    """Spectrum of ``vectors diag(values) vectors' + weight * vector vector'``.

    Components that the update does not touch are deflated, and of components with equal
    values a reflection leaves one that it touches. The rest solve the secular equation;
    their vectors are those of the weights that have exactly the computed roots, which
    keeps them orthogonal.
    """
    z = vectors.T @ vector
    norm = float(np.sqrt(z @ z))
    least = 8 * _EPS * max(float(values[-1]) if len(values) else 0.0, weight * norm * norm)
    if not weight * norm * norm > 0:
        return values, vectors
    values, vectors = values.copy(), vectors.copy()
    begin = 0
    for end in range(1, len(values) + 1):
        if end < len(values) and values[end] - values[begin] <= least:
            continue
        if end - begin > 1:
            same = slice(begin, end)
            length = float(np.linalg.norm(z[same]))
            if length > 0:
                mirror = z[same].copy()
                mirror[-1] += np.copysign(length, mirror[-1])
                mirror /= np.linalg.norm(mirror)
                kept = -np.copysign(length, z[end - 1])
                vectors[:, same] -= 2 * np.outer(vectors[:, same] @ mirror, mirror)
                z[same] = 0
                z[end - 1] = kept
            values[same] = values[begin]
        begin = end
    live = np.flatnonzero(weight * np.abs(z) * norm > least)
    if len(live):
        poles, z = values[live], z[live]
        roots, away = secular_roots(poles, weight * z * z)
        between = poles[:, None] - poles
        np.fill_diagonal(between, 1.0)
        exact = np.copysign(np.sqrt(np.abs(np.prod(-away / between, axis=0))), z)
        turn = exact / away
        turn /= np.linalg.norm(turn, axis=1)[:, None]
        vectors[:, live] = vectors[:, live] @ turn.T
        values[live] = roots
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


def _pack(part: int, s: Spectrum) -> list:
    return [part, s.n, s.mean.tobytes(), s.values.tobytes(), s.vectors.tobytes()]


def _unpack(row) -> Spectrum:
    mean = np.frombuffer(row.mean)
    return Spectrum(int(row.n), mean, np.frombuffer(row.values),
                    np.frombuffer(row.vectors).reshape(len(mean), len(mean)))


def _batch(rows: list[list], names: str) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[f.split()[0] for f in names.split(", ")])


def folded(parts: DataFrame, schema: str, count: int, fold: Callable[[pd.DataFrame], pd.DataFrame]) -> DataFrame:
    """Combine the rows of ``parts``, numbered by ``part`` below ``count``, ``FAN`` at a time
    until one is left."""
    while count > 1:
        parts = parts.groupBy(F.floor(F.col("part") / FAN).alias("__to")).applyInPandas(fold, schema)
        count = -(-count // FAN)
    return parts


def _rows(batches: Iterator[pa.RecordBatch], width: int, about: np.ndarray) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches with their vectors, as whole numbers about a whole centre."""
    for batch in batches:
        yield batch, matrix(batch.column("x"), width, OFFSET) - about


def _sums(width: int) -> Callable:
    """Number of rows and sum of each dimension in a partition, exact."""
    def run(batches):
        n, total = 0, np.zeros(width, object)
        for batch in batches:
            x = matrix(batch.column("x"), width, OFFSET)
            n += len(x)
            # 2**50 a component and 2**13 rows of it still fit.
            for at in range(0, len(x), 4096):
                total += x[at:at + 4096].sum(axis=0)
        if n:
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part] * width, pa.int32()), "at": pa.array(range(width), pa.int32()),
                "n": pa.array([n] * width, pa.int64()), "total": pa.array([str(int(t)) for t in total], pa.string())})
    return run


def _spectra(width: int, about: np.ndarray) -> Callable:
    def run(batches):
        own = Spectrum.empty(width)
        for _, y in _rows(batches, width, about):
            distinct, times = np.unique(y, axis=0, return_counts=True)
            for row, count in zip(distinct.astype(float), times.tolist(), strict=True):
                own.add(row, count)
        if own.n:
            yield pa.RecordBatch.from_pandas(
                _batch([_pack(TaskContext.get().partitionId(), own)], PACKED), preserve_index=False).cast(
                pa.schema([("part", pa.int32()), ("n", pa.int64()), *((c, pa.binary()) for c in ("mean", "values", "vectors"))]))
    return run


def _merged(group: pd.DataFrame) -> pd.DataFrame:
    rows = list(group.sort_values("part").itertuples())
    whole = _unpack(rows[0])
    for row in rows[1:]:
        whole.merge(_unpack(row))
    return _batch([_pack(int(rows[0].part) // FAN, whole)], PACKED)


SQUARES = "part int, total binary, squares binary"


def _squares(width: int, about: np.ndarray, rest: np.ndarray, basis: np.ndarray) -> Callable:
    """Sums and products of a partition's centred rows in a basis."""
    def run(batches):
        k = basis.shape[1]
        total, squares, seen = np.zeros(k), np.zeros((k, k)), False
        for _, y in _rows(batches, width, about):
            p = (y - rest) @ basis
            total, squares, seen = total + p.sum(0), squares + p.T @ p, True
        if seen:
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([TaskContext.get().partitionId()], pa.int32()),
                "total": pa.array([total.tobytes()], pa.binary()), "squares": pa.array([squares.tobytes()], pa.binary())})
    return run


def _added(group: pd.DataFrame) -> pd.DataFrame:
    rows = group.sort_values("part")
    return _batch([[int(rows.part.iloc[0]) // FAN, sum(map(np.frombuffer, rows.total)).tobytes(),
                    sum(map(np.frombuffer, rows.squares)).tobytes()]], SQUARES)


def _covariance(x: DataFrame, parts: int, n: int, *args) -> np.ndarray:
    """Covariance of the rows in a basis, over all of them."""
    run = x.select("x").mapInArrow(_squares(*args), SQUARES)
    rows = folded(run, SQUARES, parts, _added).collect()
    k = args[-1].shape[1]
    total, squares = (sum(np.frombuffer(r[c]) for r in rows) for c in ("total", "squares"))
    return (squares.reshape(k, k) - np.outer(total, total) / n) / n


@dataclass
class Model:
    """Mean (``about + rest``, ``about`` whole), exact sums and components of the rows."""

    n: int
    sums: list[int]
    about: np.ndarray
    rest: np.ndarray
    values: np.ndarray
    trace: float
    vectors: np.ndarray
    identity_error: float


def prepared(table: DataFrame, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """``vec_id`` and the whole-number vector ``x`` of each usable row."""
    x = F.transform(floors(F.col("embedding"), scale), lambda c: c + F.lit(offset))
    return spread(table.filter(usable(F.col("embedding"))).select("vec_id", x.alias("x")), "vec_id")


def fit(x: DataFrame, components: int = COMPONENTS) -> Model | None:
    """Spectrum of the covariance of all rows of ``prepared``.

    What reaches the driver and one task is a matrix of width times width, whatever the
    number of rows. None if there are no rows or no dimension varies.
    """
    width = x.agg(F.max(F.size("x"))).first()[0]
    if not width:
        return None
    sums = x.select("x").mapInArrow(_sums(width), "part int, at int, n long, total string").groupBy("at").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.max("part").alias("part")
    ).orderBy("at").collect()
    n, parts, totals = sums[0].n, sums[0].part + 1, [int(r.total) for r in sums]
    whole = [(2 * t + n) // (2 * n) for t in totals]
    about, rest = np.array(whole, np.int64), np.array([(t - n * w) / n for t, w in zip(totals, whole, strict=True)])
    rows = folded(x.select("x").mapInArrow(_spectra(width, about), PACKED), PACKED, parts, _merged).collect()
    spectrum = _unpack(rows[0])
    for row in rows[1:]:
        spectrum.merge(_unpack(row))
    # Rounding in the updates left the basis orthogonal to their number of roundings only.
    basis = np.linalg.qr(spectrum.vectors[:, ::-1])[0]
    ritz, turn = np.linalg.eigh(_covariance(x, parts, n, width, about, rest, basis))
    values, vectors = ritz[::-1], (basis @ turn)[:, ::-1]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(0), np.arange(width)])
    kept = min(components, int((values > values[0] * CONSTANT).sum())) if values[0] > 0 else 0
    if not kept:
        return None
    model = Model(n, totals, about, rest, values[:kept], float(ritz.sum()), vectors[:, :kept], 0.0)
    white = _covariance(x, parts, n, width, about, rest, model.vectors / np.sqrt(model.values))
    model.identity_error = float(np.abs(white - np.eye(kept)).max())
    return model


RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _projected(model: Model) -> Callable:
    """Rows of ``RESULT`` for each vector."""
    width, kept = model.vectors.shape
    gap = [s - model.n * int(a) for s, a in zip(model.sums, model.about, strict=True)]

    def run(batches):
        turn = model.vectors / np.sqrt(model.values)
        explained = model.values / model.trace
        for whole, y_all in _rows(batches, width, model.about):
            for at in range(0, len(y_all), 4096):
                batch, y = whole.slice(at, 4096), y_all[at:at + 4096]
                rows = len(y)
                if (int(np.abs(y).max()) + 1) ** 2 * model.n ** 2 * width < 2 ** 62:
                    far = ((model.n * y - np.array(gap, np.int64)) ** 2).sum(1).tolist()
                else:
                    far = [sum((model.n * c - g) ** 2 for c, g in zip(r, gap, strict=True)) for r in y.tolist()]
                    far = [f if f < 2 ** 63 else None for f in far]
                again = np.repeat(np.arange(rows), kept)
                yield pa.RecordBatch.from_pydict({
                    "vec_id": batch.column("vec_id").take(pa.array(again)),
                    "component": pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), rows)),
                    "n": pa.array(np.full(rows * kept, model.n)),
                    "deviation": pa.array(far, pa.int64()).take(pa.array(again)),
                    "whitened": pa.array(((y - model.rest) @ turn).ravel()),
                    "explained": pa.array(np.tile(explained, rows)),
                    "identity_error": pa.array(np.full(rows * kept, model.identity_error))})
    return run


def whitened(table: DataFrame, components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """Whitened components of every usable vector of ``table`` (vec_id, embedding).

    An entry ``c`` becomes ``floor(scale * c) + offset``; all statistics are of these whole
    numbers, over all usable rows. Returns vec_id, component (from 1, by falling variance),
    n, deviation (``n * n`` times the squared distance from the mean, exact; null beyond a
    long), whitened, explained, identity_error.

    Three passes fit the model: exact sums, the spectra of the partitions by rank-one
    updates (combined ``FAN`` at a time, so no task sees more than that many matrices), and
    the Rayleigh-Ritz step that makes the components exact to double precision. Copies of a
    vector within a batch are one weighted update.

    Null vectors and vectors with null or non-finite entries give no rows. A vector shorter
    than the longest one counts as having zeros there. Entries beyond 2**50 after scaling
    count as that. Repeated rows, and rows that share or lack an id, count and return once
    each. Components of equal variance have an arbitrary order. Fewer than ``components``
    come back if the vectors have fewer dimensions or fewer of them vary; none if there are
    no rows, one row or equal rows only. Other columns are ignored.
    """
    x = prepared(table.select("vec_id", "embedding"), scale, offset)
    model = fit(x, components)
    if model is None:
        return table.sparkSession.createDataFrame([], RESULT)
    return x.mapInArrow(_projected(model), RESULT)
