"""Whitening of embeddings by polarisation: covariances out of variances only.

For every dimension i, and for every sum of two dimensions i + j, the squares of the centred values are added up exactly;
since var(i + j) = var(i) + var(j) + 2 cov(i, j), the differences of these variances are all the covariances.  Values
are centred on whole numbers next to their means before they are squared, and what is left of the mean (less than one
half) is taken off as an exact integer: n^2 var = n * sum(z^2) - sum(z)^2.  Sums leave a task as whole numbers of up
to 38 digits, one row a dimension or pair, so what reaches the driver is as large as the covariance matrix, whatever
the table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored

_ADDED = ("component", "n", "deviation", "whitened", "explained", "identity_error")
_SUMS = "i int, j int, total decimal(38,0)"
_ROWS = 1024  # vectors squared at a time: _ROWS * dimensions numbers


def whole_vectors(table: DataFrame, vector: str = "embedding", scale: int = 256) -> DataFrame:
    """Rows whose vector is finite, with `x`: floor(scale * c) of each component as a long.

    Null vectors and those with null, NaN or infinite components go, and so do vectors of another length than most
    (of two lengths equally common, the longer stays) and empty ones.  Components beyond the range of a long stand at
    its ends."""
    v = F.col(vector)
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    sound = table.where(v.isNotNull() & (F.size(v) > 0)).where(finite)
    lengths = sound.groupBy(F.size(v).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = lengths["d"] if lengths else 0
    top = float(2**63 - 1024)  # the largest double below 2^63
    whole = F.transform(v, lambda c: F.floor(F.greatest(F.least(c.cast("double") * scale, F.lit(top)), F.lit(-top))))
    return sound.where(F.size(v) == d).withColumn("x", whole)


def _blocks(batches: Iterator[pa.RecordBatch], column: str, most: int = _ROWS) -> Iterator[tuple[np.ndarray, pa.RecordBatch]]:
    """Matrices of longs, a row a vector, of bounded slices of the batches."""
    for b in batches:
        for lo in range(0, b.num_rows, most):
            some = b.slice(lo, most)
            lists = some.column(some.schema.get_field_index(column))
            yield lists.flatten().to_numpy(zero_copy_only=False).reshape(some.num_rows, -1), some


def _less(x: np.ndarray, centre: list[int]) -> np.ndarray:
    """x - centre, in longs where they hold squares of sums, or else in whole numbers of any size."""
    most = max([0, *(abs(int(v)) for v in (x.max(initial=0), x.min(initial=0), *centre))])
    kind = np.int64 if most < 2**20 else object  # squares of sums of two, _ROWS times
    return x.astype(kind) - np.array(centre, kind)


def _totals(df: DataFrame, names: int, add) -> dict[tuple[int, int], int]:
    """Sums over all rows of `x`: add(matrix) gives {(i, j): numbers}, a task sends one row for each pair, tasks are summed by pair."""

    def partial(batches):
        sums: dict[tuple[int, int], int] = {}
        for x, _ in _blocks(batches, "x"):
            for key, value in add(x):
                sums[key] = sums.get(key, 0) + int(value)
        if sums:
            keys = list(sums)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()), pa.array([Decimal(sums[k]) for k in keys], pa.decimal128(38, 0))], ["i", "j", "total"])

    found = df.select("x").mapInArrow(partial, _SUMS).groupBy("i", "j").agg(F.sum("total").alias("total")).collect()
    assert len(found) <= names  # as many as there are entries of the matrix
    return {(r["i"], r["j"]): int(r["total"]) for r in found}


@dataclass
class Whitening:
    """Exact sums of the fit list and what is derived from them; everything here is of the size of the matrix."""

    n: int
    sums: list[int]  # of x by dimension
    covariance: np.ndarray
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # a column an eigenvector
    identity_error: float = 0.0

    @property
    def centre(self) -> list[int]:
        return [round(Fraction(s, self.n)) for s in self.sums]

    @property
    def live(self) -> np.ndarray:
        """Components with a variance above rounding."""
        return self.values > self.values[0] * len(self.values) * np.finfo(float).eps if len(self.values) else np.zeros(0, bool)

    def explained(self) -> np.ndarray:
        trace = float(np.trace(self.covariance))
        return self.values / trace if trace > 0 else np.full(len(self.values), np.nan)

    def project(self, x: np.ndarray, components: int) -> np.ndarray:
        """Whitened coordinates, NaN in components without variance."""
        z, rest = _less(x, self.centre), np.array([float(Fraction(s, self.n) - c) for s, c in zip(self.sums, self.centre)])
        e = np.where(self.live, self.values, np.nan)[:components]
        return (z.astype(float) - rest) @ self.vectors[:, :components] / np.sqrt(e)

    def deviation(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n * x - S)^2 of each row, exact."""
        z = _less(x, self.centre)
        rest = [s - self.n * c for s, c in zip(self.sums, self.centre)]  # at most n / 2
        most = self.n * (int(np.abs(z).max(initial=0)) + 1)
        small = most * most * max(1, z.shape[1]) < 2**62
        y = z.astype(np.int64 if small else object) * self.n - np.array(rest, np.int64 if small else object)
        return [int(v) for v in (y * y).sum(1)]


def _squares(centre: list[int]):
    """Squares of every centred dimension, and of every sum of two of them."""

    def add(x: np.ndarray):
        z = _less(x, centre)
        for i in range(z.shape[1]):
            yield (i, i), (z[:, i] ** 2).sum()
            pair = z[:, i : i + 1] + z[:, i + 1 :]
            for j, v in enumerate((pair * pair).sum(0), i + 1):
                yield (i, j), v

    return add


def fit(listed: DataFrame) -> Whitening:
    """The whitening of a frame of distinct vectors `x`, which is read twice.

    An empty frame gives n = 0; a single vector gives components without variance."""
    head = listed.select(F.size("x").alias("d")).first()
    if head is None:
        return Whitening(0, [], np.zeros((0, 0)), np.zeros(0), np.zeros((0, 0)))
    d = head["d"]

    def sums(x: np.ndarray):
        exact = x.astype(object) if int(np.abs(x.astype(float)).max(initial=0)) >= 2**50 else x
        yield (-1, -1), len(x)
        for i, v in enumerate(exact.sum(0)):
            yield (i, i), v

    total = _totals(listed, d + 1, sums)
    n, s = total.pop((-1, -1)), [total[i, i] for i in range(d)]
    centre = [round(Fraction(v, n)) for v in s]
    left = [v - n * c for v, c in zip(s, centre)]  # sums of the centred values
    square = _totals(listed, d * (d + 1) // 2, _squares(centre))

    def variance(i: int, j: int) -> int:
        """n^2 times the variance of dimension i, or of i + j."""
        rest = left[i] if i == j else left[i] + left[j]
        return n * square[i, j] - rest * rest

    own = [variance(i, i) for i in range(d)]
    cov = np.zeros((d, d))
    for i in range(d):
        cov[i, i] = float(Fraction(own[i], n * n))
        for j in range(i + 1, d):
            cov[i, j] = cov[j, i] = float(Fraction(variance(i, j) - own[i] - own[j], 2 * n * n))
    values, vectors = np.linalg.eigh(cov)
    return Whitening(n, s, cov, values[::-1].copy(), vectors[:, ::-1].copy())


def identity_error(listed: DataFrame, model: Whitening, components: int) -> float:
    """Largest entry of the covariance of whitened coordinates minus the identity, by the same differences of variances.

    One row a task of sums of coordinates, of their squares and of squares of their sums in twos."""
    k = min(components, len(model.values))
    pairs = [(i, j) for i in range(k) for j in range(i, k)]

    def partial(batches):
        sums = np.zeros(k + len(pairs))
        for x, _ in _blocks(batches, "x"):
            w = np.nan_to_num(model.project(x, k))
            sums += np.concatenate([w.sum(0), [((w[:, i] if i == j else w[:, i] + w[:, j]) ** 2).sum() for i, j in pairs]])
        yield pa.RecordBatch.from_arrays([pa.array([sums.tolist()], pa.list_(pa.float64()))], ["sums"])

    at = F.posexplode("sums").alias("at", "value")
    rows = listed.select("x").mapInArrow(partial, "sums array<double>").select(at).groupBy("at").agg(F.sum("value").alias("value")).collect()
    total = {r["at"]: r["value"] / model.n for r in rows}
    mean = [total[i] for i in range(k)]
    var = {p: total[k + at] - ((mean[p[0]] if p[0] == p[1] else mean[p[0]] + mean[p[1]]) ** 2) for at, p in enumerate(pairs)}
    live = model.live
    off = [abs((var[i, j] if i == j else (var[i, j] - var[i, i] - var[j, j]) / 2) - (i == j)) for i, j in pairs if live[i] and live[j]]
    return max(off, default=0.0)


def whiten(table: DataFrame, components: int = 4, vector: str = "embedding", scale: int = 256) -> DataFrame:
    """Whitened coordinates of every row with a sound vector, a row for each of the first components.

    Rows: the columns of the table but the vector, then component (from 1), n, deviation (decimal(38,0), exact;
    null beyond 38 digits), whitened, explained and identity_error.  Rows without a finite vector of the commonest length go; equal rows are
    treated alike, and a vector counts once in the fit however often it comes.  Components without variance (one distinct
    vector, fewer vectors than dimensions) have a null whitened; vectors of fewer dimensions than components have as
    many rows as dimensions.  An empty table gives no rows; columns with the names of added ones are replaced."""
    own = [c for c in table.columns if c not in (*_ADDED, vector, "x")]
    whole = whole_vectors(table, vector, scale)
    listed = stored(whole.select("x").distinct(), "fit_list")  # copies of a vector meet in each task before the shuffle
    model = fit(listed)
    schema = T.StructType([*(table.schema[c] for c in own), *T._parse_datatype_string("component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double").fields])
    if model.n == 0:
        return table.sparkSession.createDataFrame([], schema)
    model.identity_error = identity_error(listed, model, components)
    k = min(components, len(model.values))
    explained = [None if math.isnan(v) else float(v) for v in model.explained()[:k]]

    def rows(batches):
        for x, some in _blocks(batches, "x"):
            n, w = len(x), model.project(x, k)
            at = pa.array(np.repeat(np.arange(n), k))
            deviation = pa.array([Decimal(v) if v < 10**38 else None for v in model.deviation(x)], pa.decimal128(38, 0)).take(at)
            flat = pa.array(w.ravel(), pa.float64(), from_pandas=True)
            added = [pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)), pa.array(np.full(n * k, model.n)), deviation, flat, pa.array(explained * n, pa.float64()), pa.array(np.full(n * k, model.identity_error))]
            kept = [some.column(i).take(at) for i in range(len(own))]
            yield pa.RecordBatch.from_arrays([*kept, *added], schema.names)

    return whole.select(*own, "x").mapInArrow(rows, schema)
