"""Embedding whitening by spectrum slicing.

A component c of a vector becomes the integer x = floor(scale * c) + shift.  The
fit list holds every distinct integer vector once.  Its count, its sums and, in a
second pass around the integer next to each mean, its products are exact
integers, summed by task and then in Spark; one matrix of the size of the
vectors' dimension squared reaches the driver, whatever the number of rows.

Leading eigenvalues of the covariance V are isolated by inertia: the number of
negative pivots of the symmetric factorisation LDL' of V - s*I is the number of
eigenvalues below s, so bisection of s finds an interval with one eigenvalue and
its number.  Inverse iteration starts and Rayleigh quotient iteration, which
converges cubically, ends inside that interval; two more counts on either side
of the result certify its number.  Eigenvalues that agree to rounding share an
interval; any orthonormal basis of their space is then a right answer.

Defined results: rows whose vector is null or holds null or non-finite entries
take no part, nor do vectors of another length than the commonest (the longer of
two).  Scaled entries beyond 2**40 count as that.  Repeated rows, equal vectors
and null ids are scored each for itself.  Components whose eigenvalue is zero to
rounding (fewer distinct vectors than dimensions, constant dimensions) are left
out, so an empty table, one distinct vector or vectors without entries give no
rows.  ``deviation`` is null where it exceeds a long.  All columns are kept,
whatever their names.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from .common import bounded_batches, save

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
MOST = 1 << 40
EPS = np.finfo(float).eps


# --- spectrum slicing ------------------------------------------------------------


def negative_pivots(a: np.ndarray) -> int:
    """How many eigenvalues of a symmetric matrix are below zero: the negative
    pivots of LDL' with 1x1 and 2x2 blocks (partial diagonal pivoting)."""
    a, n, k, negative = a.copy(), len(a), 0, 0
    bound = (1 + math.sqrt(17)) / 8

    def swap(i, j):
        a[[i, j], k:] = a[[j, i], k:]
        a[k:, [i, j]] = a[k:, [j, i]]

    while k < n:
        size = 1
        if k + 1 < n:
            column = np.abs(a[k + 1:, k])
            r = int(column.argmax()) + k + 1
            most, own = column[r - k - 1], abs(a[k, k])
            if own < bound * most:
                row = np.abs(a[r, k:])
                row[r - k] = 0
                if own * row.max() < bound * most * most:
                    if abs(a[r, r]) >= bound * row.max():
                        swap(k, r)
                    else:
                        swap(k + 1, r)
                        size = 2
        rest = slice(k + size, n)
        pivot = a[k:k + size, k:k + size]
        if size == 1:
            negative += int(pivot[0, 0] < 0)
            if pivot[0, 0] != 0:
                a[rest, rest] -= np.outer(a[rest, k], a[k, rest] / pivot[0, 0])
        else:  # such a block has one pivot of each sign
            negative += 1
            a[rest, rest] -= a[rest, k:k + 2] @ np.linalg.solve(pivot, a[k:k + 2, rest])
        k += size
    return negative


class Spectrum:
    """Leading eigenpairs of a symmetric non-negative matrix, by falling value."""

    def __init__(self, v: np.ndarray):
        self.v, self.n = v, len(v)
        self.trace = float(np.trace(v))
        self.least = 4 * self.n * EPS * self.trace  # eigenvalues up to here are zero
        self.random = np.random.default_rng(0)
        self.counted: dict[float, int] = {}

    def above(self, s: float) -> int:
        """How many eigenvalues are ``s`` or more."""
        if s not in self.counted:
            self.counted[s] = self.n - negative_pivots(self.v - s * np.eye(self.n))
        return self.counted[s]

    def _isolate(self, number: int) -> tuple[float, float]:
        """(lo, hi) with ``above(lo) >= number > above(hi)``: one eigenvalue, or
        an interval as narrow as rounding allows."""
        known = sorted(s for s in self.counted if self.counted[s] < number)
        lo, hi = self.least, known[0]
        lo = max([s for s in self.counted if self.counted[s] >= number], default=lo)
        while self.above(lo) - self.above(hi) > 1 and hi - lo > self.least:
            lo, hi = self._halve(lo, hi, number)
        return lo, hi

    def _halve(self, lo: float, hi: float, number: int) -> tuple[float, float]:
        mid = (lo + hi) / 2
        return (mid, hi) if self.above(mid) >= number else (lo, mid)

    def _solve(self, s: float, x: np.ndarray) -> np.ndarray:
        for nudge in (0.0, self.least, 8 * self.least):
            try:
                y = np.linalg.solve(self.v - (s + nudge) * np.eye(self.n), x)
            except np.linalg.LinAlgError:
                continue
            if np.isfinite(y).all():
                return y
        return x

    def _clear(self, x: np.ndarray, found: list[np.ndarray]) -> np.ndarray:
        """``x`` made orthonormal, and orthogonal to what was found."""
        x = x.reshape(self.n, -1)
        for _ in range(2):
            if found:
                known = np.array(found)
                x = x - known.T @ (known @ x)
            x, _ = np.linalg.qr(x)
        return x

    def _single(self, lo: float, hi: float, number: int, found: list[np.ndarray]) -> np.ndarray | None:
        """Rayleigh quotient iteration inside an interval with one eigenvalue."""
        while hi - lo > self.least:
            x = self._clear(self.random.standard_normal(self.n), found)[:, 0]
            for _ in range(2):
                x = self._clear(self._solve((lo + hi) / 2, x), found)[:, 0]
            quotient = float(x @ self.v @ x)
            for _ in range(12):
                if not lo <= quotient <= hi:
                    break
                error = np.linalg.norm(self.v @ x - quotient * x)
                if error <= self.least / 4 and self._certified(quotient, error, number):
                    y = self._solve(quotient, x)  # one more step at full precision
                    y = self._clear(y, found)[:, 0]
                    return y if lo <= y @ self.v @ y <= hi else x
                x = self._clear(self._solve(quotient, x), found)[:, 0]
                quotient = float(x @ self.v @ x)
            lo, hi = self._halve(lo, hi, number)
        return None

    def _certified(self, value: float, error: float, number: int) -> bool:
        margin = max(2 * error, self.least)
        return self.above(value - margin) >= number > self.above(value + margin)

    def _cluster(self, lo: float, hi: float, size: int, found: list[np.ndarray]) -> list[np.ndarray]:
        """An orthonormal basis for eigenvalues that agree to rounding."""
        x = self._clear(self.random.standard_normal((self.n, size)), found)
        for _ in range(4):
            x = self._clear(self._solve((lo + hi) / 2 + self.least / 8, x), found)
        _, turn = np.linalg.eigh(x.T @ self.v @ x)
        return list((x @ turn[:, ::-1]).T)

    def leading(self, count: int) -> tuple[np.ndarray, np.ndarray]:
        """(eigenvalues, unit eigenvectors as rows), at most ``count``, none zero."""
        found: list[np.ndarray] = []
        if self.n and self.trace > 0:
            self.above(self.trace * 1.001)
            count = min(count, self.above(self.least))
            while len(found) < count:
                number = len(found) + 1
                lo, hi = self._isolate(number)
                several = self.above(lo) - self.above(hi)
                one = self._single(lo, hi, number, found) if several == 1 else None
                found += [one] if one is not None else self._cluster(lo, hi, several, found)
        vectors = np.array(found[:count]).reshape(-1, self.n)
        return np.array([x @ self.v @ x for x in vectors]), vectors


# --- exact sums ------------------------------------------------------------------


def usable(vector: Column) -> Column:
    """Not null, and all entries finite numbers."""
    return vector.isNotNull() & F.forall(
        vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))


def integers(column, scale: int) -> np.ndarray:
    """floor(scale * c) of an Arrow list column, one row a vector."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(over="ignore"):
        scaled = np.clip(np.floor(scale * flat), -MOST, MOST)
    return scaled.astype(np.int64).reshape(len(column), -1)


def _keys(scale: int):
    """Each vector as bytes, every entry as narrow as the largest one allows."""
    def run(batches):
        for batch in batches:
            rows = integers(batch.column("vector"), scale)
            width = np.searchsorted([1 << 7, 1 << 15, 1 << 31], np.abs(rows).max(axis=1, initial=0), "right")
            narrow = [rows.astype(f"<i{1 << w}", casting="unsafe") for w in range(4)]
            keys = [bytes([w]) + narrow[w][k].tobytes() for k, w in enumerate(width.tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary())], names=["key"])
    return run


def _vectors(batch, dimension: int) -> np.ndarray:
    rows = [np.frombuffer(k, f"<i{1 << k[0]}", offset=1) for k in batch.column("key").to_pylist()]
    return np.array(rows, np.int64).reshape(-1, dimension)


def _sums(dimension: int):
    """Number and sums of the vectors of a task, as (i, j, high, low)."""
    def run(batches):
        n, total = 0, np.zeros(dimension, object)
        for batch in batches:
            rows = _vectors(batch, dimension)
            n, total = n + len(rows), total + rows.sum(axis=0).astype(object)
        yield _entries([(-1, -1, n), *((i, -1, int(x)) for i, x in enumerate(total))])
    return run


def _products(dimension: int, centre: list[int]):
    """Exact sums of products of the centred vectors of a task."""
    middle = np.array(centre, np.int64)

    def run(batches):
        total = np.zeros((dimension, dimension), object)
        for batch in batches:
            rows = _vectors(batch, dimension) - middle
            most = int(np.abs(rows).max(initial=0))
            if len(rows) * most * most < 1 << 53:  # then sums of doubles are exact
                doubles = rows.astype(np.float64)
                total += (doubles.T @ doubles).astype(np.int64)
            else:
                total += rows.T.astype(object) @ rows.astype(object)
        yield _entries([(i, j, int(total[i, j])) for i in range(dimension) for j in range(i, dimension)])
    return run


_ENTRY = "i int, j int, high long, low long"


def _entries(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*((i, j, v >> 32, v & 0xFFFFFFFF) for i, j, v in rows), strict=True))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int64(), pa.int64()), strict=True)],
        names=["i", "j", "high", "low"])


def _added(entries: DataFrame) -> dict[tuple[int, int], int]:
    """Entries summed over all tasks: as many as the matrix has."""
    wide = "decimal(38,0)"
    rows = entries.groupBy("i", "j").agg(F.sum(F.col("high").cast(wide)).alias("high"),
                                         F.sum(F.col("low").cast(wide)).alias("low")).collect()
    return {(r.i, r.j): (int(r.high) << 32) + int(r.low) for r in rows}


# --- the operator ----------------------------------------------------------------


@dataclass
class Whitening:
    """A fitted model: plain arrays of the vectors' dimension."""
    scale: int
    shift: int
    n: int
    sums: list[int]  # of floor(scale * c) over the fit list, without the shift
    eigenvalues: np.ndarray
    components: np.ndarray  # unit rows
    explained: list[float]
    identity_error: float = 0.0

    @property
    def dimension(self) -> int:
        return len(self.sums)

    def project(self, rows: np.ndarray) -> np.ndarray:
        """Whitened values of integer vectors (without the shift)."""
        centre = np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], np.int64)
        rest = np.array([(s - self.n * int(c)) / self.n for s, c in zip(self.sums, centre, strict=True)])
        return ((rows - centre) - rest) @ (self.components / np.sqrt(self.eigenvalues)[:, None]).T

    def deviations(self, rows: np.ndarray) -> list[int | None]:
        """Exact sums of (n * x - sum)**2; the shift falls out."""
        sums = np.array(self.sums, object)
        bound = max(int(np.abs(rows).max(initial=0)) * self.n + max((abs(s) for s in self.sums), default=0), 1)
        if bound * bound * max(self.dimension, 1) < 1 << 62:
            return ((rows * self.n - sums.astype(np.int64)) ** 2).sum(axis=1).tolist()
        exact = [sum((self.n * int(x) - s) ** 2 for x, s in zip(row, self.sums, strict=True)) for row in rows]
        return [x if x < 1 << 63 else None for x in exact]


def _moments(model: Whitening):
    def run(batches):
        k = len(model.eigenvalues)
        total = np.zeros((k + 1, k + 1))
        for batch in batches:
            z = model.project(_vectors(batch, model.dimension))
            z = np.hstack([z, np.ones((len(z), 1))])
            total += z.T @ z
        at = [(i, j, float(total[i, j])) for i in range(k + 1) for j in range(k + 1)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*at, strict=True)], names=["i", "j", "v"])
    return run


def fit(rows: DataFrame, column: str = "embedding", components: int = COMPONENTS,
        scale: int = SCALE, shift: int = SHIFT) -> Whitening | None:
    """The whitening of the distinct integer vectors; None without any."""
    bounded_batches(rows.sparkSession)
    vectors = rows.where(usable(F.col(column))).select(F.col(column).cast("array<double>").alias("vector"))
    commonest = vectors.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if commonest is None or commonest["d"] == 0:
        return None
    d = commonest["d"]
    distinct = save(vectors.where(F.size("vector") == d).mapInArrow(_keys(scale), "key binary").dropDuplicates(["key"]),
                    "vectors")
    first = _added(distinct.mapInArrow(_sums(d), _ENTRY))
    n, sums = first[-1, -1], [first[i, -1] for i in range(d)]
    centre = [(2 * s + n) // (2 * n) for s in sums]
    products = _added(distinct.mapInArrow(_products(d, centre), _ENTRY))
    rest = [s - n * c for s, c in zip(sums, centre, strict=True)]  # what the integer centre leaves, exact
    v = np.array([[(n * products[min(i, j), max(i, j)] - rest[i] * rest[j]) / (n * n) for j in range(d)] for i in range(d)])
    values, parts = Spectrum(v).leading(components)
    trace = float(np.trace(v))
    model = Whitening(scale, shift, n, sums, values, parts, [float(x) / trace for x in values])
    if len(values):
        moments = distinct.mapInArrow(_moments(model), "i long, j long, v double")
        at = {(r.i, r.j): r.v for r in moments.groupBy("i", "j").agg(F.sum("v").alias("v")).collect()}
        k = len(values)
        model.identity_error = max(abs(at[i, j] / n - at[i, k] / n * at[j, k] / n - (i == j))
                                   for i in range(k) for j in range(k))
    return model


def _apply(model: Whitening, width: int):
    def run(batches):
        names = [f"_{i}" for i in range(width)]
        for batch in batches:
            rows = integers(batch.column("vector"), model.scale).reshape(-1, model.dimension)
            z = pa.array(list(model.project(rows)), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(model.deviations(rows), pa.int64()), z],
                names=[*names, "_deviation", "_whitened"])
    return run


def whiten(rows: DataFrame, column: str = "embedding", components: int = COMPONENTS, scale: int = SCALE,
           shift: int = SHIFT) -> DataFrame:
    """One row for each usable row and component: the columns of ``rows``, then
    component, n, deviation, whitened, explained and identity_error."""
    model = fit(rows, column, components, scale, shift)
    names, width = rows.columns, len(rows.columns)
    added = ["component", "n", "deviation", "whitened", "explained", "identity_error"]
    plain = rows.select(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(names)])
    at = F.col(f"_{names.index(column)}")
    if model is None or not len(model.eigenvalues):
        kinds = ("int", "long", "long", "double", "double", "double")
        empty = plain.where(F.lit(False)).select("*", *[F.lit(None).cast(k).alias(f"_{a}") for a, k in zip(added, kinds, strict=True)])
        return empty.toDF(*names, *added)
    kept = plain.where(usable(at) & (F.size(at) == model.dimension)).withColumn("vector", at.cast("array<double>"))
    fields = [StructField(f"_{i}", f.dataType) for i, f in enumerate(rows.schema)]
    scored = kept.mapInArrow(_apply(model, width), StructType([
        *fields, StructField("_deviation", LongType()), StructField("_whitened", ArrayType(DoubleType()))]))
    own = [f"_{i}" for i in range(width)]
    out = scored.select(*own, "_deviation", F.posexplode("_whitened").alias("_at", "_value"))
    share = F.element_at(F.lit(model.explained).cast("array<double>"), F.col("_at") + 1)
    return out.select(
        *own, (F.col("_at") + 1).alias("_component"), F.lit(model.n).cast("long").alias("_n"), "_deviation",
        F.col("_value").alias("_whitened"), share.alias("_explained"),
        F.lit(model.identity_error).alias("_error")).toDF(*names, *added)
