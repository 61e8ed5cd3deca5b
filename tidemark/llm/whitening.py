"""Whitening of embeddings by spectrum slicing of their covariance.

Three passes over the vectors, each one Arrow pass with partial sums that Spark adds up:
sums, centred products, and the whitened rows themselves. Entries are whole numbers, and so
are all sums, so the covariance does not depend on how Spark deals the rows.

Between the passes the driver holds the d x d covariance V, nothing that grows with the
rows. The LDL' factorisation of V - s I has as many positive pivots as V has eigenvalues
above s (Sylvester's law of inertia), so counting pivots bisects the spectrum until an
interval holds one eigenvalue; Rayleigh quotient iteration then converges cubically in it,
and two more counts, just below and above the value found, certify its number. Eigenvalues
too close to be told apart in double precision are taken as one: any orthonormal vectors of
their common space are their components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
WHITENED_SCHEMA = "vec_id long, component int, n long, deviation long, whitened double"
_EXACT = 1 << 53  # whole numbers below are exact in a double
_LONG = 1 << 63


def whole_vectors(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """``vec_id`` and ``x``, the vector's entries as ``floor(1024 c) + 100000``. Rows whose
    vector is null or empty or holds null or non-finite entries, or entries whose whole
    number a long can't hold, take no part."""
    e = F.col(column).cast("array<double>")
    bad = F.exists(e, lambda c: F.coalesce(F.isnan(c) | (F.abs(c) >= F.lit(float(1 << 52))), F.lit(True)))
    return (vectors.filter(e.isNotNull() & (F.size(e) > 0) & ~bad)
            .select(F.col("vec_id").cast("long").alias("vec_id"),
                    F.transform(e, lambda c: F.floor(c * float(SCALE)) + SHIFT).alias("x")))


def matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def exact_products(z: np.ndarray) -> np.ndarray:
    """``z' z`` of whole numbers, exact: in doubles, in parts small enough for them, and for
    entries too large for that in Python's numbers."""
    top = int(np.abs(z).max(initial=0))
    rows = _EXACT // max(top * top, 1)
    if not rows:
        z = z.astype(object)
        return z.T @ z
    total = np.zeros((z.shape[1], z.shape[1]), object)
    for at in range(0, len(z), rows):
        part = z[at:at + rows].astype(np.float64)
        total += (part.T @ part).astype(np.int64)
    return total


def _summed(x: DataFrame, part: Callable[[np.ndarray], np.ndarray], length: int) -> list[int]:
    """The sum over all rows of ``part``'s whole numbers, ``length`` of them; each task adds
    up its own, Spark those of the tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if len(b):
                p = part(matrix(b.column(0)))
                total = p if total is None else total + p
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(length), pa.int32()), pa.array([str(v) for v in total.ravel()])], names=["i", "v"])

    sums = x.select("x").mapInArrow(run, "i int, v string").groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    values = [0] * length
    for r in sums.collect():  # one row a matrix entry
        values[r["i"]] = int(r["v"])
    return values


def fit(x: DataFrame) -> tuple[int, list[int], np.ndarray]:
    """``n``, the sums S per dimension, and the covariance (divisor n) of all vectors.

    Entries are centred at the whole number next to their mean before they are multiplied;
    what that number is off the mean is taken out exactly, in whole numbers. So each entry
    of the covariance is the true one, rounded once."""
    least, dims = x.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    if dims is None:
        return 0, [], np.zeros((0, 0))
    if least < dims:
        raise ValueError("the vectors are not of one length")

    def count_and_sums(m: np.ndarray) -> np.ndarray:
        small = int(np.abs(m).max()) < _LONG // len(m)
        return np.append(np.array([len(m)], object), (m if small else m.astype(object)).sum(axis=0).astype(object))

    n, *sums = _summed(x, count_and_sums, dims + 1)
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    products = _summed(x, lambda m: exact_products(m - centre), dims * dims)
    off = [s - n * int(c) for s, c in zip(sums, centre, strict=True)]
    v = [float(Fraction(n * p - off[i // dims] * off[i % dims], n * n)) for i, p in enumerate(products)]
    return n, sums, np.array(v).reshape(dims, dims)


def count_above(v: np.ndarray, shift: float) -> int:
    """Eigenvalues of the symmetric ``v`` above ``shift``: the positive pivots of LDL' of
    ``v - shift I``, with the largest pivot of one or two rows chosen each time."""
    a = v - shift * np.eye(len(v))
    alpha, positive, n = (1 + 17 ** 0.5) / 8, 0, len(v)
    while n:
        diagonal = np.abs(np.diagonal(a))
        off = np.abs(a)
        np.fill_diagonal(off, 0)
        d, o = int(diagonal.argmax()), int(off.argmax())
        if diagonal[d] == off.flat[o] == 0:
            break
        if diagonal[d] >= alpha * off.flat[o]:
            keep = np.delete(np.arange(n), d)
            pivot, column = a[d, d], a[keep, d]
            positive += pivot > 0
            a = a[np.ix_(keep, keep)] - np.outer(column, column / pivot)
            n -= 1
        else:  # a pivot of two rows has one eigenvalue of either sign
            pair = list(divmod(o, n))
            keep = np.delete(np.arange(n), pair)
            block, column = a[np.ix_(pair, pair)], a[np.ix_(keep, pair)]
            positive += 1
            a = a[np.ix_(keep, keep)] - column @ np.linalg.solve(block, column.T)
            n -= 2
    return int(positive)


def _eigenpair(v: np.ndarray, low: float, high: float, i: int, tiny: float, found: np.ndarray, rng: np.random.Generator) -> tuple[float, np.ndarray]:
    """The eigenpair number ``i`` (from 0), its value between ``low`` and ``high`` and its
    vector orthogonal to those ``found``. Inverse iteration at the middle brings a vector
    near, its Rayleigh quotients as shifts then converge cubically. Where they lead out of
    the interval, to a neighbour's value, a count halves it and the next middle is nearer."""
    def project(y: np.ndarray) -> np.ndarray:
        for _ in range(2):
            y = y - found @ (found.T @ y)
        return y / np.linalg.norm(y)

    def solve(shift: float, y: np.ndarray) -> np.ndarray:
        try:
            y = np.linalg.solve(v - shift * np.eye(len(v)), y)
        except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last bit
            y = np.linalg.solve(v - (shift + tiny / 4) * np.eye(len(v)), y)
        return project(y)

    while True:
        shift, best, pair = (low + high) / 2, np.inf, None
        y = project(rng.standard_normal(len(v)))
        for step in range(30):
            y = solve(shift, y)
            value = float(y @ v @ y)
            if not low <= value <= high:
                break
            off = float(np.linalg.norm(v @ y - value * y))
            if off < best / 2:
                best, pair = off, (value, y)
            elif best <= tiny:
                return pair
            if step:
                shift = value
        if high - low <= tiny / 4:  # one of several values that can't be told apart
            for _ in range(4):
                y = solve(shift, y)
            return float(y @ v @ y), y
        middle = (low + high) / 2
        low, high = (middle, high) if count_above(v, middle) > i else (low, middle)


def leading_components(v: np.ndarray, k: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The up to ``k`` largest eigenvalues, falling, and their unit vectors as columns.
    Values that are zero to double precision have no component: they can't be whitened."""
    size = float(np.abs(v).sum(axis=1).max(initial=0))  # no eigenvalue is larger
    tiny = size * len(v) * 2.0 ** -50
    rng = np.random.default_rng(0)
    values, vectors = [], np.zeros((len(v), 0))
    k = min(k, count_above(v, tiny)) if size else 0
    for i in range(k):  # as many eigenvalues are above the one sought
        low, high = tiny, (values[-1] if values else size) + tiny
        above_low, above_high = count_above(v, low), count_above(v, high)
        while (above_high < i or above_low > i + 1) and high - low > tiny / 4:
            middle = (low + high) / 2
            count = count_above(v, middle)
            if count > i:
                low, above_low = middle, count
            else:
                high, above_high = middle, count
        value, y = _eigenpair(v, low, high, i, tiny, vectors, rng)
        if not count_above(v, value + 4 * tiny) <= i < count_above(v, value - 4 * tiny):
            raise ArithmeticError(f"the counts do not certify eigenvalue {i + 1}")
        values.append(value)
        vectors = np.column_stack([vectors, y])
    order = np.argsort(values, kind="stable")[::-1]
    return np.array(values)[order], vectors[:, order]


def whitened_rows(x: DataFrame, n: int, sums: list[int], values: np.ndarray, vectors: np.ndarray) -> DataFrame:
    """A row for each vector and component: the exact squared deviation from the mean, as
    ``sum (n x - S)^2`` (null if a long can't hold it), and the whitened coordinate."""
    weights = vectors / np.sqrt(values)
    k = len(values)
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.array(sums, object)
        for b in batches:
            m = matrix(b.column(1)) if len(b) else np.zeros((0, len(sums)), np.int64)
            top = n * int(np.abs(m).max(initial=0)) + max(map(abs, sums))
            d = n * m - total.astype(np.int64) if top < _LONG else n * m.astype(object) - total
            top = int(np.abs(d).max(initial=0))
            if top * top * d.shape[1] < _LONG:
                deviation = pa.array((d * d).sum(axis=1))
            else:
                exact = (d.astype(object) ** 2).sum(axis=1)
                deviation = pa.array([int(e) if e < _LONG else None for e in exact], pa.int64())
            w = (d.astype(np.float64) / n) @ weights
            rows = pa.array(np.repeat(np.arange(len(b)), k))
            columns = [b.column(0).take(rows), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(b))),
                       pa.array(np.full(len(b) * k, n)), deviation.take(rows), pa.array(w.ravel())]
            yield pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(columns, types, strict=True)], names=["vec_id", "component", "n", "deviation", "whitened"])

    return x.mapInArrow(run, WHITENED_SCHEMA)


def identity_error(x: DataFrame, n: int, sums: list[int], values: np.ndarray, vectors: np.ndarray) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, measured
    on the rows: centred at their own mean, divisor n."""
    weights, k, mean = vectors / np.sqrt(values), len(values), np.array([float(Fraction(s, n)) for s in sums])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, products = np.zeros(k), np.zeros((k, k))
        for b in batches:
            if len(b):
                w = (matrix(b.column(0)) - mean) @ weights
                total, products = total + w.sum(axis=0), products + w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k * k + k, dtype=np.int32)), pa.array(np.concatenate([products.ravel(), total]))], names=["i", "v"])

    rows = x.select("x").mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    got = np.zeros(k * k + k)
    for r in rows:
        got[r["i"]] = r["v"]
    mean_w = got[k * k:] / n
    return float(np.abs(got[:k * k].reshape(k, k) / n - np.outer(mean_w, mean_w) - np.eye(k)).max())


def whiten(vectors: DataFrame, k: int = COMPONENTS, column: str = "embedding") -> DataFrame:
    """The whitened coordinates of every vector on the ``k`` leading components.

    Rows that :func:`whole_vectors` drops give none. Vectors must have one length; else the
    fit fails with a ValueError. Equal rows are fitted and returned as often as they occur,
    a null ``vec_id`` stays null, an empty table gives no rows. There are as many components
    as ``k``, the dimensions and the rank of the covariance allow: none for a single vector
    or equal vectors. Equal eigenvalues are numbered in any order. Other columns are not
    read.
    """
    x = whole_vectors(vectors, column)
    n, sums, v = fit(x)
    values, axes = leading_components(v, k)
    if not len(values):
        return x.limit(0).selectExpr("vec_id", "cast(null as int) component", "cast(null as long) n", "cast(null as long) deviation",
                                     "cast(null as double) whitened", "cast(null as double) explained", "cast(null as double) identity_error")
    error = identity_error(x, n, sums, values, axes)
    explained = F.element_at(F.array(*[F.lit(float(e)) for e in values / np.trace(v)]), F.col("component"))
    return whitened_rows(x, n, sums, values, axes).withColumn("explained", explained).withColumn("identity_error", F.lit(error))
