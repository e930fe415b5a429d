"""Whitening of vectors along the leading components of their covariance, found by spectrum slicing.

The number of eigenvalues of a symmetric matrix above a shift is the number of positive pivots in the LDLᵀ factors of the
shifted matrix (Sylvester's law of inertia). Counts at bisected shifts close an interval around each leading eigenvalue;
Rayleigh quotient iteration started within it converges cubically, and counts just below and above the result certify that
it is the one of its number. The covariance is summed by Spark over distinct integer vectors; the driver holds one square
matrix of the dimension, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newstide.llm.common import column, map_batches, matrix, usable_vector
from newstide.session import stage

STEPS, OFFSET = 64, 1_000_000
#: Steps of an entry beyond this are taken as this, so that sums of integers stay exact.
FARTHEST = 1 << 40


def positive_pivots(a: np.ndarray) -> int:
    """Eigenvalues above 0 of a symmetric matrix, by its LDLᵀ factors with pivots of one or two rows."""
    a = np.array(a, np.float64)
    n, k, above = len(a), 0, 0
    share = (1 + 17**0.5) / 8  # bounds the growth of entries
    while k < n:
        own = abs(a[k, k])
        below = np.abs(a[k + 1 :, k])
        far = float(below.max()) if len(below) else 0.0
        if own == 0.0 and far == 0.0:
            k += 1
            continue
        place, width = k, 1
        if own < share * far:
            r = k + 1 + int(below.argmax())
            line = np.abs(a[r, k:])
            line[r - k] = 0.0
            most = float(line.max())
            if own * most >= share * far * far:
                pass
            elif abs(a[r, r]) >= share * most:
                place = r
            else:
                place, width = r, 2
        to = k + width - 1
        if place != to:
            a[[to, place]] = a[[place, to]]
            a[:, [to, place]] = a[:, [place, to]]
        end = k + width
        if width == 1:
            above += a[k, k] > 0
            v = a[end:, k]
            a[end:, end:] -= np.outer(v / a[k, k], v)
        else:  # such a pivot has one eigenvalue of each sign
            above += 1
            b = a[end:, k:end]
            a[end:, end:] -= b @ np.linalg.solve(a[k:end, k:end], b.T)
        k = end
    return int(above)


class Uncertified(ArithmeticError):
    """Counts of eigenvalues do not confirm the number of a component."""


def leading(v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` greatest eigenvalues above rounding of the symmetric ``v``, falling, and their unit eigenvectors as rows.

    The greatest entry of a vector is positive. Eigenvalues that no shift can part are taken together: their vectors are
    an orthonormal basis, any of which serves.
    """
    d = len(v)
    size = float(np.abs(v).sum(1).max()) if d else 0.0
    if size == 0.0:
        return np.zeros(0), np.zeros((0, d))
    v = v / size
    blur = 4 * d * np.finfo(float).eps  # rounding of one factorisation
    eye = np.eye(d)
    counts: dict[float, int] = {}

    def above(shift: float) -> int:
        if shift not in counts:
            counts[shift] = positive_pivots(v - shift * eye)
        return counts[shift]

    values, vectors = [], np.zeros((0, d))
    for k in range(1, min(most, above(blur)) + 1):
        # Counts made for earlier components already narrow the interval.
        low = max((s for s, c in counts.items() if c >= k), default=blur)
        high = min((s for s, c in counts.items() if c < k), default=1 + blur)
        while True:
            while (above(low) > k or counts.get(high, 0) < k - 1) and high - low > 2 * blur:
                mid = (low + high) / 2
                low, high = (mid, high) if above(mid) >= k else (low, mid)
            value, x = _rayleigh(v, (low + high) / 2, vectors, k)
            off = blur + float(np.linalg.norm(v @ x - value * x))
            if off <= 64 * blur and above(value - 2 * off) >= k and above(value + 2 * off) < k:
                break
            if high - low <= 2 * blur:
                raise Uncertified(f"component {k}")
            mid = (low + high) / 2  # it ran off to another eigenvalue: start nearer
            low, high = (mid, high) if above(mid) >= k else (low, mid)
        values.append(value)
        vectors = np.vstack([vectors, x if x[np.abs(x).argmax()] > 0 else -x])
    return size * np.array(values), vectors


def _rayleigh(v: np.ndarray, shift: float, known: np.ndarray, seed: int) -> tuple[float, np.ndarray]:
    """Eigenvalue and vector that Rayleigh quotient iteration reaches from ``shift``, beside the ``known`` vectors."""
    d = len(v)
    x = np.random.default_rng(seed).standard_normal(d)
    eye = np.eye(d)

    def unit(y: np.ndarray) -> np.ndarray:
        y = y / np.abs(y).max()  # solutions close to an eigenvalue are very long
        y = y - known.T @ (known @ y)
        y = y - known.T @ (known @ y)
        return y / np.linalg.norm(y)

    x = unit(x)
    best, kept, off = shift, x, np.inf
    for step in range(30):
        try:
            x = unit(np.linalg.solve(v - shift * eye, x))
        except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last digit
            shift = float(np.nextafter(shift, np.inf)) + np.finfo(float).tiny
            continue
        value = float(x @ v @ x)
        left = float(np.linalg.norm(v @ x - value * x))
        if step > 4 and left >= off:
            break
        if left < off or step <= 4:
            best, kept, off = value, x, left
        if step > 1:  # two steps at the middle of the interval find the nearest vector first
            shift = value
    return best, kept


@dataclass(frozen=True)
class Whitening:
    """Fit over ``n`` distinct vectors of whole steps with the sums ``s``; components as rows, numbered by falling ``e``."""

    n: int
    s: list[int]
    e: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float


def steps(vec: Column) -> Column:
    """Whole steps of the entries of a vector."""
    far = F.lit(float(FARTHEST))
    return F.transform(vec, lambda c: F.floor(F.greatest(-far, F.least(far, c.cast("double") * STEPS))).cast("long") + OFFSET)


def usable_rows(rows: DataFrame, vec: str) -> DataFrame:
    """Rows with a vector that has a length, no null and only finite entries, and the length that most rows have.

    Of lengths that equally many rows have, the greatest counts.
    """
    good = rows.where(usable_vector(F.col(vec)))
    sizes = good.groupBy(F.size(vec).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return good.where(F.size(vec) == (sizes["d"] if sizes else 0))


def _summed(rows: DataFrame, of_batch, kind: str) -> dict[int, list]:
    """Sum over all rows of what ``of_batch`` makes of the matrix of a batch: an array of lines, collected by line.

    Each task adds up its own rows; lines of tasks are added up by Spark.
    """
    np_kind = np.int64 if kind == "long" else np.float64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = of_batch(matrix(batch, "x"))
                total = part if total is None else total + part
        if total is not None:
            values = pa.array(total.astype(np_kind).tolist(), pa.list_(pa.int64() if kind == "long" else pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), values], ["i", "line"])

    cells = map_batches(rows.select("x"), run, f"i int, line array<{kind}>").select("i", F.posexplode("line").alias("j", "value"))
    total = cells.groupBy("i", "j").agg(F.sum("value").alias("value"))
    lines = total.groupBy("i").agg(F.sort_array(F.collect_list(F.struct("j", "value"))).alias("line"))  # one line: the dimension
    return {r["i"]: [c["value"] for c in r["line"]] for r in lines.collect()}


def fit(rows: DataFrame, vec: str = "embedding", components: int = 16) -> Whitening | None:
    """Fit on each distinct vector of whole steps once; None where there is no usable row.

    Every covariance has the divisor ``n`` and is centred before multiplying. Components whose eigenvalue is no more than
    rounding (fewer distinct vectors than dimensions, constant entries) are left out.
    """
    good = usable_rows(rows, vec)
    distinct = stage(good.select(steps(F.col(vec)).alias("x")).distinct(), "fit-list")
    n = distinct.count()
    if not n:
        return None
    s = [int(x) for x in _summed(distinct, lambda x: x.sum(0)[None, :], "long")[0]]
    # The mean in whole steps and the rest apart, so that centring loses nothing.
    whole, rest = np.array([x // n for x in s], np.int64), np.array([x % n / n for x in s])

    def cross(x: np.ndarray) -> np.ndarray:
        c = (x - whole).astype(np.float64) - rest
        return c.T @ c

    lines = _summed(distinct, cross, "double")
    v = np.array([lines[i] for i in range(len(s))]) / n
    v = (v + v.T) / 2
    e, vectors = leading(v, components)
    error = 0.0
    if len(e):
        scale = vectors.T / np.sqrt(e)

        def whitened_cross(x: np.ndarray) -> np.ndarray:
            y = ((x - whole).astype(np.float64) - rest) @ scale
            return y.T @ y

        lines = _summed(distinct, whitened_cross, "double")
        error = float(np.abs(np.array([lines[i] for i in range(len(e))]) / n - np.eye(len(e))).max())
    return Whitening(n, s, e, vectors, float(np.trace(v)), error)


def squared_distance(x: np.ndarray, n: int, s: list[int]) -> list[int | None]:
    """Exact sum of (n*x-s)^2 per row; None where it does not fit a long."""
    limit = (1 << 63) - 1
    about = ((n * x.astype(np.float64) - np.array(s, np.float64)) ** 2).sum(1)
    near = np.abs(x).astype(np.float64).max() * n
    if about.max() < 2**62 and near < 2**62:
        return ((n * x - np.array(s, np.int64)) ** 2).sum(1).tolist()
    exact = [sum((n * a - b) ** 2 for a, b in zip(line, s, strict=True)) for line in x.tolist()]
    return [value if value <= limit else None for value in exact]


def whiten(rows: DataFrame, model: Whitening | None, vec: str = "embedding", key: str = "vec_id") -> DataFrame:
    """A row per usable row and component: key, component, n, deviation, whitened, explained, identity_error.

    Rows whose vector is null or empty, or has null or non-finite entries or another length than the fit, are left out;
    repeated rows are repeated and a null key is kept. Without a fit, or without components, the result is empty.
    ``deviation`` is exact, and null where it is beyond the range of a long. Other columns are not read.
    """
    kind = rows.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None or not len(model.e):
        return rows.sparkSession.createDataFrame([], schema)
    n, s, k = model.n, model.s, len(model.e)
    whole, rest = np.array([x // n for x in s], np.int64), np.array([x % n / n for x in s])
    scale, explained, error = model.vectors.T / np.sqrt(model.e), model.e / model.trace, model.identity_error

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch, "x")
            y = ((x - whole).astype(np.float64) - rest) @ scale
            m = len(x)
            at = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [
                    column(batch, key).take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)),
                    pa.array(squared_distance(x, n, s), pa.int64()).take(at), pa.array(y.ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error)),
                ],
                [key, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    good = rows.where(usable_vector(F.col(vec)) & (F.size(vec) == len(s)))
    return map_batches(good.select(key, steps(F.col(vec)).alias("x")), run, schema)
