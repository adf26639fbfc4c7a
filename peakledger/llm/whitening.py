"""Whitening of embeddings: leading eigenvectors of their covariance by contour integration, checked by inertia counts.

Spark sums the data: integer sums per dimension, then products of centred entries, one small matrix per task, added up over a few rounds.
What reaches the driver are matrices of dimension x dimension. There FEAST takes over: the resolvent of the covariance, integrated by
quadrature around an interval of the spectrum, projects random vectors onto the eigenvectors inside; Rayleigh-Ritz extracts them; the
inertia of two shifted factorisations says how many eigenvalues the interval holds, so that none is missed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.shipping import by_value

COMPONENTS = 8
#: Entries become floor(SCALE * entry) + SHIFT.
SCALE = 1024
SHIFT = 100_000
#: Entries whose scaled value no long can hold are treated as not finite.
LARGEST = float(1 << 61)
#: Quadrature nodes on the upper half of the contour.
NODES = 12
ROUNDS = 60
#: Residual, relative to a bound of the largest eigenvalue, that ends the iteration.
TOLERANCE = 1e-16
#: Smaller eigenvalues, relative to that bound, count as zero. The factor an interval spans, and its ends' distance from eigenvalues.
FLOOR = 1e-13
SPAN = 4
MARGIN = 1e-7
#: Matrices that one task adds up at a time.
FAN = 64


def inertia(matrix: np.ndarray) -> int:
    """How many eigenvalues of a symmetric matrix are above zero, by a factorisation with pivots of one and two rows."""
    a, above = matrix.copy(), 0
    alpha = (1 + math.sqrt(17)) / 8
    while len(a):
        n = len(a)
        off = np.abs(a - np.diag(np.diag(a)))
        diagonal = np.abs(np.diag(a))
        k = int(diagonal.argmax())
        largest = off.max() if n > 1 else 0.0
        if max(diagonal[k], largest) == 0:
            return above
        if diagonal[k] >= alpha * largest:
            rows = [k]
            above += a[k, k] > 0
        else:
            rows = [int(i) for i in np.unravel_index(off.argmax(), off.shape)]
            above += 1  # such a pivot has one eigenvalue on either side of zero
        keep = np.setdiff1d(np.arange(n), rows)
        left = a[np.ix_(keep, rows)]
        a = a[np.ix_(keep, keep)] - left @ np.linalg.solve(a[np.ix_(rows, rows)], left.T)
    return above


def _above(v: np.ndarray, shift: float) -> int:
    return inertia(v - shift * np.eye(len(v)))


def _clear(v: np.ndarray, shift: float, by: float) -> tuple[float, int]:
    """A shift near the given one that no eigenvalue is next to, and how many are above it."""
    for _ in range(20):
        count = _above(v, shift * (1 - MARGIN))
        if count == _above(v, shift * (1 + MARGIN)):
            break
        shift *= by
    return shift, count


def slices(v: np.ndarray, wanted: int, top: float) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues inside), from the highest: intervals that hold the `wanted` largest eigenvalues above FLOOR, and few more.

    An interval spans a factor, so that small eigenvalues stand as clear inside theirs as large ones do.
    """
    low, high = FLOOR * top, top * (1 + 1e-3)
    many = _above(v, low)
    least = min(wanted, many)
    while many > least + 4 and high > low * (1 + 1e-6):
        mid = math.sqrt(low * high)
        count = _above(v, mid)
        low, high, many = (mid, high, count) if count >= least else (low, mid, many)
    if not many:
        return []
    low, many = _clear(v, low, 0.97)
    out = []
    while many:
        high, beyond = _clear(v, low * SPAN, 1.03) if low * SPAN < top else (top * (1 + 1e-3), 0)
        if many > beyond:
            out.append((low, high, many - beyond))
        low, many = high, beyond
    return out[::-1]


def _inside(v: np.ndarray, low: float, high: float, many: int, top: float, pick: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """The `many` eigenvalues between low and high, and their unit eigenvectors as columns."""
    size = len(v)
    centre, radius = (low + high) / 2, (high - low) / 2
    x, w = np.polynomial.legendre.leggauss(NODES)
    turn = radius * np.exp(1j * np.pi * (1 + x) / 2)
    resolvents = [np.linalg.inv((centre + z) * np.eye(size) - v) for z in turn]
    q = np.linalg.qr(pick.standard_normal((size, min(size, 2 * many + 8))))[0]
    best = np.inf
    for _ in range(ROUNDS):
        projected = sum((weight * z / 2 * (r @ q)).real for weight, z, r in zip(w, turn, resolvents))
        basis = np.linalg.qr(projected)[0]
        small = basis.T @ v @ basis
        values, around = np.linalg.eigh((small + small.T) / 2)
        q = basis @ around
        inside = np.flatnonzero((values > low) & (values < high))
        apart = np.abs(v @ q[:, inside] - q[:, inside] * values[inside]).max(axis=0) if len(inside) else np.empty(0)
        sure = inside[np.argsort(apart)[:many]]  # values that are not of the matrix keep a residual
        worst = float(np.sort(apart)[:many].max()) / top if len(inside) >= many else np.inf
        if len(inside) < many and q.shape[1] < size:  # the count says that some are missed: more room
            q = np.linalg.qr(np.hstack([q, pick.standard_normal((size, min(size - q.shape[1], many + 4)))]))[0]
        elif worst <= TOLERANCE or best / 2 <= worst <= 1e3 * TOLERANCE:
            break
        best = min(best, worst)
    return values[sure], q[:, sure]


def feast(v: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) of a covariance, falling, `wanted` of them.

    Eigenvalues that rounding hides, below FLOOR of a bound of the largest, are zero, with any vectors that complete the others.
    """
    top = float(np.abs(v).sum(axis=1).max())  # no eigenvalue is larger
    pick = np.random.default_rng(0)
    found = [_inside(v, low, high, many, top, pick) for low, high, many in slices(v, wanted, top)] if top > 0 else []
    values = np.concatenate([x for x, _ in found] or [np.empty(0)])
    vectors = np.hstack([q for _, q in found] or [np.empty((len(v), 0))])
    order = np.argsort(-values)[:wanted]
    values, vectors = values[order], vectors[:, order]
    if len(values) < wanted:
        rest = np.linalg.qr(np.hstack([vectors, pick.standard_normal((len(v), wanted - len(values)))]))[0][:, len(values):]
        values, vectors = np.r_[values, np.zeros(wanted - len(values))], np.hstack([vectors, rest])
    return values, vectors / np.linalg.norm(vectors, axis=0)


def usable(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows whose vector is whole and finite, with x, the entries as longs. Shorter vectors than the longest lack entries, so they go."""
    def finite(c: Column) -> Column:
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST / SCALE)

    wide = rows.withColumn("x", F.col(vector).cast("array<double>"))
    whole = wide.where(F.col("x").isNotNull() & F.forall("x", finite))
    size = whole.agg(F.max(F.size("x")).alias("size")).first()["size"] or 0
    return whole.where(F.size("x") == size).withColumn("x", F.transform("x", lambda c: F.when(finite(c), F.floor(c * SCALE) + F.lit(SHIFT).cast("long"))))


def _matrix(column: pa.ChunkedArray | pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _added(partials: DataFrame, size: int) -> np.ndarray:
    """Sum of one matrix per row. Tasks add up what they get until a few are left for the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for raw in batch.column("sums"):
                total += np.frombuffer(raw.as_py(), np.float64)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    few = partials.repartition(FAN).mapInArrow(run, "sums binary")
    return sum((np.frombuffer(r["sums"], np.float64) for r in few.collect()), np.zeros(size))  # at most FAN matrices


def _products(rows: DataFrame, values, width: int) -> np.ndarray:
    """Sum over all rows of the outer products of values(x) and of the values themselves; rows (x)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, line = np.zeros((width, width)), np.zeros(width)
        for batch in batches:
            if batch.num_rows:
                z = values(batch.column("x"))
                total += z.T @ z
                line += z.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([np.r_[total.ravel(), line].tobytes()], pa.binary())], ["sums"])

    return _added(rows.select("x").mapInArrow(run, "sums binary"), width * width + width)


def _covariance(sums: np.ndarray, width: int, n: int) -> np.ndarray:
    """From sums of centred values; what the centring left over is taken out."""
    products, line = sums[:width * width].reshape(width, width) / n, sums[width * width:] / n
    out = products - np.outer(line, line)
    return (out + out.T) / 2


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Per row, the sum of (n * x - S) ** 2, exact; None where no long holds it."""
    size = x.shape[1]
    bound = (max(abs(int(x.max())), abs(int(x.min()))) + 1) * n + max(map(abs, sums))
    if bound * bound * size < 1 << 63:
        d = x * n - np.array(sums, np.int64)
        return (d * d).sum(axis=1).tolist()
    exact = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x.tolist()]
    return [e if e < 1 << 63 else None for e in exact]


def whiten(rows: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) per usable row and component, numbered from 1.

    Rows whose vector is null, or holds a null, a missing or a non-finite entry, are left out; repeated rows and null ids stay. There
    are as many components as asked for, or as dimensions. Where the data have no variance along a component, whitened is null, and the
    component has no part in identity_error; explained is null where there is no variance at all. A deviation that no long can hold is
    null. An empty table gives an empty one. Other columns are not read.
    """
    kind = rows.schema[vec_id].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    spark = rows.sparkSession
    found = usable(rows.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("embedding"))).select("vec_id", "x")
    per_place = found.select(F.posexplode("x").alias("place", "c")).groupBy("place").agg(F.sum(F.col("c").cast("decimal(38,0)")).alias("s"), F.count("*").alias("n"))
    sums = {r["place"]: r for r in per_place.collect()}  # one row per dimension
    size = len(sums)
    if not size:
        return spark.createDataFrame([], schema)
    n, totals = sums[0]["n"], [int(sums[k]["s"]) for k in range(size)]
    # Centred exactly to whole numbers first, then by the fraction that is left.
    whole = np.array([s // n for s in totals], np.int64)
    part = np.array([(s % n) / n for s in totals])

    def centred(column: pa.Array) -> np.ndarray:
        return (_matrix(column, size) - whole).astype(np.float64) - part

    v = _covariance(_products(found, centred, size), size, n)
    count = min(components, size)
    values, vectors = feast(v, count)
    real = values > 0
    scale = np.where(real, 1 / np.sqrt(np.where(real, values, 1)), 0.0)
    turned = vectors * scale

    def white(column: pa.Array) -> np.ndarray:
        return centred(column) @ turned

    error = _covariance(_products(found, white, count), count, n) - np.eye(count)
    identity_error = float(np.abs(error[np.ix_(real, real)]).max()) if real.any() else 0.0
    trace = float(np.trace(v))
    explained = [float(e) / trace if trace > 0 else None for e in values]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("x"), size)
            out = white(batch.column("x"))
            deviation = pa.array([d for d in _deviations(x, n, totals) for _ in range(count)], pa.int64())
            rows_of = np.repeat(np.arange(len(x)), count)
            places = np.tile(np.arange(count), len(x))
            kept = np.tile(real, len(x))
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").take(pa.array(rows_of)), pa.array((places + 1).astype(np.int32)), pa.array(np.full(len(rows_of), n, np.int64)), deviation,
                pa.array(out.ravel(), pa.float64(), mask=~kept), pa.array([explained[p] for p in places], pa.float64()),
                pa.array(np.full(len(rows_of), identity_error))], ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return found.mapInArrow(run, schema)


by_value(__name__)
