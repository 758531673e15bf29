"""Whitening of embeddings; eigenvalues are found and counted by slicing the spectrum.

Entries become integers (``floor(64 * c) + 1000000``), so that sums are exact. The fit list holds
each distinct vector once. Spark makes its sums and, centred, its covariance: every task adds up one
matrix, the tasks' rows of it are added by row number. What reaches the driver is the dimension's
square, whatever the number of rows.

V is brought to tridiagonal form once by reflections. V - s*I is factored as L*D*L' with pivots of one
and two rows; by Sylvester's law D has as many positive eigenvalues as V has above s. Halving intervals by these counts isolates the
k-th eigenvalue (or a cluster that no double tells apart); Rayleigh quotient iteration, with solves
by the same factors, then converges cubically. Its result counts only if it lies in the isolating
interval; otherwise the interval is halved further and the iteration starts again. At the end counts
on both sides of every eigenvalue certify its number.

Defined cases: vectors that are null, empty or hold null or non-finite entries take no part, nor do
entries beyond 2**55 (their integers would not fit); with vectors of several lengths the commonest
length takes part, ties to the smaller. A null vec_id stays null, repeated rows are repeated.
Eigenvalues not above 1000 times the rounding error of the largest give no component, so one distinct
vector or none gives no rows. ``deviation`` is null where it exceeds a long. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_of, saved

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
LARGEST = 2.0**55
#: Rows of a batch that a task turns into a matrix at once.
ROWS = 2048
_EPS = np.finfo(float).eps
_PIVOT = (5**0.5 - 1) / 2


# --- spectrum slicing -------------------------------------------------------------------------


def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, off-diagonal, Q) with V = Q*T*Q': reflections clear one column after the other."""
    a, q = v.copy(), np.eye(len(v))
    for k in range(len(v) - 2):
        x = a[k + 1 :, k].copy()
        x[0] += np.copysign(np.linalg.norm(x), x[0])
        size = np.linalg.norm(x)
        if size:
            x /= size
            p = a[k + 1 :, k + 1 :] @ x
            p -= (x @ p) * x
            a[k + 1 :, k + 1 :] -= 2 * (np.outer(p, x) + np.outer(x, p))
            a[k + 1 :, k] -= 2 * x * (x @ a[k + 1 :, k])
            q[:, k + 1 :] -= 2 * np.outer(q[:, k + 1 :] @ x, x)
    return np.diag(a).copy(), np.diag(a, -1).copy(), q


class Factors:
    """T - shift*I = L*D*L' for a tridiagonal T; pivots are one row, or two where one is too small."""

    def __init__(self, diagonal: np.ndarray, off: np.ndarray, shift: float):
        d, e = (diagonal - shift).tolist(), [*off.tolist(), 0.0]
        largest = max(map(abs, d + e))
        tiny = largest * _EPS**2 + float(np.finfo(float).tiny)
        #: (row, pivot's entries a, b, c of [[a, b], [b, c]]; b and c are None for one row)
        self.pivots: list[tuple] = []
        k, now = 0, d[0]
        while k < len(d):
            if k == len(d) - 1 or abs(now) * largest >= _PIVOT * e[k] ** 2:
                now = now if abs(now) > tiny else tiny  # the shift is an eigenvalue: as if it lay just below
                self.pivots.append((k, now, None, None))
                if k + 1 < len(d):
                    now = d[k + 1] - e[k] ** 2 / now
                k += 1
            else:
                a, b, c = now, e[k], d[k + 1]
                self.pivots.append((k, a, b, c))
                if k + 2 < len(d):
                    now = d[k + 2] - e[k + 1] ** 2 * (a / (a * c - b * b))
                k += 2
        self.off = e

    def above(self) -> int:
        """Eigenvalues of T above the shift: D's positive ones (a pivot of two rows has one of each sign)."""
        return sum(1 if b is not None else int(a > 0) for _, a, b, _ in self.pivots)

    def solve(self, x: np.ndarray) -> np.ndarray:
        y, e, n = x.tolist(), self.off, len(x)
        for k, a, b, c in self.pivots:  # L z = x, then D w = z
            if b is None:
                w = y[k] / a
                if k + 1 < n:
                    y[k + 1] -= e[k] * w
                y[k] = w
            else:
                det = a * c - b * b
                first, second = (c * y[k] - b * y[k + 1]) / det, (a * y[k + 1] - b * y[k]) / det
                if k + 2 < n:
                    y[k + 2] -= e[k + 1] * second
                y[k], y[k + 1] = first, second
        for k, a, b, c in reversed(self.pivots):  # L' y = w
            if b is None:
                if k + 1 < n:
                    y[k] -= e[k] / a * y[k + 1]
            elif k + 2 < n:
                det = a * c - b * b
                y[k] += b * e[k + 1] / det * y[k + 2]
                y[k + 1] -= a * e[k + 1] / det * y[k + 2]
        return np.array(y)


def _unit(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    for _ in range(2):
        x = x - known @ (known.T @ x)
    return x / np.linalg.norm(x)


def _improved(diagonal: np.ndarray, off: np.ndarray, x: np.ndarray, known: np.ndarray, size: float) -> tuple[float, np.ndarray, float]:
    """Rayleigh quotient iteration until the residual no longer falls: (value, unit vector, residual)."""
    best = (float(x @ _times(diagonal, off, x)), x, np.inf)
    for _ in range(60):
        image = _times(diagonal, off, x)
        value = float(x @ image)
        left = float(np.linalg.norm(image - value * x))
        if left >= best[2]:
            break
        best = (value, x, left)
        if left <= _EPS * size:
            break
        x = _unit(Factors(diagonal, off, value).solve(x), known)
    return best


def _times(diagonal: np.ndarray, off: np.ndarray, x: np.ndarray) -> np.ndarray:
    out = diagonal * x
    out[1:] += off * x[:-1]
    out[:-1] += off * x[1:]
    return out


def leading(v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues above rounding of a positive semidefinite matrix, falling,
    and their unit vectors as columns."""
    n, scale = len(v), float(np.abs(v).max(initial=0.0))
    if not n or not scale or not np.isfinite(scale):
        return np.zeros(0), np.zeros((n, 0))
    diagonal, off, q = tridiagonal((v + v.T) / (2 * scale))
    high = float((np.abs(diagonal) + np.append(np.abs(off), 0) + np.append(0, np.abs(off))).max())  # no eigenvalue is larger
    floor, close = 1000 * n * _EPS * high, 8 * n * _EPS * high
    counts: dict[float, int] = {}

    def above(shift: float) -> int:
        if shift not in counts:
            counts[shift] = Factors(diagonal, off, shift).above()
        return counts[shift]

    most = min(most, above(floor))
    values, vectors = np.zeros(0), np.zeros((n, 0))
    rng = np.random.default_rng(13)
    while len(values) < most:
        k = len(values) + 1
        # (low, up]: at least k eigenvalues above low, at most k - 1 above up
        up = min((s for s, c in counts.items() if c < k), default=high * (1 + 4 * _EPS))
        low = max(s for s, c in counts.items() if c >= k)
        while True:
            alone = above(low) == k and above(up) == k - 1 and up - low <= 0.25 * max(up, floor)
            if alone or up - low <= close:
                begin = Factors(diagonal, off, (low + up) / 2).solve(rng.normal(size=n))
                value, x, left = _improved(diagonal, off, _unit(begin, vectors), vectors, high)
                if low - close <= value <= up + close and left <= close:
                    break
                if up - low <= close:  # a cluster: any basis of its space serves
                    for _ in range(4):
                        x = _unit(Factors(diagonal, off, (low + up) / 2).solve(x), vectors)
                    value = float(x @ _times(diagonal, off, x))
                    break
            middle = (low + up) / 2
            low, up = (middle, up) if above(middle) >= k else (low, middle)
        values, vectors = np.append(values, value), np.column_stack([vectors, x])
    falling = np.argsort(-values, kind="stable")
    values, vectors = values[falling], vectors[:, falling]
    for k, value in enumerate(values):  # the counts certify each number
        if above(value - 4 * close) < k + 1 or above(value + 4 * close) > k:
            raise ArithmeticError(f"eigenvalue {k + 1} is not certified by the counts beside it")
    vectors = q @ vectors
    return values * scale, vectors / np.linalg.norm(vectors, axis=0)


# --- sums over the rows -----------------------------------------------------------------------


def _matrix(column: pa.Array) -> np.ndarray:
    """Arrays of one length as the rows of a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def vectors(rows: DataFrame) -> DataFrame:
    """vec_id and ``x``, the vector's integers, of the rows that take part."""
    e = F.col("embedding")
    usable = e.isNotNull() & (F.size(e) > 0) & ~F.exists(e, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) > LARGEST))
    x = F.transform(e, lambda c: F.floor(c.cast("double") * SCALE) + SHIFT)
    out = rows.select("vec_id", F.when(usable, x).alias("x")).where("x is not null")
    length = out.groupBy(F.size("x").alias("length")).count().orderBy(F.desc("count"), "length").first()
    return out.where(F.size("x") == (length["length"] if length else 0))


def _partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The task's rows and sums of each dimension, as high and low 32 bits."""
    schema = pa.schema([(name, pa.int64()) for name in ("dim", "n", "high", "low")])
    n, high, low = 0, 0, 0
    for batch in batches:
        if batch.num_rows:
            x = _matrix(batch.column("x"))
            n, high, low = n + len(x), high + (x >> 32).sum(0), low + (x & 0xFFFFFFFF).sum(0)
    if n:
        yield batch_of(schema, [np.arange(len(low)), np.full(len(low), n), high, low])


@dataclass
class Model:
    """What ``fit`` learned: n vectors with sums S, given as S = n * base + rest."""

    n: int = 0
    base: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    rest: list[int] = field(default_factory=list)
    values: np.ndarray = field(default_factory=lambda: np.zeros(0))
    vectors: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    trace: float = 0.0
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n, exact but for one rounding."""
        return (x - self.base) - np.array([float(r) / self.n for r in self.rest])

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of (n*x - S)**2, exact; None beyond a long."""
        apart = x - self.base
        about = ((apart.astype(float) * self.n - np.array([float(r) for r in self.rest])) ** 2).sum(1)
        small = about < 2.0**62
        out: list[int | None] = [None] * len(x)
        exact = apart[small] * np.int64(self.n) - np.array(self.rest if small.any() else [0], np.int64)
        for i, total in zip(np.flatnonzero(small).tolist(), (exact**2).sum(1).tolist(), strict=True):
            out[i] = total
        for i in np.flatnonzero(~small & (about < 2.0**64)).tolist():
            total = sum((self.n * int(a) - r) ** 2 for a, r in zip(apart[i], self.rest, strict=True))
            out[i] = total if total < 1 << 63 else None
        return out


def _scatter(rows: DataFrame, width: int, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over the rows of y*y' with y = of(x), of ``width`` numbers."""
    schema = pa.schema([("row", pa.int32()), ("part", pa.binary())])

    def written(total: np.ndarray, numbers: list[int]) -> pa.RecordBatch:
        return batch_of(schema, [np.array(numbers, np.int32), [total[i].tobytes() for i in range(len(numbers))]])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                y = of(_matrix(batch.column("x").slice(at, ROWS)))
                total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            yield written(total, list(range(width)))

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for row, part in zip(batch.column("row").to_pylist(), batch.column("part").to_pylist(), strict=True):
                total[row] = total.get(row, 0) + np.frombuffer(part)
        if total:
            yield written(np.array(list(total.values())), list(total))

    ddl = "row int, part binary"
    sums = rows.select("x").mapInArrow(partial, ddl).repartition("row").mapInArrow(added, ddl)
    out = np.zeros((width, width))
    for r in sums.collect():  # width rows
        out[r["row"]] = np.frombuffer(r["part"])
    return out


def fit(rows: DataFrame, components: int = COMPONENTS) -> Model:
    """Learn from the distinct ``x`` of ``rows``."""
    distinct = saved(rows.select("x").distinct())
    wide = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]
    sums = distinct.mapInArrow(_partial_sums, "dim long, n long, high long, low long").groupBy("dim").agg(F.sum("n").alias("n"), *wide)
    sums = sums.orderBy("dim").collect()  # one row for each dimension
    if not sums:
        return Model()
    n = sums[0]["n"]
    both = [divmod((int(r["high"]) << 32) + int(r["low"]), n) for r in sums]
    model = Model(n, np.array([b for b, _ in both], np.int64), [r for _, r in both])
    width = len(both)
    covariance = _scatter(distinct, width, model.centred) / n
    model.trace = float(np.trace(covariance))
    model.values, model.vectors = leading(covariance, components)
    if len(model.values):
        # the whitened rows' own covariance; their mean is zero as the rows are centred
        identity = _scatter(distinct, len(model.values), model.whitened) / n
        model.identity_error = float(np.abs(identity - np.eye(len(identity))).max())
    return model


OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(rows: DataFrame, model: Model) -> DataFrame:
    """A row for each of ``rows`` and component: what ``OUT`` names."""
    schema = pa.schema(
        [("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()),
         ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())]
    )
    k = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows if k else 0, ROWS):
                part = batch.slice(at, ROWS)
                x = _matrix(part.column("x"))
                each = np.repeat(np.arange(len(x)), k)
                yield batch_of(
                    schema,
                    [part.column("vec_id").take(pa.array(each)), np.tile(np.arange(1, k + 1, dtype=np.int32), len(x)), np.full(len(each), model.n),
                     pa.array(model.deviations(x), pa.int64()).take(pa.array(each)), model.whitened(x).ravel(),
                     np.tile(model.values / model.trace, len(x)), np.full(len(each), model.identity_error)],
                )

    return rows.select(F.col("vec_id").cast("long"), "x").mapInArrow(run, OUT)
