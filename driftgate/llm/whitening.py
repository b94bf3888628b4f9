"""Embedding whitening: the leading principal components, by Chebyshev-filtered subspace iteration.

The covariance V is never formed. All it takes part in is one kind of pass over the vectors, Y = Xc'(Xc Q) / n with Xc the
centred vectors and Q a block of ``BLOCK`` columns: every task multiplies its own rows, and Spark adds up what they send, one
row per dimension. A few Lanczos passes find the lower end of the spectrum, Rayleigh-Ritz on the block its upper part. The
Chebyshev polynomial of degree ``DEGREE`` that stays small between the two then multiplies the block, pass by pass by its recurrence, which
damps whatever is not wanted; QR and Rayleigh-Ritz follow. This repeats until the residual of every wanted component, measured in a pass over the vectors,
is within ``CERTIFIED`` of the largest eigenvalue; otherwise an error says so.

Tasks send their sums as integers, scaled such that no total can overflow: they add up to the same in any order, so reruns
over the same partitions agree.

The driver holds d x ``BLOCK`` numbers, whatever the number of vectors.

Defined results: a vector that is null or empty, holds null or non-finite entries or one beyond ``LARGEST``, or has another
length than most takes no part; repeated rows count each; a missing vec_id stays null; components without variance are left out, so
vectors that are all equal, and an empty table, give no rows. A deviation beyond 38 digits is null. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, cut

COMPONENTS = 8
#: Columns of the block beyond the wanted ones: the farther the first unwanted eigenvalue outside, the faster.
GUARD = 24
BLOCK = COMPONENTS + GUARD
DEGREE = 10
LANCZOS = 8
#: Largest residual of a component, as a share of the largest eigenvalue.
CERTIFIED = 1e-13
ROUNDS = 60
#: Eigenvalues below this share of the largest are no variance but rounding.
NOTHING = 1e-11
#: Entries up to here stay whole numbers in double precision when scaled.
LARGEST = 2.0**41
#: Bytes of vectors that are multiplied at once.
PACKED = 1 << 18
SEED = 13

_Multiply = Callable[[np.ndarray], np.ndarray]


def whole_entries(vectors: DataFrame) -> tuple[DataFrame, int]:
    """vec_id, x: floor(1024 c) + 100000 of every entry of the vectors that take part; and how many entries they have."""

    def usable(c: Column) -> Column:
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) <= LARGEST)

    entries = column(vectors, "embedding").cast("array<double>").alias("x")
    rows = vectors.select(column(vectors, "vec_id").alias("vec_id"), entries)
    rows = rows.filter(F.size("x") > 0).filter(F.forall("x", usable))
    sizes = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).head()
    d = sizes["d"] if sizes else 0
    whole = F.transform("x", lambda c: F.floor(c * 1024).cast("long") + F.lit(100_000))
    return rows.filter(F.size("x") == d).select("vec_id", whole.alias("x")), d


def _packed(rows: DataFrame, d: int) -> DataFrame:
    """The vectors some ``PACKED`` bytes at a time: vec_ids, x. Passes then move few rows from Spark to numpy."""
    most = max(1, PACKED // (8 * max(d, 1)))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, most):
                own = batch.slice(at, most)
                ids, x = own.column("vec_id"), own.column("x").flatten().to_numpy()
                ids = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
                yield pa.RecordBatch.from_arrays([ids, pa.array([x.tobytes()], pa.binary())], ["vec_ids", "x"])

    kind = rows.schema["vec_id"].dataType.simpleString()
    return cut(rows.mapInArrow(pack, f"vec_ids array<{kind}>, x binary"))


def _matrices(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for x in batch.column("x"):
            yield np.frombuffer(x.as_buffer(), np.int64).reshape(-1, d)


class Fitted:
    """The fit list: its vectors, how many, their length, and the exact sums by dimension."""

    def __init__(self, vectors: DataFrame) -> None:
        whole, self.d = whole_entries(vectors)
        d, self.rows = self.d, _packed(whole, self.d)

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, high, low, squares = 0, np.zeros(d, np.int64), np.zeros(d, np.int64), np.zeros(d)
            for x in _matrices(batches, d):
                n += len(x)
                high += (x >> 26).sum(axis=0)  # in halves, which cannot overflow
                low += (x & ((1 << 26) - 1)).sum(axis=0)
                squares += (x.astype(float) ** 2).sum(axis=0)
            columns = np.arange(d), np.full(d, n), high, low, squares
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["dim", "n", "high", "low", "squares"])

        found = []
        if d:
            parts = self.rows.select("x").mapInArrow(sums, "dim long, n long, high long, low long, squares double")
            whole = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]
            found = sorted(parts.groupBy("dim").agg(F.sum("n").alias("n"), *whole, F.sum("squares").alias("s")).collect())
        self.n = found[0]["n"] if found else 0
        self.sums = [(int(r["high"]) << 26) + int(r["low"]) for r in found]
        self.mean = np.array([s / self.n for s in self.sums])
        #: No less than all squares around the mean add up to.
        self.most = 2 * sum(r["s"] for r in found)

    def total(self, part: Callable[[np.ndarray], np.ndarray], shape: tuple[int, int], bound: float) -> np.ndarray:
        """``part`` of the centred vectors, added up over all of them; ``bound``: no sum of absolute values passes it."""
        d, mean, scale = self.d, self.mean, 2.0**61 / max(bound, 1e-300)
        names = [f"c{i}" for i in range(shape[1])]

        def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = np.zeros(shape)
            for x in _matrices(batches, d):
                held += part(x - mean)
            whole = np.rint(held * scale).astype(np.int64)
            columns = [pa.array(np.arange(shape[0])), *[pa.array(whole[:, i]) for i in range(shape[1])]]
            yield pa.RecordBatch.from_arrays(columns, ["dim", *names])

        parts = self.rows.select("x").mapInArrow(summed, "dim long, " + ", ".join(f"{c} long" for c in names))
        found = sorted(parts.groupBy("dim").sum(*names).collect())
        return np.array([r[1:] for r in found], float) / scale


def lowest_eigenvalue(multiply: _Multiply, d: int, steps: int = LANCZOS) -> float:
    """About the least eigenvalue, rather too low than too high, by some Lanczos steps."""
    q = np.random.default_rng(SEED).standard_normal(d)
    basis, diagonal, beside = [q / np.linalg.norm(q)], [], []
    for _ in range(min(steps, d)):
        y = multiply(basis[-1][:, None])[:, 0]
        diagonal.append(basis[-1] @ y)
        for _ in range(2):
            y = y - np.array(basis).T @ (np.array(basis) @ y)
        beside.append(np.linalg.norm(y))
        if beside[-1] <= 1e-12 * max(map(abs, diagonal)):
            beside[-1] = 0.0
            break
        basis.append(y / beside[-1])
    inner = np.diag(diagonal) + np.diag(beside[:-1], 1) + np.diag(beside[:-1], -1)
    return max(0.0, float(np.linalg.eigvalsh(inner)[0] - beside[-1]))


def filtered(multiply: _Multiply, q: np.ndarray, low: float, high: float, most: float, degree: int) -> np.ndarray:
    """The block times the Chebyshev polynomial that is small on [low, high] and about 1 at ``most``."""
    half, middle = (high - low) / 2, (high + low) / 2
    sigma = first = half / (most - middle)
    before, now = q, (multiply(q) - middle * q) * (sigma / half)
    for _ in range(degree - 1):
        then = 1 / (2 / first - sigma)
        before, now = now, (multiply(now) - middle * now) * (2 * then / half) - (sigma * then) * before
        sigma = then
    return now


def leading(multiply: _Multiply, d: int, wanted: int = COMPONENTS, guard: int = GUARD) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, those with variance, and their unit eigenvectors as columns, certified."""
    k = min(d, wanted + guard)
    q = np.linalg.qr(np.random.default_rng(SEED).standard_normal((d, k)))[0]
    low = None
    for _ in range(ROUNDS):
        image = multiply(q)
        values, turn = np.linalg.eigh((q.T @ image + image.T @ q) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, image = q @ turn, image @ turn
        count = int((values[:wanted] > NOTHING * values[0]).sum()) if values[0] > 0 else 0
        rest = np.linalg.norm(image[:, :wanted] - q[:, :wanted] * values[:wanted], axis=0)
        if values[0] <= 0 or rest.max() <= CERTIFIED * values[0]:
            sign = np.sign(q[np.abs(q).argmax(axis=0), np.arange(k)])
            return values[:count], (q * sign)[:, :count]
        if low is None:
            low = lowest_eigenvalue(multiply, d)
        high = max(values[-1], NOTHING * values[0])
        bottom = low if low < 0.99 * high else 0.0
        q = np.linalg.qr(filtered(multiply, q, bottom, high, values[0], DEGREE))[0]
    raise RuntimeError(f"the components are not certified after {ROUNDS} rounds: residual {rest.max() / values[0]:.2g}")


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[Decimal | None]:
    """The exact sum over the dimensions of (n x - S)^2 for each row."""
    most = n * int(np.abs(x).max()) + max(map(abs, sums))
    if len(sums) * most**2 < 1 << 63:
        own = ((n * x - np.array(sums)) ** 2).sum(axis=1).tolist()
    else:
        own = ((n * x.astype(object) - np.array(sums, object)) ** 2).sum(axis=1).tolist()
    return [Decimal(v) if v < 10**38 else None for v in own]


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per vector that takes part and component: vec_id, component, n, deviation (decimal), whitened, explained
    and identity_error."""
    fit = Fitted(vectors)
    kind = fit.rows.schema["vec_ids"].dataType.elementType.simpleString()
    schema = f"vec_id {kind}, deviation decimal(38,0), component int, whitened double"
    values, axes = np.zeros(0), np.zeros((fit.d, 0))
    trace = error = 0.0
    d, n, sums, mean = fit.d, fit.n, fit.sums, fit.mean
    if n:
        squares = fit.total(lambda x: np.array([[(x**2).sum()]]), (1, 1), fit.most)[0, 0]
        trace = squares / n
    if trace > 0:

        def multiply(q: np.ndarray) -> np.ndarray:
            # Columns of length one: no sum of absolute values then passes that of all squares.
            lengths = np.maximum(np.linalg.norm(q, axis=0), 1e-300)
            unit = q / lengths
            return fit.total(lambda x: x.T @ (x @ unit), q.shape, 2 * squares) * (lengths / n)

        values, axes = leading(multiply, d, components)
    scaled = axes / np.sqrt(values)
    k = len(values)
    if k:
        middle = fit.total(lambda x: (x @ scaled).sum(axis=0)[None, :], (1, k), 4 * n)[0] / n

        def products(x: np.ndarray) -> np.ndarray:
            y = x @ scaled - middle
            return y.T @ y

        error = float(np.abs(fit.total(products, (k, k), 4 * n) / n - np.eye(k)).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches if k else ():
            for ids, x in zip(batch.column("vec_ids"), _matrices([batch], d), strict=True):
                at = pa.array(np.repeat(np.arange(len(x)), k))
                deviations = pa.array(_deviations(x, n, sums), pa.decimal128(38, 0))
                own = ((x - mean) @ scaled).ravel()
                columns = [
                    ids.values.take(at), deviations.take(at),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(own),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "deviation", "component", "whitened"])

    share = F.element_at(F.array(*[F.lit(float(v / trace)) for v in values] or [F.lit(0.0)]), F.col("component"))
    return fit.rows.mapInArrow(project, schema).select(
        "vec_id", "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened", share.alias("explained"),
        F.lit(error).alias("identity_error"),
    )
