"""Whitening of embeddings: leading eigenvectors of their covariance by Chebyshev-filtered subspace iteration."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, functions as F, types as T

from flowmart.llm.common import stored

#: Components, steps per unit of an entry, and the offset that makes steps positive.
COMPONENTS, SCALE, OFFSET = 16, 64, 1_000_000
#: Entries times ``SCALE`` must stay below this, so that steps are exact in doubles.
LARGEST = 2.0**52
#: Residuals, as a share of the largest eigenvalue: aimed at, and accepted where rounding allows no less.
AIM, ACCEPT = 1e-14, 1e-11
#: Most distributed passes in one filter, steps of the bounds' recurrence, and rounds after which a spectrum counts as failed.
DEGREE, BOUND_STEPS, ROUNDS = 10, 10, 100
#: How much more a filter may amplify the first open eigenvector than the last wanted one.
SPREAD = 1e10


def quantized(vectors: DataFrame, key: str, column: str, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """(vec_id, x) of every row whose vector has only finite entries: x = floor(scale * entry) + offset, as longs."""
    rows = vectors.select(F.col(f"`{key}`").alias("vec_id"), F.col(f"`{column}`").cast("array<double>").alias("v"))
    sound = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < math.inf))
    far = F.raise_error(F.lit("an entry is too large to be counted in steps")).cast("bigint")
    step = lambda c: F.when(F.abs(c * scale) < LARGEST, F.floor(c * scale) + offset).otherwise(far)
    return rows.where(F.col("v").isNotNull() & sound).select("vec_id", F.transform("v", step).alias("x"))


def _matrix(batch, dim: int):
    """The vectors of one batch as rows of longs; the vectors are its last column."""
    import numpy as np

    return batch.column(batch.num_columns - 1).flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, dim)


def summed(table: DataFrame, size: int, part: Callable, kind: str = "double"):
    """The sum of ``part(batch)`` (``size`` numbers) over all batches: added up in each task, then by Spark per position."""
    import numpy as np

    dtype = np.int64 if kind == "long" else np.float64

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total = np.zeros(size, dtype)
        for batch in batches:
            total += part(batch).reshape(size)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], names=["k", "v"])

    rows = table.mapInArrow(run, f"k int, v {kind}").groupBy("k").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(size, dtype)
    out[rows["k"].to_numpy()] = rows["v"].to_numpy()
    return out


class Fit:
    """What the distinct vectors are centred by: count, exact sums, and sums of squares about a whole-number middle."""

    def __init__(self, table: DataFrame, n: int, dim: int) -> None:
        import numpy as np

        self.table, self.n, self.dim = table, n, dim
        self.sums = summed(table, dim, lambda b: _matrix(b, dim).sum(axis=0), "long")
        # Steps are taken from the whole number next to the mean, and the rest of the mean is below one: no digits are lost.
        self.middle = np.array([round(int(s) / n) for s in self.sums], np.int64)
        self.over = np.array([int(s) - n * int(m) for s, m in zip(self.sums, self.middle)], np.int64)
        middle = self.middle
        squares = summed(table, dim, lambda b: ((_matrix(b, dim) - middle) ** 2).sum(axis=0), "long")
        self.trace = sum((int(q) * n - int(r) ** 2) for q, r in zip(squares, self.over)) / n**2

    def centred(self) -> Callable:
        """A function from a batch to its centred rows."""
        middle, rest, dim = self.middle, self.over / self.n, self.dim
        return lambda batch: (_matrix(batch, dim) - middle) - rest

    def applied(self, q):
        """The covariance times ``q``: one pass over the table, with as many numbers as ``q`` summed."""
        centred = self.centred()

        def part(batch):
            c = centred(batch)
            return c.T @ (c @ q)

        return summed(self.table, q.size, part).reshape(q.shape) / self.n


def _ends(apply: Callable, dim: int, rng) -> tuple[float, float]:
    """Estimated ends of the spectrum, from a short recurrence that starts with one random vector."""
    import numpy as np

    basis = [rng.standard_normal(dim)]
    basis[0] /= np.linalg.norm(basis[0])
    diagonal, side = [], []
    for _ in range(min(dim, BOUND_STEPS)):
        w = apply(basis[-1][:, None])[:, 0]
        diagonal.append(float(basis[-1] @ w))
        for _ in range(2):  # orthogonal to all before, twice for rounding
            w -= np.array(basis).T @ (np.array(basis) @ w)
        norm = float(np.linalg.norm(w))
        if norm <= 1e-12 * max(map(abs, diagonal)) or len(diagonal) == dim:
            norm = 0.0
            break
        side.append(norm)
        basis.append(w / norm)
    k = len(diagonal)
    values, vectors = np.linalg.eigh(np.diag(diagonal) + np.diag(side[: k - 1], 1) + np.diag(side[: k - 1], -1))
    return max(0.0, float(values[0] - norm * abs(vectors[-1, 0]))), float(values[-1] + norm * abs(vectors[-1, -1]))


def _filtered(apply: Callable, q, applied, locked, low: float, cut: float, top: float, degree: int):
    """``degree`` steps of the scaled Chebyshev recurrence on [low, cut]: what lies above grows, what lies within is damped."""
    half, middle = (cut - low) / 2, (cut + low) / 2
    free = lambda y: y - locked @ (locked.T @ y)
    first = half / (top - middle)
    scale, before, now = first, q, free(applied - middle * q) * (first / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - scale)
        now, before = free(2 * (apply(now) - middle * now) * (after / half) - scale * after * before), now
        scale = after
    return now


def eigenpairs(apply: Callable, dim: int, wanted: int, seed: int = 0):
    """(values, vectors, residual): the ``wanted`` largest eigenvalues, falling, unit eigenvectors, and the largest residual norm.

    ``apply`` multiplies a matrix of ``dim`` rows by the symmetric matrix, in one distributed pass. A block of three times the wanted
    vectors is filtered, orthonormalised and rotated to its Ritz vectors until every wanted one has a residual of ``AIM`` times the
    largest value, or of ``ACCEPT`` times it and falling no more. Vectors that are done are locked and kept out of the filter.
    """
    import numpy as np

    rng = np.random.default_rng(seed)
    wanted = min(wanted, dim)
    width = min(dim, 3 * wanted)
    low, _ = _ends(apply, dim, rng) if width < dim else (0.0, 0.0)
    q = np.linalg.qr(rng.standard_normal((dim, width)))[0]
    last = math.inf
    for _ in range(ROUNDS):
        z = apply(q)
        values, turn = np.linalg.eigh((q.T @ z + z.T @ q) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, z = q @ turn, z @ turn
        error = np.linalg.norm(z - q * values, axis=0)[:wanted]
        worst, top = float(error.max()), float(max(values[0], 0.0))
        if worst <= AIM * top or top == 0 or worst <= ACCEPT * top and worst > last / 2:
            return values[:wanted], q[:, :wanted], worst
        last = worst
        open_from = int(np.argmax(error > AIM * top))  # the first that is not done
        cut = float(values[-1])
        floor = min(low, cut)
        half = max((cut - floor) / 2, 1e-8 * top)
        cut = floor + 2 * half
        reach = [math.acosh(max(1.0, (float(v) - cut + half) / half)) for v in (values[open_from], values[wanted - 1])]
        degree = DEGREE
        while degree > 2 and degree * (reach[0] - reach[1]) > math.log(SPREAD):
            degree -= 1
        locked = q[:, :open_from]
        grown = _filtered(apply, q[:, open_from:], z[:, open_from:], locked, floor, cut, max(float(values[open_from]), cut + half * 1e-6), degree)
        grown /= np.linalg.norm(grown, axis=0)
        q = np.linalg.qr(np.concatenate([locked, grown], axis=1))[0]
    raise ArithmeticError(f"eigenvectors are not certified after {ROUNDS} rounds: residual {last / top:.1e} of the largest eigenvalue")


def whiten(
    vectors: DataFrame, key: str = "vec_id", column: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET,
) -> DataFrame:
    """One row per sound vector and component: vec_id, component, n, deviation, whitened, explained, identity_error, residual.

    Vectors that are null or hold a null or non-finite entry are left out. Entries are counted in whole steps (``quantized``), and each
    distinct vector is fitted once, however many rows repeat it. ``deviation`` is exact, as decimal(38, 0): the sum over dimensions of
    (n * x - sum)². Components are numbered by falling eigenvalue, in either sign; one without variance beyond rounding (1e-12 of the largest)
    cannot be whitened and has no rows, so equal vectors or an empty table give none. Vectors of several lengths are an error.
    Null and repeated keys are kept as they are; other columns are not read.

    The vectors are never gathered: a pass sums one small matrix per task. What the driver holds is three times ``components`` columns.
    """
    rows = stored(quantized(vectors, key, column, scale, offset))
    shortest, dim = rows.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    schema = T.StructType([
        rows.schema["vec_id"], *T.StructType.fromDDL(
            "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double, residual double"
        )
    ])
    if not dim:
        return rows.sparkSession.createDataFrame([], schema)
    if shortest != dim:
        raise ValueError(f"vectors have {shortest} to {dim} entries")
    table = stored(rows.select("x").distinct())
    n = table.count()
    fit = Fit(table, n, dim)
    if not fit.trace:
        return rows.sparkSession.createDataFrame([], schema)
    values, base, residual = eigenpairs(fit.applied, dim, components)
    held = int((values > 1e-12 * values[0]).sum())
    values, turned = values[:held], base[:, :held] / values[:held] ** 0.5
    centred, error = fit.centred(), identity_error(fit, turned)
    shares = values / fit.trace
    middle, over, left = fit.middle, fit.over, sum(int(r) ** 2 for r in fit.over)

    def project(batches: Iterator) -> Iterator:
        from decimal import Decimal

        import numpy as np
        import pyarrow as pa

        for batch in batches:
            m = batch.num_rows
            steps = _matrix(batch, dim) - middle
            squares, mixed = (steps**2).sum(axis=1).tolist(), (steps @ over).tolist()
            far = pa.array([Decimal(n * n * a - 2 * n * b + left) for a, b in zip(squares, mixed)], pa.decimal128(38, 0))
            at = pa.array(np.repeat(np.arange(m), held))
            fixed = lambda v: pa.array(np.full(m * held, v))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(at), pa.array(np.tile(np.arange(1, held + 1, dtype=np.int32), m)), fixed(n), far.take(at),
                    pa.array((centred(batch) @ turned).reshape(-1)), pa.array(np.tile(shares, m)), fixed(error), fixed(residual / values[0]),
                ],
                names=schema.names,
            )

    return rows.mapInArrow(project, schema)


def identity_error(fit: Fit, turned) -> float:
    """The largest absolute entry of the covariance of the whitened distinct vectors less the identity."""
    import numpy as np

    centred, k = fit.centred(), turned.shape[1]

    def part(batch):
        w = centred(batch) @ turned
        return np.concatenate([(w.T @ w).reshape(-1), w.sum(axis=0)])

    total = summed(fit.table, k * k + k, part) / fit.n
    mean = total[k * k:]
    return float(np.abs(total[:k * k].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())
