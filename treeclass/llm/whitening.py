"""Whitening of embeddings by a matrix-free block Jacobi-Davidson eigensolver.

1. Usable rows become whole numbers ``x = floor(64 * c) + 1000000``; the fit list holds each
   distinct ``x`` once.  Its size ``n`` and the sums ``S`` per dimension are exact.
2. The fit list is written as blocks of centred rows ``(n x - S) / n``: the numerator is a whole
   number, so centring before the product costs no digits.  The covariance is never formed:
   ``Product`` gives ``V B`` for a thin block ``B`` by one pass of the executors over the blocks, whose
   partial sums (dimensions x columns) are added by Spark before the driver sees them.
3. The driver keeps only thin matrices (dimensions x subspace).  Each outer step does a
   Rayleigh-Ritz in the subspace, locks the leading pairs whose residual has reached double
   precision, and expands the subspace by the solutions of the projected correction equations
   ``(I - Q Q') (V - theta I) (I - Q Q') t = -r`` with Q the locked and current vectors.  All open
   equations are solved together by MINRES (Paige and Saunders): one distributed product per inner
   step serves every equation.  A full subspace is restarted from its best Ritz vectors.
4. One pass projects the rows; another measures the covariance of the whitened fit list.

Defined cases: rows whose vector is null, empty or holds a null or non-finite entry are dropped;
among the others the commonest length counts (the longest of equally common ones), rows of other
lengths are dropped; entries beyond ``LIMIT`` in size count as that; a null id is kept; repeated rows each
get their rows; components whose eigenvalue is zero to double precision are left out, so a
table with one distinct vector, or none, gives no rows; ``deviation`` is null where it passes
64 bits; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeclass.llm.common import keep_table
from treeclass.session import Scratch

#: Components returned at most.
COMPONENTS = 16
#: Fixed values of the contract: entries become floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
LIMIT = float(1 << 40)
#: Rows of a block of the centred fit list.
BLOCK_ROWS = 4096
#: Residuals are driven below this part of the largest eigenvalue; inner and outer steps at most.
TOLERANCE, INNER, OUTER = 64 * np.finfo(float).eps, 8, 60

BLOCK_SCHEMA = "rows int, centred binary"
CELL_SCHEMA = "cell int, v double"


def whole_rows(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, x`` of the rows that remain (all of one length)."""
    c = F.col(vector_col).cast("array<double>")
    usable = (F.size("c") > 0) & ~F.exists("c", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    bounded = lambda v: F.greatest(F.least(v, F.lit(LIMIT)), F.lit(-LIMIT))
    x = F.transform("c", lambda v: F.floor(bounded(v) * SCALE).cast("long") + F.lit(OFFSET).cast("long"))
    return vectors.select(F.col(id_col).alias("vec_id"), c.alias("c")).where(F.coalesce(usable, F.lit(False))).select("vec_id", x.alias("x"))


class FitList:
    """The distinct rows of a table, their number and sums, and their centred blocks."""

    def __init__(self, scratch: Scratch, rows: DataFrame):
        self.spark, self.scratch = rows.sparkSession, scratch
        distinct = scratch.keep(rows.select("x").distinct(), "fit")
        # sums of 38 digits: exact for any number of rows
        dims = F.posexplode("x").alias("dim", "v")
        sums = distinct.select(dims).groupBy("dim").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("s")).collect()
        self.n, self.dims = distinct.count(), len(sums)
        self.sums = [int(r.s) for r in sorted(sums)]
        self.blocks = scratch.keep(distinct.mapInArrow(self._centre(), BLOCK_SCHEMA), "centred")

    def _centre(self):
        n, sums = self.n, self.sums

        def run(batches):
            for batch in batches:
                y = centred(batch.column("x"), n, sums) / n
                for at in range(0, len(y), BLOCK_ROWS):
                    part = y[at:at + BLOCK_ROWS]
                    yield pa.RecordBatch.from_arrays([pa.array([len(part)], pa.int32()), pa.array([part.tobytes()], pa.binary())],
                                                     names=["rows", "centred"])
        return run

    def summed(self, of, columns: int) -> np.ndarray:
        """Sum over all blocks of ``of(block)``, a matrix of ``columns`` columns; each partition
        sends one partial matrix, cell by cell, and Spark adds them."""
        dims = self.dims

        def run(batches):
            total = None
            for batch in batches:
                for block in batch.column("centred"):
                    part = of(np.frombuffer(block.as_py(), dtype=np.float64).reshape(-1, dims))
                    total = part if total is None else total + part
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size), pa.int32()), pa.array(total.ravel())], names=["cell", "v"])
        cells = self.blocks.mapInArrow(run, CELL_SCHEMA).groupBy("cell").agg(F.sum("v").alias("v")).collect()
        out = np.zeros(len(cells))
        for r in cells:
            out[r.cell] = r.v
        return out.reshape(-1, columns)

    def product(self, b: np.ndarray) -> np.ndarray:
        """``V b``: the covariance times a thin matrix, centred before multiplying."""
        return self.summed(lambda y: y.T @ (y @ b), b.shape[1]) / self.n

    def trace(self) -> float:
        return float(self.summed(lambda y: (y * y).sum(axis=0)[:, None], 1).sum()) / self.n


def centred(column: pa.Array, n: int, sums: list[int]) -> np.ndarray:
    """``n x - S`` of a column of whole-number lists: exact, as Python integers where 64 bits
    do not hold it."""
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    if len(x) and (max(abs(int(x.max())), abs(int(x.min()))) * n + max(map(abs, sums))) >= 1 << 62:
        x = x.astype(object)
        return x * n - np.array(sums, dtype=object)
    return x * np.int64(n) - np.array(sums, dtype=np.int64)


def orthonormal(b: np.ndarray, against: np.ndarray | None = None) -> np.ndarray:
    """Orthonormal basis of the columns of ``b`` beside those of ``against``; columns that add nothing go."""
    for _ in range(2):  # twice is enough for full orthogonality
        if against is not None and against.shape[1]:
            b = b - against @ (against.T @ b)
        norms = np.linalg.norm(b, axis=0)
        b = b[:, norms > 1e-13 * max(1e-300, norms.max(initial=0))]
        if not b.shape[1]:
            return b
        u, s, _ = np.linalg.svd(b / np.linalg.norm(b, axis=0), full_matrices=False)
        b = u[:, s > 1e-10 * s[0]]
    return b


def minres(apply, rhs: np.ndarray, steps: int, reduce: float = 1e-3) -> np.ndarray:
    """Approximate solutions ``A x = rhs`` of symmetric, maybe indefinite systems, one a column,
    from zero (Lanczos with Givens rotations, the columns side by side).  ``apply(v)`` gives A v for
    all columns at once.  Ends when every residual has fallen by ``reduce``."""
    beta = np.linalg.norm(rhs, axis=0)
    first = np.where(beta > 0, beta, 1.0)
    live = beta > 0
    v_old, v = np.zeros_like(rhs), rhs / first
    x, w, w_old = np.zeros_like(rhs), np.zeros_like(rhs), np.zeros_like(rhs)
    c = c_old = np.ones_like(beta)
    s = s_old = np.zeros_like(beta)
    eta, b = beta.copy(), np.zeros_like(beta)
    for _ in range(steps):
        p = apply(v)
        a = (v * p).sum(axis=0)
        p = p - a * v - b * v_old
        b_new = np.linalg.norm(p, axis=0)
        # the last two rotations, then the one that removes the new subdiagonal entry
        delta = c * a - c_old * s * b
        r1 = np.hypot(delta, b_new)
        r2, r3 = s * a + c_old * c * b, s_old * b
        live = live & (r1 > 0)
        safe = np.where(r1 > 0, r1, 1.0)
        c_old, s_old, c, s = c, s, np.where(live, delta / safe, 1.0), np.where(live, b_new / safe, 0.0)
        w, w_old = (v - r3 * w_old - r2 * w) / safe, w
        x = x + np.where(live, c * eta, 0.0) * w
        eta = np.where(live, -s * eta, 0.0)
        live = live & (b_new > 1e-14 * first) & (np.abs(eta) > reduce * beta)
        if not live.any():
            break
        v_old, v, b = v, p / np.where(b_new > 0, b_new, 1.0), b_new
    return x


def eigenpairs(product, dims: int, wanted: int, seed: int = 1):
    """The ``wanted`` largest eigenvalues (falling) and eigenvectors of a symmetric operator that is
    only given as ``product(block)``, their residuals, and the number of products."""
    wanted = min(wanted, dims)
    most = min(dims, max(4 * wanted, wanted + 8))
    calls = 0

    def times(b):
        nonlocal calls
        calls += 1
        return product(b)

    locked, values = np.zeros((dims, 0)), []
    basis = orthonormal(np.random.default_rng(seed).standard_normal((dims, min(dims, wanted + 4))))
    image = times(basis)
    residuals: list[float] = []
    scale, stalled, best = 0.0, 0, np.inf
    for _ in range(OUTER):
        # Rayleigh-Ritz in the subspace (orthogonal to the locked vectors)
        small = basis.T @ image
        theta, u = np.linalg.eigh((small + small.T) / 2)
        order = np.argsort(-theta)
        theta, u = theta[order], u[:, order]
        basis, image = basis @ u, image @ u
        scale = max(scale, float(np.abs(theta).max(initial=0.0)), max(values, default=0.0))
        r = image - basis * theta
        r = r - locked @ (locked.T @ r)
        size = np.linalg.norm(r, axis=0)
        need = wanted - len(values)
        if size[:need].max() < 0.5 * best:
            best, stalled = size[:need].max(), 0
        else:
            stalled += 1
        # rounding of the product itself is the floor: where nothing falls any more, it is reached
        floor = scale * (TOLERANCE if stalled < 4 else 1e-11)
        k = 0
        while k < need and size[k] <= floor:
            k += 1
        if k:
            locked = np.hstack([locked, basis[:, :k]])
            values += [float(t) for t in theta[:k]]
            residuals += [float(t) for t in size[:k]]
            basis, image, theta, r = basis[:, k:], image[:, k:], theta[k:], r[:, k:]
            need, best, stalled = need - k, np.inf, 0
        if not need:
            break
        open_ = slice(0, min(need, basis.shape[1]))
        if basis.shape[1] + need > most - locked.shape[1] and most < dims:  # restart from the best Ritz vectors
            keep = min(basis.shape[1], need + 8)
            basis, image = basis[:, :keep], image[:, :keep]
        q = np.hstack([locked, basis[:, open_]])
        away = lambda t: t - q @ (q.T @ t)  # noqa: E731, B023
        if locked.shape[1] + basis.shape[1] < dims:
            shift = theta[open_]
            t = minres(lambda v: away(times(away(v)) - away(v) * shift), -away(r[:, open_]), INNER)  # noqa: B023
            t = orthonormal(np.hstack([t, r[:, open_]]), np.hstack([locked, basis]))[:, :dims - locked.shape[1] - basis.shape[1]]
        else:
            t = np.zeros((dims, 0))
        if t.shape[1]:
            basis, image = np.hstack([basis, t]), np.hstack([image, times(t)])
        else:  # the subspace is everything there is: refresh its image against rounding
            basis = orthonormal(basis, locked)
            image = times(basis)
    if len(values) < wanted:
        raise ArithmeticError(f"{wanted - len(values)} eigenpairs have not converged after {OUTER} steps")
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order], locked[:, order], np.array(residuals)[order], calls


WHITE_SCHEMA = "vec_id long, component int, n long, deviation long, whitened double"


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: a row per remaining
    vector and component."""
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], WHITE_SCHEMA + ", explained double, identity_error double")
    with Scratch(spark, "whitening") as scratch:
        rows = scratch.keep(whole_rows(vectors, id_col, vector_col), "rows")
        lengths = rows.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
        if lengths is None:
            return empty
        rows = rows.where(F.size("x") == lengths.dims)
        fit = FitList(scratch, rows)
        values, directions, _, _ = eigenpairs(fit.product, fit.dims, components)
        positive = values > fit.dims * np.finfo(float).eps * max(values.max(), 0.0)
        values, directions = values[positive], directions[:, positive]
        if not len(values):
            return empty
        trace = fit.trace()
        to_white = directions / np.sqrt(values)
        cov = fit.summed(lambda y: (y @ to_white).T @ (y @ to_white), len(values)) / fit.n
        error = float(np.abs(cov - np.eye(len(values))).max())
        return keep_table(_projected(rows, fit.n, fit.sums, to_white).withColumns({
            "explained": F.element_at(F.lit([float(v / trace) for v in values]), F.col("component")),
            "identity_error": F.lit(error)}), "whitened")


def _projected(rows: DataFrame, n: int, sums: list[int], to_white: np.ndarray) -> DataFrame:
    k = to_white.shape[1]

    def run(batches):
        for batch in batches:
            y = centred(batch.column("x"), n, sums)
            white = (y.astype(float) / n) @ to_white
            if y.dtype != object and len(y) and max(abs(int(y.max())), abs(int(y.min()))) ** 2 * y.shape[1] < 1 << 63:
                deviation = (y * y).sum(axis=1).tolist()
            else:
                exact = [sum(int(v) ** 2 for v in row) for row in y]
                deviation = [v if v < 1 << 63 else None for v in exact]
            at = np.repeat(np.arange(len(y)), k)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(at)), pa.array(np.tile(np.arange(1, k + 1), len(y)), pa.int32()),
                 pa.array(np.full(len(at), n)), pa.array(deviation, pa.int64()).take(pa.array(at)), pa.array(white.ravel())],
                names=["vec_id", "component", "n", "deviation", "whitened"])
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), "x").mapInArrow(run, WHITE_SCHEMA)


def op12(vectors: DataFrame) -> DataFrame:
    return whiten(vectors)
