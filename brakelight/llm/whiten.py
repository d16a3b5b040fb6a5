"""Whitening of embeddings: exact integer moments on Spark, leading components by spectrum slicing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import scratch_table

OFFSET, SCALE, BOUND = 1_000_000, 64, float(2**62)
EPS = float(np.finfo(float).eps)


def inertia(a: np.ndarray, shift: float) -> int:
    """Number of eigenvalues of the symmetric ``a`` above ``shift``: positive pivots of LDL^T of a - shift I.

    Symmetric pivoting with blocks of one or two rows (Bunch and Kaufman) keeps the factors bounded. A block of
    two that is chosen this way has one positive and one negative eigenvalue. A pivot of zero counts as not above.
    """
    m = a - shift * np.eye(len(a))
    alpha, above, k, n = (1 + 17 ** 0.5) / 8, 0, 0, len(a)
    while k < n:
        col = np.abs(m[k + 1:, k])
        size, top = 1, col.max(initial=0.0)
        if top > 0 and abs(m[k, k]) < alpha * top:
            r = k + 1 + int(col.argmax())
            row = np.abs(m[r, k:])
            row[r - k] = 0.0
            other = row.max()
            if abs(m[k, k]) * other < alpha * top * top:
                if abs(m[r, r]) >= alpha * other:
                    _swap(m, k, r)
                else:
                    size = 2
                    _swap(m, k + 1, r)
        if size == 1:
            pivot = m[k, k]
            above += pivot > 0
            if pivot != 0:
                low = m[k + 1:, k].copy()
                m[k + 1:, k + 1:] -= np.outer(low / pivot, low)
        else:
            above += 1
            block, low = m[k:k + 2, k:k + 2].copy(), m[k + 2:, k:k + 2].copy()
            det = block[0, 0] * block[1, 1] - block[0, 1] ** 2
            inverse = np.array([[block[1, 1], -block[0, 1]], [-block[0, 1], block[0, 0]]]) / det
            m[k + 2:, k + 2:] -= low @ inverse @ low.T
        k += size
    return above


def _swap(m: np.ndarray, i: int, j: int) -> None:
    if i != j:
        m[[i, j]] = m[[j, i]]
        m[:, [i, j]] = m[:, [j, i]]


class Slices:
    """Leading eigenpairs of a symmetric positive semi-definite matrix by slicing its spectrum."""

    def __init__(self, a: np.ndarray):
        self.norm = float(np.abs(a).sum(axis=1).max(initial=0.0))
        self.a = a / self.norm if self.norm else a
        #: counts of eigenvalues above a shift that are known so far, by shift; bounds by Gershgorin's circles
        self.known = {-0.1: len(a), 1.1: 0}

    def above(self, shift: float) -> int:
        if shift not in self.known:
            self.known[shift] = inertia(self.a, shift)
        return self.known[shift]

    def isolate(self, k: int) -> tuple[float, float]:
        """An interval that holds eigenvalue k (from 1, falling) alone, or a cluster no wider than rounding."""
        low = max(s for s, c in self.known.items() if c >= k)
        high = min(s for s, c in self.known.items() if c < k)
        while self.above(low) - self.above(high) > 1 and high - low > 8 * EPS * len(self.a):
            mid = (low + high) / 2
            if self.above(mid) >= k:
                low = mid
            else:
                high = mid
        return low, high

    def _solve(self, shift: float, v: np.ndarray) -> np.ndarray:
        eye = np.eye(len(self.a))
        for step in range(8):
            try:
                y = np.linalg.solve(self.a - shift * eye, v)
            except np.linalg.LinAlgError:
                y = np.full_like(v, np.inf)
            if np.isfinite(y).all():
                return y / np.linalg.norm(y)
            shift += EPS * 2.0 ** step
        raise ArithmeticError("shifted matrix could not be solved")

    def pair(self, k: int, found: np.ndarray) -> tuple[float, np.ndarray]:
        """Eigenvalue k and its unit vector, orthogonal to the vectors ``found`` before (columns)."""
        low, high = self.isolate(k)
        start = np.random.default_rng(k).standard_normal(len(self.a))

        def free(v):
            for _ in range(2):
                v = v - found @ (found.T @ v)
            return v / np.linalg.norm(v)

        tol = 4 * EPS * len(self.a)
        for _ in range(60):
            # two steps of inverse iteration at the middle of the slice choose its vector, Rayleigh quotients refine it
            v = free(start)
            for _ in range(2):
                v = free(self._solve((low + high) / 2, v))
            for _ in range(12):
                mu = float(v @ self.a @ v)
                if not low - tol <= mu <= high + tol:
                    break
                if np.linalg.norm(self.a @ v - mu * v) <= tol:
                    v = free(v)
                    # certificate: k - 1 eigenvalues lie above, k from just below
                    if self.above(mu + 4 * tol) <= k - 1 and self.above(mu - 4 * tol) >= k:
                        return mu * self.norm, v
                    break
                v = free(self._solve(mu, v))
            mid = (low + high) / 2
            if high - low <= EPS:
                break
            if self.above(mid) >= k:
                low = mid
            else:
                high = mid
        raise ArithmeticError(f"eigenvalue {k} could not be certified")

    def leading(self, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Up to ``most`` eigenvalues above rounding, falling, and their vectors as columns."""
        n = len(self.a)
        vectors, values = np.zeros((n, 0)), []
        rank = self.above(16 * EPS * n) if self.norm else 0
        for k in range(1, min(most, rank) + 1):
            e, v = self.pair(k, vectors)
            v = v * (1 if v[np.abs(v).argmax()] > 0 else -1)
            vectors, values = np.column_stack([vectors, v]), [*values, e]
        return np.array(values), vectors


def lattice(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, x): the vector on the integer lattice; rows with null vectors, or null or non-finite entries, are left out."""
    v = F.col(vec_col).cast("array<double>")
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    x = F.transform(v, lambda c: F.floor(F.greatest(F.least(c * SCALE, F.lit(BOUND)), F.lit(-BOUND))) + OFFSET)
    return vectors.filter(F.col(vec_col).isNotNull()).filter(~bad & (F.size(vec_col) > 0)).select(
        F.col(id_col).alias("id"), x.alias("x"))


def _matrix(column, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, d)


class Moments:
    """Centre of the fit list: n, exact sums, and rows relative to the mean without loss."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.whole = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([s - n * (s // n) for s in sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(float) - self.rest / self.n

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """sum (n x - S)^2 per row, exact; None where it does not fit in a long."""
        dx = x - self.whole
        most = int(max(dx.max(initial=0), -int(dx.min(initial=0)))) + 1
        if x.shape[1] * (self.n * most) ** 2 < 2**63:
            v = dx * self.n - self.rest
            return (v * v).sum(axis=1).tolist()
        out = []
        for row in dx.tolist():
            total = sum((self.n * a - b) ** 2 for a, b in zip(row, self.rest.tolist()))
            out.append(total if total < 2**63 else None)
        return out


def _sums(fit: DataFrame, d: int) -> Moments | None:
    """Exact n and sums: halves of 31 bits are summed per task, and over the tasks by Spark."""
    def run(batches):
        n, high, low = 0, [0] * d, [0] * d
        for b in batches:
            x = _matrix(b.column(0), d)
            n += len(x)
            high = [a + int(c) for a, c in zip(high, (x >> 31).sum(axis=0))]
            low = [a + int(c) for a, c in zip(low, (x & 0x7FFFFFFF).sum(axis=0))]
        rows = [(j, n, (h << 31) + w) for j, (h, w) in enumerate(zip(high, low))] if n else []
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()),
                                          pa.array([str(r[2]) for r in rows], pa.string())], names=["j", "n", "s"])

    parts = fit.mapInArrow(run, "j int, n long, s string")
    total = parts.groupBy("j").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    rows = sorted(total.collect())  # one row per dimension
    return Moments(rows[0]["n"], [int(r["s"]) for r in rows]) if rows else None


def _gram(fit: DataFrame, d: int, width: int, project) -> np.ndarray:
    """Sum over the fit list of y y^T and, as the last row, of y, for y = project(x). Tasks send one matrix each."""
    def run(batches):
        total, any_rows = np.zeros((width + 1, width)), False
        for b in batches:
            y = project(_matrix(b.column(0), d))
            total[:width] += y.T @ y
            total[width] += y.sum(axis=0)
            any_rows = any_rows or len(y) > 0
        from pyspark import TaskContext

        k = width + 1 if any_rows else 0
        yield pa.RecordBatch.from_arrays([
            pa.array(np.arange(k, dtype=np.int32)), pa.array(np.full(k, TaskContext.get().partitionId(), np.int32)),
            pa.array(list(total[:k]), pa.list_(pa.float64()))], names=["i", "part", "row"])

    def add(batches):
        rows = {}
        for b in batches:
            for i, row in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                rows[i] = rows.get(i, 0.0) + np.array(row)
        yield pa.RecordBatch.from_arrays([pa.array(list(rows), pa.int32()), pa.array(list(rows.values()), pa.list_(pa.float64()))],
                                         names=["i", "row"])

    parts = fit.mapInArrow(run, "i int, part int, row array<double>")
    # the same order of additions in every run: partition by partition
    summed = parts.repartition("i").sortWithinPartitions("i", "part").mapInArrow(add, "i int, row array<double>")
    return np.array([r["row"] for r in sorted(summed.collect())])  # width + 1 rows, whatever the input


def whiten(vectors: DataFrame, components: int = 16, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Per row and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Entries become the longs floor(64 c) + 1,000,000 (64 c is held within 2^62). The fit list is every distinct
    vector once; its covariance (centred, divisor n) gives the components, numbered by falling eigenvalue, with the
    largest entry of each positive. ``whitened`` is the centred row projected on a component over the root of its
    eigenvalue; ``explained`` its share of the trace; ``deviation`` is the exact sum of (n x - S)^2, null where it
    exceeds a long; ``identity_error`` is the largest entry of the whitened fit list's covariance minus the identity,
    measured in a pass of its own.

    Rows with a null or empty vector, or null or non-finite entries, are left out, as are rows of another length
    than the most frequent (ties: the shorter). Repeated rows and null ids are returned as often as they occur. Components
    without variance cannot be whitened and are left out, so a table of one distinct vector, like an empty
    one, gives no rows. Further columns are ignored.

    Tasks hold one Arrow batch and a matrix of dimension x dimension; the driver gets two such matrices.
    """
    rows = lattice(vectors, id_col, vec_col)
    schema = T.StructType([T.StructField(id_col, vectors.schema[id_col].dataType)])
    for name, kind in (("component", "integer"), ("n", "long"), ("deviation", "long"), ("whitened", "double"),
                       ("explained", "double"), ("identity_error", "double")):
        schema = schema.add(name, kind)
    spark = vectors.sparkSession
    most = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if most is None:
        return spark.createDataFrame([], schema)
    d = most["d"]
    rows = rows.filter(F.size("x") == d)
    fit = scratch_table(rows.select("x").distinct(), "whiten-fit")
    at = _sums(fit, d)
    cov = _gram(fit, d, d, at.centred)[:d] / at.n
    trace = float(np.trace(cov))
    values, axes = Slices((cov + cov.T) / 2).leading(min(components, d))
    k = len(values)
    if not k:
        return spark.createDataFrame([], schema)
    project = axes / np.sqrt(values)

    def whitened(x):
        return at.centred(x) @ project

    total = _gram(fit, d, k, whitened) / at.n
    error = float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())
    explained = values / trace

    def run(batches):
        for big in batches:
            for start in range(0, big.num_rows, 2000):
                b = big.slice(start, 2000)
                x = _matrix(b.column(1), d)
                m, y = len(x), whitened(x)
                ids = b.column(0).take(pa.array(np.repeat(np.arange(m), k)))
                dev = pa.array(at.deviation(x), pa.int64()).take(pa.array(np.repeat(np.arange(m), k)))
                yield pa.RecordBatch.from_arrays([
                    ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, at.n)), dev,
                    pa.array(y.ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))], names=schema.names)

    return rows.mapInArrow(run, schema)
