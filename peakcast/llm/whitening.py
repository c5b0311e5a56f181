"""Embedding whitening from the bidiagonal form of the centred rows' triangular factor.

Tasks centre their rows and reduce them, block by block, to one triangular factor each (QR of the last factor on top
of the next block); the factors are combined in two levels, so the driver gets COMBINERS of them at most. The last one,
R, has the covariance R'R / n; the squares of R's entries are never formed. On the driver, which holds R alone (a
matrix of the vectors' length, MAX_DIM at most):

* Householder reflections from both sides reduce R to an upper bidiagonal B;
* differential quotient differences with shifts (dqds) find the squares of B's singular values;
* twisted factorisations of B'B less a singular value's square, met where the two sweeps leave the least residual, give
  the singular vectors. Values closer than CLUSTER (relative) are a cluster, whose vectors come from inverse iteration
  with the same factorisations, orthogonal to those found before.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

MAX_DIM = 2048
COMBINERS = 32
#: Rows that a task factors at a time.
BLOCK = 4096
CLUSTER = 1e-3
COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
#: Scaled entries are held within these bounds, so that a block's sums stay exact.
ENTRY_BOUND = 1 << 40
EPS = np.finfo(float).eps
TINY = np.finfo(float).tiny

SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


# ---- small dense algebra on the driver ------------------------------------------------------

def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal b, superdiagonal f, V) of a square ``r`` = U B V' with orthogonal U and V; U is not kept."""
    a, m = np.array(r, float), len(r)
    v = np.eye(m)

    def reflector(x):
        w = x.copy()
        scale = np.abs(x).max(initial=0.0)
        if scale == 0 or not np.any(x[1:]):
            return None
        w /= scale
        w[0] += np.copysign(np.linalg.norm(w), w[0])
        return w / np.linalg.norm(w)

    for k in range(m):
        w = reflector(a[k:, k])
        if w is not None:
            a[k:, k:] -= 2 * np.outer(w, w @ a[k:, k:])
            a[k + 1:, k] = 0
        if k < m - 2:
            w = reflector(a[k, k + 1:])
            if w is not None:
                a[k:, k + 1:] -= 2 * np.outer(a[k:, k + 1:] @ w, w)
                a[k, k + 2:] = 0
                v[:, k + 1:] -= 2 * np.outer(v[:, k + 1:] @ w, w)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def _trailing(q: list, e: list, lo: int, hi: int) -> float:
    """Smaller eigenvalue of the last two rows of the block's LU product, a good shift near convergence."""
    a, b = q[hi - 1] + (e[hi - 2] if hi - 2 >= lo else 0.0), q[hi] + e[hi - 1]
    product = q[hi - 1] * e[hi - 1]  # of the two entries off the diagonal
    larger = (a + b) / 2 + np.sqrt(((a - b) / 2) ** 2 + product)
    return max(0.0, (a * b - product) / larger) if larger > 0 else 0.0


def dqds(b: np.ndarray, f: np.ndarray) -> np.ndarray:
    """Squared singular values, falling, of the upper bidiagonal matrix with diagonal ``b`` and superdiagonal ``f``."""
    m = len(b)
    scale = max(np.abs(b).max(initial=0.0), np.abs(f).max(initial=0.0))
    if scale == 0:
        return np.zeros(m)
    q, e = [float(x) ** 2 for x in b / scale], [float(x) ** 2 for x in f / scale]
    found, blocks, tol = [], [(0, m - 1, 0.0)], (EPS * 4) ** 2
    while blocks:
        lo, hi, moved = blocks.pop()
        shift_cap = None
        while hi >= lo:
            if hi == lo:
                found.append(q[lo] + moved)
                break
            if e[hi - 1] <= tol * (moved + q[hi]) or e[hi - 1] <= TINY:
                found.append(q[hi] + moved)
                hi, shift_cap = hi - 1, None
                continue
            split = next((i for i in range(hi - 1, lo, -1) if e[i - 1] <= TINY or e[i - 1] <= tol * min(q[i - 1], q[i])), None)
            if split is not None:  # the upper part waits with the shift it has had so far
                blocks.append((lo, split - 1, moved))
                lo = split
                continue
            if 1.5 * q[lo] < q[hi]:  # small values converge at the end
                q[lo:hi + 1] = q[lo:hi + 1][::-1]
                e[lo:hi] = e[lo:hi][::-1]
            tau = _trailing(q, e, lo, hi)
            if shift_cap is not None:
                tau = min(tau, shift_cap)
            for attempt in range(4):
                tau = tau if attempt < 3 and tau > EPS * EPS else 0.0  # without a shift all quantities stay positive
                qn, en, d = [], [], q[lo] - tau
                for i in range(lo, hi):
                    if d < 0:
                        break
                    top = d + e[i]
                    t = q[i + 1] / top if top > 0 else 0.0
                    qn.append(top)
                    en.append(e[i] * t)
                    d = d * t - tau
                if len(qn) == hi - lo and d >= 0:
                    qn.append(d)
                    break
                # A failure at the very end tells how far the shift went beyond; an earlier one asks for a much smaller shift.
                tau = tau + d if len(qn) == hi - lo and tau + d > 0 else tau / 4
            shift_cap = min(qn) * 2 if tau == 0.0 else None
            q[lo:hi + 1], e[lo:hi] = qn, en
            moved += tau
    return np.sort(np.maximum(found, 0.0))[::-1] * scale * scale


class Twisted:
    """N D N' = B'B - value, twisted at the row where the stationary sweep from the top and the progressive sweep from
    the bottom leave the least residual."""

    def __init__(self, b: np.ndarray, f: np.ndarray, value: float):
        m = len(b)
        d = b * b
        low = f / b[:-1]
        guard = lambda x: x if abs(x) > TINY else TINY
        self.top, self.lower = np.zeros(m), np.zeros(max(m - 1, 0))
        self.bottom, self.upper = np.zeros(m), np.zeros(max(m - 1, 0))
        s, p = np.zeros(m), np.zeros(m)
        s[0] = -value
        for i in range(m - 1):
            self.top[i] = guard(s[i] + d[i])
            self.lower[i] = d[i] * low[i] / self.top[i]
            s[i + 1] = self.lower[i] * low[i] * s[i] - value
        p[m - 1] = d[m - 1] - value
        for i in range(m - 2, -1, -1):
            self.bottom[i + 1] = guard(d[i] * low[i] * low[i] + p[i + 1])
            t = d[i] / self.bottom[i + 1]
            self.upper[i] = low[i] * t
            p[i] = p[i + 1] * t - value
        gamma = s + p + value
        self.k = int(np.nanargmin(np.abs(gamma)))
        self.gamma = guard(gamma[self.k])

    def back(self, z: np.ndarray) -> np.ndarray:
        """N'^-1 z."""
        for i in range(self.k - 1, -1, -1):
            z[i] -= self.lower[i] * z[i + 1]
        for i in range(self.k, len(z) - 1):
            z[i + 1] -= self.upper[i] * z[i]
        return z

    def vector(self) -> np.ndarray:
        z = np.zeros(len(self.top))
        z[self.k] = 1.0
        z = self.back(z)
        return z / np.linalg.norm(z)

    def solve(self, x: np.ndarray) -> np.ndarray:
        w, k, m = x.copy(), self.k, len(x)
        for i in range(1, k):
            w[i] -= self.lower[i - 1] * w[i - 1]
        for i in range(m - 2, k, -1):
            w[i] -= self.upper[i] * w[i + 1]
        if k > 0:
            w[k] -= self.lower[k - 1] * w[k - 1]
        if k < m - 1:
            w[k] -= self.upper[k] * w[k + 1]
        pivots = np.concatenate([self.top[:k], [self.gamma], self.bottom[k + 1:]])
        z = self.back(w / pivots)
        size = np.abs(z).max()
        return z / size / np.linalg.norm(z / size) if 0 < size < np.inf else x


def singular_vectors(b: np.ndarray, f: np.ndarray, values: np.ndarray, count: int) -> np.ndarray:
    """Right singular vectors (columns) of the bidiagonal matrix for the ``count`` largest of its ``values`` (squared
    singular values, falling)."""
    scale = max(np.abs(b).max(), np.abs(f).max(initial=0.0))
    b, f, values = b / scale, f / scale, values / scale ** 2
    b = np.where(np.abs(b) < EPS * EPS, EPS * EPS, b)
    out: list[np.ndarray] = []
    rng = np.random.default_rng(11)
    first = 0
    for j in range(count):
        if j and values[j - 1] - values[j] > CLUSTER * values[j - 1]:
            first = j
        clustered = first < j or (j + 1 < len(values) and values[j] - values[j + 1] <= CLUSTER * values[j])
        twisted = Twisted(b, f, values[j] * (1 + 4 * EPS * (j - first)))
        if not clustered:
            out.append(twisted.vector())
            continue
        z = rng.standard_normal(len(b))
        for _ in range(4):
            for _ in range(2):
                for other in out[first:]:
                    z -= (other @ z) * other
            z = twisted.solve(z / np.linalg.norm(z))
        for _ in range(2):
            for other in out[first:]:
                z -= (other @ z) * other
            z /= np.linalg.norm(z)
        out.append(z)
    return np.array(out).T.reshape(len(b), count)


def principal(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(all squared singular values, falling; those of the first ``count`` that are not zero; their unit right singular
    vectors as columns) of a square matrix. A value at rounding level of the largest is zero."""
    b, f, v = bidiagonalise(r)
    values = dqds(b, f)
    found = int((values[:count] > (EPS * len(r)) ** 2 * max(values[0], TINY)).sum()) if len(values) else 0
    if not found:
        return values, np.zeros(0), np.zeros((len(r), 0))
    vectors = v @ singular_vectors(b, f, values, found)
    return values, values[:found], vectors / np.linalg.norm(vectors, axis=0)


# ---- the rows, on Spark ---------------------------------------------------------------------

def fit_vectors(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, x array<long>): rows whose vector is not null and holds finite entries only, scaled to integers."""
    e = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    bound = float(ENTRY_BOUND)
    x = F.transform("v", lambda c: F.floor(F.least(F.greatest(c * SCALE, F.lit(-bound)), F.lit(bound))).cast("long") + SHIFT)
    return e.filter(F.col("v").isNotNull() & (F.size("v") > 0) & fine).select("vec_id", x.alias("x"))


def _rows(b: pa.RecordBatch, width: int, at: int):
    """The batch's vectors as an integer matrix, ``BLOCK`` rows at a time."""
    for lo in range(0, len(b), BLOCK):
        part = b.slice(lo, BLOCK)
        yield part, np.asarray(part.column(at).flatten(), np.int64).reshape(len(part), width)


class Moments:
    """Exact sums of the fit list and, from them, centred rows."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.whole = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([float(Fraction(s % n, n)) for s in sums])

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(float) - self.rest

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2 for each row, exactly; None beyond 64 bits."""
        rest = np.array([s % self.n for s in self.sums], object if self.n > 1 << 30 else np.int64)
        gap = x - self.whole
        far = (int(np.abs(gap).max(initial=0)) + 1) * self.n
        if far * far * x.shape[1] < 1 << 62:
            return ((gap * self.n - rest) ** 2).sum(axis=1).tolist()
        exact = ((gap.astype(object) * self.n - rest) ** 2).sum(axis=1)
        return [int(d) if d < 1 << 63 else None for d in exact]


def moments(fit: DataFrame, width: int) -> Moments | None:
    """Row count and sum of each dimension: partial sums in tasks, ``width`` rows to the driver."""

    def work(batches):
        for b in batches:
            for part, x in _rows(b, width, 0):
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(x.sum(axis=0)),
                                                  pa.array(np.full(width, len(part), np.int64))], names=["dim", "s", "n"])

    rows = (fit.select("x").mapInArrow(work, "dim int, s long, n long").groupBy("dim")
            .agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")).orderBy("dim").collect())
    return Moments(rows[0]["n"], [int(r["s"]) for r in rows]) if rows else None


def triangular_factor(fit: DataFrame, width: int, m: Moments) -> np.ndarray:
    """R (width x width) with R'R = sum of the centred rows' products: one factor for each task, then for each of
    COMBINERS groups of tasks, then on the driver."""

    def reduced(held: np.ndarray | None, rows: np.ndarray) -> np.ndarray:
        return np.linalg.qr(rows if held is None else np.vstack([held, rows]), mode="r")

    def batch(r: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r.astype(float).tobytes()], pa.binary())], names=["r"])

    def factor(batches):
        held = None
        for b in batches:
            for _, x in _rows(b, width, 0):
                held = reduced(held, m.centred(x))
        if held is not None:
            yield batch(held)

    def combine(batches):
        held = None
        for b in batches:
            for r in b.column(0).to_pylist():
                held = reduced(held, np.frombuffer(r, float).reshape(-1, width))
        if held is not None:
            yield batch(held)

    parts = fit.select("x").mapInArrow(factor, "r binary").repartition(COMBINERS).mapInArrow(combine, "r binary")
    held = None
    for row in parts.toLocalIterator():
        held = reduced(held, np.frombuffer(row["r"], float).reshape(-1, width))
    out = np.zeros((width, width))
    out[:len(held)] = held
    return out


def whiten(embeddings: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, component (from 1, by falling variance), n, deviation, whitened, explained, identity_error: a row for each
    kept row of ``embeddings`` and each component.

    Dropped are vectors that are null, empty or hold null or non-finite entries, and those whose length is not the
    most frequent one (ties: the greatest). Repeated rows and null ids count and return as often as they stand. Entries
    beyond 2^40 / 1024 are held at that bound; a deviation beyond 64 bits is null. Components without variance (fewer
    vectors than dimensions, constant dimensions, one vector alone) are left out, so there may be fewer than
    ``components``, or none and no rows; the same for an empty table. Vectors longer than MAX_DIM raise an error, since
    the driver factors a square matrix of their length.
    """
    spark = embeddings.sparkSession
    fit = stored(fit_vectors(embeddings, id_col, vector_col), "whitening")
    sizes = fit.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).head(1)
    if not sizes:
        return spark.createDataFrame([], SCHEMA)
    width = sizes[0]["d"]
    if width > MAX_DIM:
        raise ValueError(f"vectors of length {width}: {MAX_DIM} at most")
    fit = fit.filter(F.size("x") == width)
    m = moments(fit, width)
    values, kept, vectors = principal(triangular_factor(fit, width, m), components)
    count = len(kept)
    if not count:
        return spark.createDataFrame([], SCHEMA)
    explained = kept / values.sum()
    to_white = vectors * np.sqrt(m.n / kept)

    def products(batches):  # of the whitened values and their sums, for the covariance of what is returned
        for b in batches:
            total = np.zeros((count + 1, count))
            for _, x in _rows(b, width, 0):
                w = m.centred(x) @ to_white
                total[:count] += w.T @ w
                total[count] += w.sum(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.reshape(-1))], names=["at", "s"])

    rows = fit.select("x").mapInArrow(products, "at int, s double").groupBy("at").agg(F.sum("s").alias("s")).orderBy("at").collect()
    total = np.array([r["s"] for r in rows]).reshape(count + 1, count) / m.n
    error = float(np.abs(total[:count] - np.outer(total[count], total[count]) - np.eye(count)).max())

    def project(batches):
        for b in batches:
            for part, x in _rows(b, width, 1):
                w = m.centred(x) @ to_white
                far = pa.array(m.deviations(x), pa.int64())
                row = np.repeat(np.arange(len(part)), count)
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(row)), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(part))),
                    pa.array(np.full(len(row), m.n, np.int64)), far.take(pa.array(row)), pa.array(w.reshape(-1)),
                    pa.array(np.tile(explained, len(part))), pa.array(np.full(len(row), error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return fit.select("vec_id", "x").mapInArrow(project, SCHEMA)
