"""Operator 13 — embedding whitening by QDWH spectral divide and conquer.

Entries become integers (256 steps a unit), so that counts, sums and deviations are
exact. Distinct vectors are the fit list: one aggregate, reduced inside tasks, so copies
of one vector cost one row per task. Two passes over the written list give the sums and
then the centred products; both are added up by (row, column) in Spark, and the driver
receives one sum per dimension and one per pair of dimensions (at most ``MAX_DIM``).

The covariance is diagonalised by spectral divide and conquer. The polar factor U of the
shifted matrix (dynamically weighted Halley steps, each one QR factorisation) gives the
projector (U + I) / 2 on the eigenvalues above the shift; an orthonormal basis of its
range and of its complement splits the matrix into two blocks, which are split again
until blocks are single numbers or multiples of the identity. A last first-order step
removes what rounding left beside the diagonal. Means and components, a matrix of
bounded size, go to the tasks, which whiten all rows without a shuffle.

Defined cases: null vectors and vectors with null or non-finite entries are dropped.
Vectors shorter than the longest get zeros behind. Entries beyond the range of a long
are set to its ends; a deviation that no long holds is null. Components whose eigenvalue
is at most the dimension times machine precision times the largest have no finite
scale: their whitened value is 0 and the identity is not expected of them. Equal
eigenvalues: any orthonormal basis of their space, the same for all rows. A component's
largest entry (the first on a tie) is positive. Repeated rows are whitened alike; rows
keep their other columns in ``row``, whatever their names; an empty table, or one
without a usable vector, gives an empty result.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from rankmill.session import checkpoint_dir

STEPS = 256
MAX_DIM = 4096
BLOCK_ROWS = 4096
EPS = float(np.finfo(float).eps)


# ------------------------------------------------------- spectral divide and conquer
def polar(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix by QDWH: dynamically weighted Halley steps in QR form."""
    d = len(a)
    norm = np.linalg.norm(a, 2) if d <= 2 else min(np.linalg.norm(a), float(np.sqrt(np.linalg.norm(a, 1) * np.linalg.norm(a, np.inf))))
    x = a / norm
    low = EPS / math.sqrt(d)  # no singular value that matters lies below it
    eye = np.eye(d)
    for _ in range(60):
        l2 = low * low
        dd = (4.0 * (1.0 - l2) / (l2 * l2)) ** (1.0 / 3.0) if low < 1.0 else 0.0
        wa = math.sqrt(1.0 + dd) + 0.5 * math.sqrt(max(0.0, 8.0 - 4.0 * dd + 8.0 * (2.0 - l2) / (l2 * math.sqrt(1.0 + dd))))
        wb = (wa - 1.0) ** 2 / 4.0
        wc = wa + wb - 1.0
        q, _ = np.linalg.qr(np.vstack([math.sqrt(wc) * x, eye]))
        new = wb / wc * x + (wa - wb / wc) / math.sqrt(wc) * (q[:d] @ q[d:].T)
        low = min(1.0, low * (wa + wb * l2) / (1.0 + wc * l2))
        moved = np.linalg.norm(new - x)
        x = (new + new.T) / 2.0
        if abs(1.0 - low) < 10.0 * EPS and moved < (10.0 * EPS) ** (1.0 / 3.0):
            break
    return x


def _range_basis(p: np.ndarray, k: int) -> np.ndarray:
    """Orthogonal matrix whose first k columns span the range of the projector p.

    The columns of p with most weight left are taken one after the other (a pivoted
    orthogonalisation), then one subspace step and a full QR clean them up.
    """
    d = len(p)
    rest = p.copy()
    picked = []
    for _ in range(k):
        weight = (rest * rest).sum(axis=0)
        j = int(np.argmax(weight))
        picked.append(j)
        v = rest[:, j] / math.sqrt(weight[j])
        rest -= np.outer(v, v @ rest)
    q, _ = np.linalg.qr(p[:, picked])
    q, _ = np.linalg.qr(p @ q)
    full, _ = np.linalg.qr(np.hstack([q, np.eye(d)]))
    return np.hstack([q, full[:, k:d]]) if k < d else q


def _split(a: np.ndarray) -> tuple[np.ndarray, int] | None:
    """(orthogonal basis, k): the first k columns span the eigenvalues above a shift; None if no shift separates."""
    d = len(a)
    diag = np.sort(np.diag(a))
    mean = float(np.trace(a)) / d
    spread = np.linalg.norm(a - mean * np.eye(d))
    tries = [float(np.median(diag)), mean, *(mean + spread * t / math.sqrt(d) for t in (0.01, -0.01, 0.1, -0.1, 0.37, -0.37, 0.73, -0.73))]
    for shift in tries:
        u = polar(a - shift * np.eye(d))
        k = round((float(np.trace(u)) + d) / 2.0)
        if 0 < k < d and np.linalg.norm(u @ u - np.eye(d)) < 1e-10 * d:
            basis = _range_basis((u + np.eye(d)) / 2.0, k)
            cut = basis.T @ a @ basis
            if np.linalg.norm(cut[:k, k:]) <= 1e-10 * spread:
                return basis, k
    return None


def _rotate_pair(a: np.ndarray) -> np.ndarray:
    """Eigenvectors of a symmetric 2 x 2 matrix."""
    angle = 0.5 * math.atan2(2.0 * a[0, 1], a[0, 0] - a[1, 1])
    c, s = math.cos(angle), math.sin(angle)
    return np.array([[c, -s], [s, c]])


def _divide(a: np.ndarray, scale: float) -> np.ndarray:
    d = len(a)
    if d == 1 or np.linalg.norm(a - np.trace(a) / d * np.eye(d)) <= 4.0 * EPS * scale:
        return np.eye(d)
    if d == 2:
        return _rotate_pair(a)
    cut = _split(a)
    if cut is None:  # what separates the rest is rounding
        return np.eye(d)
    basis, k = cut
    inner = basis.T @ a @ basis
    inner = (inner + inner.T) / 2.0
    out = np.empty((d, d))
    out[:, :k] = basis[:, :k] @ _divide(inner[:k, :k], scale)
    out[:, k:] = basis[:, k:] @ _divide(inner[k:, k:], scale)
    return out


def spectral(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, falling; unit eigenvectors in columns) of a symmetric matrix."""
    d = len(a)
    scale = float(np.linalg.norm(a))
    if d == 0 or scale == 0.0:
        return np.zeros(d), np.eye(d)
    q = _divide(a, scale)
    for _ in range(2):  # first-order step: e[i] - e[j] far apart against the entry between them
        inner = q.T @ a @ q
        e = np.diag(inner)
        gap = e[None, :] - e[:, None]
        turn = np.where(np.abs(gap) > 1e3 * EPS * scale, inner / np.where(gap == 0, 1.0, gap), 0.0)
        turn[np.abs(turn) > 1e-3] = 0.0
        np.fill_diagonal(turn, 0.0)
        q, r = np.linalg.qr(q + q @ turn)
        q = q * np.sign(np.diag(r))
    e = np.einsum("ij,ik,kj->j", q, a, q)
    order = np.argsort(-e, kind="stable")
    q = q[:, order]
    top = np.argmax(np.abs(q), axis=0)
    return e[order], q * np.sign(q[top, np.arange(d)])


# ------------------------------------------------------------------------ Spark side
def quantised(vector: Column) -> Column:
    """floor(STEPS * entry) of every entry as long."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(STEPS))))


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == F.lit(float("inf"))))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column as int64, zeros behind the shorter ones."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(sizes) and (sizes == dim).all():
        return flat.reshape(len(sizes), dim)
    out = np.zeros((len(sizes), dim), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    first = np.cumsum(sizes) - sizes
    out[row, np.arange(len(flat)) - first[row]] = flat
    return out


def _blocks(batches, dim: int):
    for b in batches:
        for lo in range(0, b.num_rows, BLOCK_ROWS):
            part = b.slice(lo, BLOCK_ROWS)
            yield part, _matrix(part.column(b.num_columns - 1), dim)


@dataclass(frozen=True)
class Whitening:
    """n distinct vectors with sums per dimension; components in rows, with their eigenvalues."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    @property
    def scale(self) -> np.ndarray:
        """1 / sqrt(eigenvalue); 0 for components without spread."""
        floor = len(self.sums) * EPS * max(0.0, float(self.values[0])) if len(self.values) else 0.0
        return np.where(self.values > floor, 1.0 / np.sqrt(np.where(self.values > floor, self.values, 1.0)), 0.0)

    def whiten(self, x: np.ndarray, top: int) -> np.ndarray:
        return (x - self.mean) @ self.components[:top].T * self.scale[:top]

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n x - S)^2 per row, exact."""
        most = np.abs(x).max(axis=1, initial=0).astype(float) * self.n + max(map(abs, self.sums), default=0)
        easy = most * most * max(1, x.shape[1]) < 2.0**62
        out: list[int | None] = [None] * len(x)
        sums = np.array(self.sums, object)
        if easy.any():
            moved = x[easy] * np.int64(self.n) - sums.astype(np.int64)
            for at, v in zip(np.flatnonzero(easy), (moved * moved).sum(axis=1).tolist(), strict=True):
                out[at] = v
        for at in np.flatnonzero(~easy):
            v = int(sum((int(c) * self.n - s) ** 2 for c, s in zip(x[at], self.sums, strict=True)))
            out[at] = v if v < 1 << 63 else None
        return out


def fit(vectors: DataFrame) -> tuple[Whitening, DataFrame] | None:
    """Whitening of the distinct arrays in column ``x``, and the written fit list; None without a vector."""
    spark = vectors.sparkSession
    table = f"{checkpoint_dir(spark)}/whitening-{uuid.uuid4().hex}"
    vectors.groupBy("x").agg(F.lit(1).alias("one")).select("x").write.parquet(table)
    listed = spark.read.parquet(table)
    n, dim = listed.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    if not n:
        return None
    if dim > MAX_DIM:
        raise ValueError(f"vectors have {dim} entries; at most {MAX_DIM} are supported")

    def sums(batches):
        total = np.zeros(dim, object)
        for _, x in _blocks(batches, dim):
            small = np.abs(x).max(initial=0) < 1 << 40
            total = total + (x.sum(axis=0) if small else x.astype(object).sum(axis=0)).astype(object)
        yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array([str(t) for t in total], pa.string())], ["i", "s"])

    got = listed.mapInArrow(sums, "i int, s string").groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    totals = [0] * dim
    for r in got.collect():  # one row per dimension
        totals[r["i"]] = int(r["s"])
    mean = np.array([t / n for t in totals])

    def products(batches):
        gram = np.zeros((dim, dim))
        for _, x in _blocks(batches, dim):
            c = x - mean
            gram += c.T @ c
        i, j = np.triu_indices(dim)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(gram[i, j])], ["i", "j", "g"])

    pairs = listed.mapInArrow(products, "i int, j int, g double").groupBy("i", "j").agg(F.sum("g").alias("g"))
    cov = np.zeros((dim, dim))
    for r in pairs.collect():  # one row per pair of dimensions
        cov[r["i"], r["j"]] = cov[r["j"], r["i"]] = r["g"] / n
    values, vectors_ = spectral(cov)
    return Whitening(n, totals, values, vectors_.T.copy(), float(np.trace(cov))), listed


def identity_error(model: Whitening, listed: DataFrame, top: int) -> float:
    """Largest entry of the whitened fit list's covariance minus the identity, measured on the list."""
    dim = len(model.sums)

    def products(batches):
        gram = np.zeros((top, top))
        for _, x in _blocks(batches, dim):
            w = model.whiten(x, top)
            gram += w.T @ w
        i, j = np.indices((top, top)).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(gram[i, j])], ["i", "j", "g"])

    cov = np.zeros((top, top))
    for r in listed.mapInArrow(products, "i int, j int, g double").groupBy("i", "j").agg(F.sum("g").alias("g")).collect():
        cov[r["i"], r["j"]] = r["g"] / model.n
    want = np.diag((model.scale[:top] > 0).astype(float))  # whitened values of the list have mean 0
    return float(np.abs(cov - want).max(initial=0.0))


def whiten(df: DataFrame, vector: str = "embedding", top: int | None = None) -> DataFrame:
    """(row, deviation, whitened array, explained array, n, identity_error): one row per usable vector.

    ``row`` holds the columns of ``df``; ``top`` is the number of components (None: all).
    """
    col = F.col(f"`{vector}`")
    rows = df.filter(usable(col)).select(F.struct("*").alias("row"), quantised(col).alias("x"))
    field = StructField("row", rows.schema["row"].dataType)
    more = StructType.fromDDL("deviation long, whitened array<double>, explained array<double>, n long, identity_error double").fields
    schema = StructType([field, *more])
    fitted = fit(rows.select("x"))
    if fitted is None:
        return df.sparkSession.createDataFrame([], schema)
    model, listed = fitted
    dim = len(model.sums)
    k = dim if top is None else min(top, dim)
    error = identity_error(model, listed, k)
    explained = (model.values[:k] / model.trace if model.trace > 0 else np.zeros(k)).tolist()

    def run(batches):
        for part, x in _blocks(batches, dim):
            m = part.num_rows
            w = model.whiten(x, k)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(m + 1) * k, pa.int32()), pa.array(w.reshape(-1)))
            columns = [part.column(0), pa.array(model.deviations(x), pa.int64()), lists, pa.array([explained] * m, pa.list_(pa.float64())), pa.array([model.n] * m, pa.int64()), pa.array([error] * m, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["row", "deviation", "whitened", "explained", "n", "identity_error"])

    return rows.mapInArrow(run, schema)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: the first four components of every usable embedding."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    out = whiten(rows, top=4)
    each = out.select(F.col("row.vec_id").alias("vec_id"), "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c"))
    return each.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", F.col("c.whitened").alias("whitened"), F.col("c.explained").alias("explained"), "identity_error")
