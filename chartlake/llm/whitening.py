"""Embedding whitening: principal components at unit variance.

The covariance is summed over all rows in Spark, each vector centred first.
Its eigenvectors are found in 32-bit floats and corrected in extended
precision by the matrix products of Ogita and Aishima's iteration; vectors of
eigenvalues too close to be told apart by it are separated by an eigenproblem
of their own, shifted by the cluster's mean.

Entries are whole numbers ``x = floor(64 c) + 1000000``, so sums and distances
to the mean are exact; the mean's whole part is taken off as a whole number,
its fraction as a double.

Defined results: rows whose vector is null, or holds a null or non-finite
entry, are left out; a shorter vector counts as filled up with zeros; equal
rows and null or repeated ids count each; a component without variance (its
eigenvalue within rounding of 0) has null ``whitened`` and ``explained`` 0; an
empty table gives no rows; other columns aren't read. An entry of 2^40 or more,
or a squared distance beyond 64 bits, is an error, never a wrapped number. The
driver holds matrices of dimension x dimension, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPONENTS = 32
SCALE, SHIFT = 64.0, 1_000_000
#: Entries from here on are refused.
LARGEST = 2.0 ** 40
#: Vectors written as rows at once.
ROWS = 4096
#: Residuals (of a matrix of size 1) under which the refinement ends, or ends if it helps no more.
DONE, NOISE = 2.0 ** -57, 2.0 ** -48
#: Eigenvalues closer than so many times the error of S form a cluster: a correction stays below 1 / APART.
APART = 1000
#: Corrections after which an unfinished refinement is an error.
STEPS = 20


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """The vectors of a batch as rows of x (64-bit integers)."""
    lengths = pc.list_value_length(column).to_numpy()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(flat) and np.abs(flat).max() >= LARGEST:
        raise ValueError(f"an embedding has an entry of {LARGEST:g} or more")
    c = np.zeros((len(lengths), width))
    c[np.arange(width) < lengths[:, None]] = flat
    return np.floor(SCALE * c).astype(np.int64) + SHIFT


def _summed(vectors: DataFrame, width: int, kind: str, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all rows of ``part`` of a batch's matrix: one array a task, added up by Spark."""
    dtype = np.int64 if kind == "long" else np.float64

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                one = part(_matrix(batch.column(0), width))
                total = one if total is None else total + one
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size), pa.int32()),
                                              pa.array(total.ravel().astype(dtype))], names=["place", "value"])

    rows = vectors.select("__vector").mapInArrow(add, f"place int, value {kind}").groupBy("place").agg(
        F.sum("value").alias("value")).orderBy("place").collect()
    return np.array([r.value for r in rows], dtype)


class Centre:
    """The mean S / n as a whole number and a fraction, so that centring loses nothing."""

    def __init__(self, n: int, sums: np.ndarray) -> None:
        self.n, self.sums = n, sums
        self.whole = sums // n
        self.fraction = (sums - n * self.whole) / n

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.fraction

    def deviation(self, x: np.ndarray) -> np.ndarray:
        """Sum over the dimensions of (n x - S)^2, exact."""
        apart = x - self.whole
        most = (np.abs(apart).max(initial=0) + 1) * float(self.n)
        if most ** 2 * x.shape[1] < 2.0 ** 62:
            return ((apart * self.n - (self.sums - self.n * self.whole)) ** 2).sum(axis=1)
        exact = ((apart.astype(object) * self.n - (self.sums - self.n * self.whole).astype(object)) ** 2).sum(axis=1)
        if max(exact) >= 2 ** 63:
            raise OverflowError("a squared distance to the mean is beyond 64 bits")
        return exact.astype(np.int64)


def refine(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of the symmetric matrix ``a``.

    Starts from 32-bit eigenvectors. With X near the eigenvectors, R = I - X'X
    and S = X'AX tell how far X is from orthonormal and from diagonalising; the
    correction X <- X + X E has E = (S + l R) / gap where the eigenvalues lie
    further apart than the error of S, R / 2 where they don't. Those clusters
    are turned by the eigenvectors of their own small matrix.
    """
    size = np.abs(a).max(initial=0.0)
    if size == 0:
        return np.zeros(len(a)), np.eye(len(a))
    exact = a.astype(np.longdouble) / size
    x = np.linalg.eigh((a / size).astype(np.float32))[1].astype(np.longdouble)
    eye, norm = np.eye(len(a), dtype=np.longdouble), np.linalg.norm(a / size, 2)
    last = np.inf
    for _ in range(STEPS):
        r = eye - x.T @ x
        s = x.T @ (exact @ x)
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(np.diag(s))
        wrong = s + values[None, :] * r
        left = float(max(np.abs(wrong - np.diag(np.diag(wrong))).max(), np.abs(r).max()))
        if left < DONE or (left < NOISE and left > last / 2):
            break  # beyond doubles, or no longer falling: as exact as this machine's products
        last = left
        error = 2 * (np.linalg.norm(off.astype(np.float64), 2) + norm * np.linalg.norm(r.astype(np.float64), 2))
        gap = values[None, :] - values[:, None]
        group = _clusters(values, max(APART * error, 2.0 ** -52))
        near = group[:, None] == group[None, :]
        x = x + x @ np.where(near, r / 2, wrong / np.where(near, 1, gap))
        x = x @ (3 * eye - x.T @ x) / 2  # what the step's square took from orthonormality
        _turn(x, exact, values, group)
    else:
        raise ArithmeticError("the eigenvectors did not settle")
    order = np.argsort(-values, kind="stable")
    x = x[:, order] / np.sqrt((x[:, order] ** 2).sum(axis=0))
    return (values[order] * size).astype(np.float64), x.astype(np.float64)


def _clusters(values: np.ndarray, error: float) -> np.ndarray:
    """The cluster of each eigenvalue: neighbours at most ``error`` apart belong together."""
    order = np.argsort(values, kind="stable")
    group = np.empty(len(values), int)
    group[order] = np.concatenate([[0], np.cumsum(np.diff(values[order]) > error)])
    return group


def _turn(x: np.ndarray, a: np.ndarray, values: np.ndarray, group: np.ndarray) -> None:
    """Turn the columns of ``x`` inside each cluster of eigenvalues, in place."""
    for g in np.flatnonzero(np.bincount(group) > 1):
        cluster = np.flatnonzero(group == g)
        part = x[:, cluster]
        # shifted, so the differences inside the cluster keep their digits
        small = part.T @ (a @ part - values[cluster].mean() * part)
        scale = np.abs(small).max()
        if scale > 2.0 ** -60:  # else one eigenvalue: any basis will do
            basis = np.linalg.eigh(((small + small.T) / (2 * scale)).astype(np.float64))[1].astype(np.longdouble)
            x[:, cluster] = part @ (basis @ (3 * np.eye(len(cluster)) - basis.T @ basis)) / 2


def covariance(vectors: DataFrame, width: int, centre: Centre) -> np.ndarray:
    """Covariance of all rows, divisor n."""
    upper = np.triu_indices(width)

    def products(x: np.ndarray) -> np.ndarray:
        y = centre(x)
        return (y.T @ y)[upper]

    out = np.zeros((width, width))
    out[upper] = _summed(vectors, width, "double", products) / centre.n
    return out + np.triu(out, 1).T


def whiten(table: DataFrame, id_col: str = "vec_id", vector: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) of each row and component."""
    v = F.col(vector)
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    vectors = table.where(v.isNotNull() & F.coalesce(finite, F.lit(False))).select(
        v.cast("array<double>").alias("__vector"), F.col(id_col).alias("__id"))
    kind = vectors.schema["__id"].dataType.simpleString()
    schema = f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    n, width = vectors.agg(F.count(F.lit(1)), F.max(F.size("__vector"))).first()
    if not n or not width:
        return table.sparkSession.createDataFrame([], schema)
    centre = Centre(n, _summed(vectors, width, "long", lambda x: x.sum(axis=0)))
    cov = covariance(vectors, width, centre)
    values, x = refine(cov)
    varied = values > width * 2.0 ** -52 * max(values[0], 0.0)
    kept = min(components, width)
    scaled = np.where(varied, x / np.sqrt(np.where(varied, values, 1.0)), 0.0)[:, :kept]
    trace = float(np.trace(cov))
    explained = np.where(varied, values / (trace or 1.0), 0.0)[:kept]
    varied = varied[:kept]

    means = _summed(vectors, width, "double", lambda m: (centre(m) @ scaled).sum(axis=0)) / n

    def products(m: np.ndarray) -> np.ndarray:
        w = centre(m) @ scaled - means
        return w.T @ w

    spread = _summed(vectors, width, "double", products).reshape(kept, kept) / n
    identity = float(np.abs((spread - np.eye(kept))[np.ix_(varied, varied)]).max(initial=0.0))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = np.arange(1, kept + 1, dtype=np.int32)
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                m = _matrix(batch.column(0), width)
                rows = np.repeat(np.arange(len(m)), kept)
                w = (centre(m) @ scaled).ravel()
                yield pa.RecordBatch.from_arrays([
                    batch.column(1).take(pa.array(rows)), pa.array(np.tile(number, len(m))),
                    pa.array(centre.deviation(m)[rows]), pa.array(w, mask=np.tile(~varied, len(m))),
                    pa.array(np.tile(explained, len(m)))],
                    names=["__id", "component", "deviation", "whitened", "explained"])

    out = vectors.mapInArrow(
        project, f"__id {kind}, component int, deviation long, whitened double, explained double")
    return out.select(F.col("__id").alias(id_col), "component", F.lit(n).cast("long").alias("n"), "deviation",
                      "whitened", "explained", F.lit(identity).alias("identity_error"))
