"""Whitening of embedding vectors by mixed-precision eigenvectors.

Entries become integers, so sums and the centred covariance are added up exactly
by Spark whatever the order of tasks. The symmetric eigenproblem starts from
float32 eigenvectors; Ogita-Aishima iterations, which are a few matrix products
each, correct them in extended precision. Eigenvalues too close for the float32
start form clusters: their shared subspace is refined first, then a small
shifted problem inside it tells them apart.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.llm.common import LONG, stored
from panelcast.session import ship_package

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
#: Largest |64 * entry| that exact integer arithmetic takes.
MOST = 1 << 40
#: The covariance of one vector length is solved on the driver: at most this many dimensions.
MAX_DIM = 2048
HIGH = np.longdouble


# ------------------------------------------------------------------ eigenvectors

def refine(a: np.ndarray, x: np.ndarray, most: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Ogita-Aishima iterations on approximate eigenvectors ``x`` of symmetric ``a``.

    Both in extended precision. Returns eigenvalues and vectors, falling. Pairs
    of eigenvalues that the present residual cannot separate only get the
    orthogonality correction; when nothing else is left to correct, each such
    cluster is solved as a small problem shifted by its mean, and the iteration
    goes on with vectors that are now separated.
    """
    n = len(a)
    eye = np.eye(n, dtype=HIGH)
    scale = np.abs(a).max()
    if not scale:
        return np.zeros(n, HIGH), x
    unit = np.finfo(HIGH).eps
    solved, before = 0, np.inf
    for _ in range(most):
        r = eye - x.T @ x
        s = x.T @ (a @ x)
        r, s = (r + r.T) / 2, (s + s.T) / 2     # products in floating point are not quite symmetric
        lam = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(np.diag(s))
        delta = 2 * (np.linalg.norm(off.astype(float)) + np.linalg.norm(a.astype(float)) * np.linalg.norm(r.astype(float)))
        delta = max(delta, float(8 * n * unit * scale))
        gap = lam[None, :] - lam[:, None]
        apart = np.abs(gap) > delta
        e = np.where(apart, (s + lam[None, :] * r) / np.where(apart, gap, 1), r / 2)
        np.fill_diagonal(e, np.diag(r) / 2)
        x = x + x @ e
        if np.abs(e).max() > 1e-6:
            continue                       # the subspaces still move
        groups = [g for g in clusters(lam, delta) if len(g) > 1]
        inner = max((np.abs(off[np.ix_(g, g)]).max() for g in groups), default=0)
        if groups and inner > 4 * n * unit * scale and solved < 8:
            x = split_clusters(a, x, groups)
            solved, before = solved + 1, np.inf
            continue
        step = np.abs(e).max()
        if step < 64 * n * unit or step > before / 4:
            break                          # what is left is rounding over the smallest gap
        before = step
    for _ in range(2):                     # orthogonality alone
        x = x + x @ ((eye - x.T @ x) / 2)
    lam = np.einsum("ij,ij->j", x, a @ x) / np.einsum("ij,ij->j", x, x)
    order = np.argsort(-lam, kind="stable")
    return lam[order], x[:, order]


def clusters(lam: np.ndarray, delta: float) -> list[np.ndarray]:
    """Indices grouped so that neighbours in a group differ by ``delta`` at most."""
    order = np.argsort(lam, kind="stable")
    cuts = np.flatnonzero(np.diff(lam[order]) > delta) + 1
    return np.split(order, cuts)


def split_clusters(a: np.ndarray, x: np.ndarray, groups: list[np.ndarray]) -> np.ndarray:
    """Solve each cluster inside its own refined subspace, shifted by its mean eigenvalue."""
    x = x.copy()
    for g in groups:
        sub = x[:, g]
        mu = np.trace(sub.T @ (a @ sub)) / len(g)
        t = sub.T @ (a @ sub) - mu * (sub.T @ sub)
        size = np.abs(t).max()
        if size:
            _, w = np.linalg.eigh(((t + t.T) / (2 * size)).astype(np.float64))
            x[:, g] = sub @ w.astype(HIGH)
    return x


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors of a symmetric matrix."""
    if not len(a):
        return np.zeros(0, HIGH), np.zeros((0, 0), HIGH)
    a = ((a + a.T) / 2).astype(HIGH)
    scale = np.abs(a).max()
    if not scale:
        return np.zeros(len(a), HIGH), np.eye(len(a), dtype=HIGH)
    _, start = np.linalg.eigh((a / scale).astype(np.float32))
    lam, x = refine(a / scale, start.astype(HIGH))
    return lam * scale, x / np.sqrt(np.einsum("ij,ij->j", x, x))


# ------------------------------------------------------------------ the fit

@dataclass
class Model:
    """One vector length: its fit list's size, sums, eigenvalues and components."""

    n: int
    sums: list[int]          # of x, exact
    total: float             # trace of the covariance
    values: np.ndarray       # of the components kept
    vectors: np.ndarray      # dimension by component
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n as doubles, through the whole part of the mean so that nothing cancels."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        return (x - whole).astype(np.float64) - rest

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return (self.centred(x) @ self.vectors) / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n*x - S)^2, exact."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n for s in self.sums], np.int64)
        y = x - whole
        most = self.n * (int(np.abs(y).max(initial=0)) + 1)
        if most * most * max(1, y.shape[1]) < 1 << 62:
            d = self.n * y - rest
            return (d * d).sum(1).tolist()
        d = self.n * y.astype(object) - rest.astype(object)
        return (d * d).sum(1).tolist()


def whole_vectors(column: pa.Array) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """(kept rows, [(rows, x of one length)]) of a list column: rows that are null, hold
    null or non-finite entries, or entries beyond the exact range are left out."""
    n = len(column)
    there = ~np.asarray(column.is_null())
    size = np.asarray(column.value_lengths().fill_null(0)).astype(np.int64)
    values = column.flatten()
    c = np.asarray(values.cast(pa.float64()).fill_null(np.nan))
    row = np.repeat(np.arange(n), np.where(there, size, 0))
    with np.errstate(invalid="ignore"):
        good = np.abs(c * SCALE) < MOST               # false for nan too
    there[row[~good]] = False
    out = []
    start = np.cumsum(size) - size
    for d in np.unique(size[there]):
        rows = np.flatnonzero(there & (size == d))
        at = (start[rows][:, None] + np.arange(d)).astype(np.int64)
        out.append((rows, np.floor(c[at] * SCALE).astype(np.int64) + SHIFT))
    return there, out


def _lists(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1], pa.array(x.reshape(-1)))


def integer_vectors(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """(x) array<long> of each row that takes part."""
    out = pa.schema([("x", pa.list_(pa.int64()))])
    ship_package(vectors.sparkSession)

    def run(batches):
        for b in batches:
            for _, x in whole_vectors(b.column(0))[1]:
                yield pa.RecordBatch.from_arrays([_lists(x)], schema=out)

    return vectors.select(F.col(column)).mapInArrow(run, T.StructType([T.StructField("x", T.ArrayType(LONG))]))


def _matrix(column: pa.Array) -> list[np.ndarray]:
    """The vectors of a batch as one matrix for each length."""
    return [x for _, x in _by_length(column)]


def _by_length(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    size = np.asarray(column.value_lengths()).astype(np.int64)
    flat, start = np.asarray(column.flatten()), np.cumsum(size) - size
    out = []
    for d in np.unique(size):
        rows = np.flatnonzero(size == d)
        out.append((rows, flat[(start[rows][:, None] + np.arange(d)).astype(np.int64)]))
    return out


def _add_up(fit: DataFrame, part) -> dict[int, tuple[int, dict[tuple[int, int], int]]]:
    """Exact sums over the fit list: ``part(x)`` gives a matrix of integers for one batch of
    vectors of a length; Spark adds the tasks' matrices entry by entry."""
    ship_package(fit.sparkSession)
    out = pa.schema([("d", pa.int64()), ("i", pa.int64()), ("j", pa.int64()), ("v", pa.string())])

    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for x in _matrix(b.column(0)):
                d = x.shape[1]
                m = part(x).astype(object)
                sums[d] = m if d not in sums else sums[d] + m
        for d, m in sums.items():
            i, j = np.indices(m.shape)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(m.size, d)), pa.array(i.ravel()), pa.array(j.ravel()),
                 pa.array([str(v) for v in m.ravel()])], schema=out)

    rows = (fit.mapInArrow(run, "d long, i long, j long, v string")
            .groupBy("d", "i", "j").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")))
    found: dict[int, dict[tuple[int, int], int]] = {}
    for r in rows.collect():          # dimension squared numbers, never rows
        found.setdefault(r["d"], {})[r["i"], r["j"]] = int(r["v"])
    return found


def exact_gram(y: np.ndarray) -> np.ndarray:
    """y.T @ y of integers, exact: doubles where every partial sum stays below 2^53."""
    most = int(np.abs(y).max(initial=0))
    if most * most * max(1, len(y)) < 1 << 53:
        f = y.astype(np.float64)
        return (f.T @ f).astype(np.int64)
    if most * most * max(1, len(y)) < 1 << 62:
        return y.T @ y
    o = y.astype(object)
    return o.T @ o


def fit_whitening(fit: DataFrame, components: int = COMPONENTS) -> dict[int, Model]:
    """Models by vector length from the fit list (x) of distinct integer vectors."""
    sizes = {r["d"]: r["n"] for r in fit.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).collect()}
    if any(d > MAX_DIM for d in sizes):
        raise ValueError(f"vectors of more than {MAX_DIM} dimensions")
    sums = _add_up(fit, lambda x: (x - SHIFT).sum(0, keepdims=True))
    means, models = {}, {}
    for d, n in sizes.items():
        if d:
            means[d] = [sums[d][0, j] + n * SHIFT for j in range(d)]
    whole = {d: np.array([s // sizes[d] for s in m], np.int64) for d, m in means.items()}
    # centred at the whole part of the mean before multiplying; the rest is exact below
    gram = _add_up(fit, lambda x: exact_gram(x - whole[x.shape[1]]) if x.shape[1] else np.zeros((0, 0)))
    for d, m in means.items():
        n = sizes[d]
        rest = [s % n for s in m]
        cov = np.empty((d, d), HIGH)
        for i in range(d):
            for j in range(d):
                # sum of (n*x_i - S_i)(n*x_j - S_j) is n * exact, an integer
                exact = n * gram[d][i, j] - rest[i] * rest[j]
                cov[i, j] = high(exact, n * n)
        values, vectors = eigen(cov)
        kept = min(components, int((values > values.max(initial=0) * d * np.finfo(np.float64).eps).sum()))
        models[d] = Model(n, m, float(np.trace(cov)), values[:kept].astype(np.float64), vectors[:, :kept].astype(np.float64))
    return models


def high(a: int, b: int) -> np.longdouble:
    """a / b in extended precision: the whole part and the remainder apart."""
    q, r = divmod(a, b)
    top, low = divmod(q, 1 << 60)
    return HIGH(top) * HIGH(1 << 60) + HIGH(low) + HIGH(r >> max(0, b.bit_length() - 62)) / HIGH(b >> max(0, b.bit_length() - 62))


def identity_errors(fit: DataFrame, models: dict[int, Model]) -> dict[int, float]:
    """Largest absolute entry of (covariance of the whitened fit list - identity) by length."""
    ship_package(fit.sparkSession)
    out = pa.schema([("d", pa.int64()), ("i", pa.int64()), ("j", pa.int64()), ("v", pa.float64())])

    def run(batches):
        grams: dict[int, np.ndarray] = {}
        for b in batches:
            for x in _matrix(b.column(0)):
                d = x.shape[1]
                if d in models:
                    w = models[d].whiten(x)
                    one = np.hstack([w, np.ones((len(w), 1))])
                    grams[d] = grams.get(d, 0) + one.T @ one
        for d, m in grams.items():
            i, j = np.indices(m.shape)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(m.size, d)), pa.array(i.ravel()), pa.array(j.ravel()),
                                              pa.array(m.ravel())], schema=out)

    found: dict[int, float] = {}
    rows = fit.mapInArrow(run, "d long, i long, j long, v double").groupBy("d", "i", "j").agg(F.sum("v").alias("v"))
    mats: dict[int, np.ndarray] = {d: np.zeros((len(m.values) + 1,) * 2) for d, m in models.items()}
    for r in rows.collect():
        mats[r["d"]][r["i"], r["j"]] = r["v"]
    for d, m in mats.items():
        n, k = models[d].n, len(models[d].values)
        mean = m[k, :k] / n
        cov = m[:k, :k] / n - np.outer(mean, mean)
        found[d] = float(np.abs(cov - np.eye(k)).max(initial=0))
    return found


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """One row per remaining vector and component: ``vec_id, component, n, deviation,
    whitened, explained, identity_error`` and ``deviation_exact`` (decimal).

    Rows whose vector is null or holds null, NaN or infinite entries are left out, and
    so are entries with 64*|c| of 2^40 or more, which exact integers don't hold. Vectors
    of different lengths are fitted apart, each length with its own n and errors; an
    empty vector has no component. Repeated rows and ids each keep their rows, a null id
    stays null. Components whose eigenvalue is zero to double precision don't exist, so a
    length with one distinct vector gives no rows, and neither does an empty table. Equal
    eigenvalues may take any basis of their space, the same for all rows. ``deviation``
    is null where the exact number passes a long; ``deviation_exact`` then still has it
    up to 38 digits. Columns other than the two named are ignored.
    """
    own = vectors.select(F.col(f"`{id_column}`").cast("long").alias("vec_id"), F.col(f"`{column}`").cast("array<double>").alias("v"))
    fit = stored(integer_vectors(own, "v").distinct(), "whitening-fit")
    models = fit_whitening(fit, components)
    for d, e in identity_errors(fit, models).items():
        models[d].identity_error = e
    ship_package(vectors.sparkSession)
    out = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()),
                     ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64()),
                     ("deviation_exact", pa.string())])

    def run(batches):
        for b in batches:
            ids = b.column(0)
            for rows, x in whole_vectors(b.column(1))[1]:
                m = models.get(x.shape[1])
                if m is None or not len(m.values):
                    continue
                k = len(m.values)
                w = m.whiten(x)
                dev = m.deviations(x)
                fits = [v if v < 1 << 63 else None for v in dev]
                each = np.repeat(np.arange(len(rows)), k)
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array(rows[each])),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                    pa.array(np.full(len(each), m.n)),
                    pa.array(fits, pa.int64()).take(pa.array(each)),
                    pa.array(w.reshape(-1)),
                    pa.array(np.tile(m.values / m.total, len(rows))),
                    pa.array(np.full(len(each), m.identity_error)),
                    pa.array([str(v) for v in dev]).take(pa.array(each))], schema=out)

    found = own.mapInArrow(run, "vec_id long, component int, n long, deviation long, whitened double, explained double, "
                                "identity_error double, deviation_exact string")
    return found.withColumn("deviation_exact", F.expr("try_cast(deviation_exact as decimal(38,0))"))
