"""Embedding whitening by spectral divide and conquer on QDWH polar decompositions.

Components c become whole numbers x = floor(64 * c) + 1000000, so the fit is exact: one pass sums the
vectors, another sums the products of what is left after the whole number nearest to the mean is
taken off. Both are whole numbers, combined in each task, and the covariance is their exact ratio
rounded once, whatever the order of rows or tasks. Only components x components numbers reach the driver.

The covariance is split there: the polar factor of the covariance less a shift is the matrix sign,
(sign + 1) / 2 projects on the components above the shift, and an orthonormal basis of its range and
of the rest turns the matrix into two smaller ones, which are split in turn down to single
components. The polar factor comes from QDWH, the dynamically weighted Halley iteration: QR
factors while the matrix is badly conditioned, Cholesky factors after that, six steps at most.

The components are broadcast (components x dimensions numbers) for one pass that whitens every row and
a last one that measures the covariance of what came out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .work import Work, named

SCALE, OFFSET = 64, 1_000_000
LARGEST = 1 << 17  # components from here on are refused: their products don't fit whole numbers of 64 bits
FLAT = 1e-12  # components with less than this share of the largest variance can't be whitened
EXACT = 1 << 53
COMPONENTS = 32
_ROWS = 2048


def polar_sign(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix (its sign), by QDWH."""
    eye = np.eye(len(a))
    x = a / np.linalg.norm(a)
    try:
        low = 1 / np.linalg.norm(np.linalg.inv(x))
    except np.linalg.LinAlgError:
        low = 0.0
    low = min(1.0, max(low, 1e-17))
    for _ in range(30):
        l2 = low * low
        d = (4 * (1 - l2) / (l2 * l2)) ** (1 / 3)
        root = np.sqrt(1 + d)
        p = root + np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - l2) / (l2 * root))) / 2
        b = (p - 1) ** 2 / 4
        c = p + b - 1
        if c > 100:
            q, _ = np.linalg.qr(np.concatenate((np.sqrt(c) * x, eye)))
            y = b / c * x + (p - b / c) / np.sqrt(c) * q[: len(a)] @ q[len(a):].T
        else:
            w = np.linalg.inv(np.linalg.cholesky(eye + c * x.T @ x))
            y = b / c * x + (p - b / c) * (x @ w.T) @ w
        y = (y + y.T) / 2
        low = min(1.0, low * (p + b * l2) / (1 + c * l2))
        moved = np.linalg.norm(y - x)
        x = y
        if abs(1 - low) < 1e-14 and moved < 1e-5:  # the order of convergence is three: the next step would change nothing
            break
    return x


def _bases(a: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, int] | None:
    """An orthogonal matrix and r: its first r columns span an invariant subspace of ``a``, the others
    the rest. None where no shift parts the eigenvalues: they are equal to rounding."""
    m, size = len(a), np.linalg.norm(a)
    diagonal, centre = np.diag(a), np.trace(a) / len(a)
    spread = np.linalg.norm(a - centre * np.eye(m)) / np.sqrt(m)  # the standard deviation of the eigenvalues
    if spread <= 4e-16 * size:
        return None
    for shift in (float(np.median(diagonal)), centre, *(centre + spread * t for t in (0.31, -0.31, 0.77, -0.77, 0.09, -0.09))):
        if np.linalg.norm(a - shift * np.eye(m)) == 0:
            continue
        above = (polar_sign(a - shift * np.eye(m)) + np.eye(m)) / 2
        r = round(float(np.trace(above)))
        if not 0 < r < m or np.linalg.norm(above @ above - above) > 1e-8:  # nothing on one side, or an eigenvalue at the shift
            continue
        mixed = np.concatenate((above @ rng.normal(size=(m, r)), (np.eye(m) - above) @ rng.normal(size=(m, m - r))), axis=1)
        q, _ = np.linalg.qr(mixed)
        q, _ = np.linalg.qr(np.concatenate((above @ q[:, :r], q[:, r:] - above @ q[:, r:]), axis=1))
        if np.linalg.norm(q[:, :r].T @ a @ q[:, r:]) <= 1e-13 * size:
            return q, r
    return None


def spectrum(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric matrix, falling, and unit eigenvectors as columns."""
    rng, done, open_ = np.random.default_rng(0), [], [np.eye(len(v))]
    while open_:
        basis = open_.pop()
        block = basis.T @ v @ basis
        found = _bases((block + block.T) / 2, rng) if basis.shape[1] > 1 else None
        if found is None:
            done.append(basis)
        else:
            q, r = found
            open_ += [basis @ q[:, :r], basis @ q[:, r:]]
    vectors = np.concatenate(done, axis=1)
    vectors /= np.linalg.norm(vectors, axis=0)
    values = np.einsum("ij,ij->j", vectors, v @ vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


def _whole(batch: pa.RecordBatch, dims: int, centre: np.ndarray, vec_at: int = 1) -> np.ndarray:
    return batch.column(vec_at).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims) - centre


def _entries(total: np.ndarray) -> pa.RecordBatch:
    i, j = np.indices(total.shape)
    return pa.RecordBatch.from_arrays([pa.array(i.ravel().astype(np.int32)), pa.array(j.ravel().astype(np.int32)), pa.array([str(s) for s in total.ravel().tolist()])],
                                      names=["i", "j", "s"])


def _sums(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[pa.RecordBatch]:
    """(0, dimension, sum) and (0, dims, count) of a task."""
    total = np.zeros((1, dims + 1), object)
    for batch in batches:
        x = _whole(batch, dims, np.zeros(dims, np.int64), 0)
        total[0] += np.append(x.sum(axis=0), len(x)).astype(object)
    yield _entries(total)


def _products(batches: Iterator[pa.RecordBatch], dims: int, centre: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The sums of products of a task's centred vectors. Doubles hold them exactly below 2**53."""
    total = np.zeros((dims, dims), object)
    for batch in batches:
        y = _whole(batch, dims, centre, 0)
        for at in range(0, len(y), _ROWS):
            part = y[at : at + _ROWS]
            exact = int(np.abs(part).max(initial=0)) ** 2 * len(part) < EXACT
            gram = part.astype(float).T @ part.astype(float) if exact else part.T @ part
            total += gram.astype(np.int64).astype(object)
    yield _entries(total)


def _white(batch: pa.RecordBatch, dims: int, fit: dict, vec_at: int) -> tuple[np.ndarray, np.ndarray]:
    y = _whole(batch, dims, fit["centre"], vec_at)
    return y, (y - fit["rest"]) @ fit["map"]


def _moments(batches: Iterator[pa.RecordBatch], dims: int, fit: dict) -> Iterator[pa.RecordBatch]:
    k = fit["map"].shape[1]
    total = np.zeros((k + 1, k + 1))
    for batch in batches:
        z = _white(batch, dims, fit, 0)[1]
        z = np.concatenate((z, np.ones((len(z), 1))), axis=1)
        total += z.T @ z
    yield _entries(np.char.mod("%.15f", total))


def _rows(batches: Iterator[pa.RecordBatch], dims: int, fit: dict, error: float) -> Iterator[pa.RecordBatch]:
    n, rest, k = fit["n"], fit["total"], fit["map"].shape[1]
    for whole in batches:
        for at in range(0, whole.num_rows, _ROWS):
            batch = whole.slice(at, _ROWS)
            y, z = _white(batch, dims, fit, 1)
            if (n * float(np.abs(y).max(initial=0)) + max(map(abs, rest))) ** 2 * dims < 1 << 62:
                off = n * y - np.array(rest, np.int64)
                deviation = pa.array((off * off).sum(axis=1))
            else:
                sums = [sum((n * a - t) ** 2 for a, t in zip(row, rest)) for row in y.tolist()]
                deviation = pa.array([s if s < 1 << 63 else None for s in sums], pa.int64())
            row = pa.array(np.repeat(np.arange(len(y)), k))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(row), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(y))), pa.array(np.full(len(y) * k, n, np.int64)),
                 deviation.take(row), pa.array(z.ravel()), pa.array(np.tile(fit["explained"], len(y))), pa.array(np.full(len(y) * k, error))],
                names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])


def _matrix(df: DataFrame, shape: tuple[int, int], scale: int = 0) -> np.ndarray:
    """The summed entries: a row for each entry reaches the driver. Whole numbers stay exact."""
    out = np.zeros(shape, object)
    for r in df.groupBy("i", "j").agg(F.sum(F.col("s").cast(f"decimal(38,{scale})")).alias("s")).collect():
        out[r.i, r.j] = float(r.s) if scale else int(r.s)
    return out


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Rows (``id_col``, component, n, deviation, whitened, explained, identity_error), one for each
    vector without null or non-finite entries and each of the first ``components`` components.

    Vectors are those of the commonest length (of equally common ones the greater); others, null and
    empty ones have no rows. Repeated rows each count and keep their rows; ids may be null. Components
    without variance (under 1e-12 of the largest) are left out, so a table of equal vectors and an
    empty one give an empty result. deviation is null where it doesn't fit a long. Other columns
    are not read. An entry of 131072 or more stops the job: its products don't fit 64 bits."""
    spark = vectors.sparkSession
    work = Work(spark, "whitening")
    id_type = vectors.schema[id_col].dataType.simpleString()
    v = F.col(named([], vec_col))
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) != float("inf")))
    kept = vectors.filter(v.isNotNull() & (F.size(v) > 0) & fine).select(F.col(named([], id_col)).alias("id"), v.alias("v"))
    schema = f"{id_col} {id_type}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    common = kept.groupBy(F.size("v").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    none = spark.createDataFrame([], schema.replace(id_col, "id", 1)).withColumnRenamed("id", id_col)
    if common is None:
        return none
    dims = common.dims
    x = F.transform("v", lambda c: F.when(F.abs(c.cast("double")) < LARGEST, F.floor(F.lit(float(SCALE)) * c.cast("double")) + F.lit(OFFSET))
                    .otherwise(F.raise_error(F.lit(f"entries of {LARGEST} or more have products beyond 64 bits"))).cast("bigint"))
    rows = work.save(kept.filter(F.size("v") == dims).select("id", x.alias("x")), "vectors")
    only, entry = rows.select("x"), "i int, j int, s string"
    sums = _matrix(only.mapInArrow(partial(_sums, dims=dims), entry), (1, dims + 1))[0].tolist()
    n = sums.pop()
    centre = [(2 * s + n) // (2 * n) for s in sums]
    total = [s - n * c for s, c in zip(sums, centre)]  # what the centred vectors sum to: under n / 2 in size
    products = _matrix(only.mapInArrow(partial(_products, dims=dims, centre=np.array(centre)), entry), (dims, dims))
    covariance = np.array([[(n * products[i, j] - total[i] * total[j]) / (n * n) for j in range(dims)] for i in range(dims)])
    values, axes = spectrum(covariance)
    k = min(components, int((values > max(0.0, FLAT * values[0])).sum()))
    if not k:
        return none
    fit = {"n": n, "centre": np.array(centre), "total": total, "rest": np.array([t / n for t in total]), "map": axes[:, :k] / np.sqrt(values[:k]),
           "explained": values[:k] / (sum(n * products[i, i] - total[i] ** 2 for i in range(dims)) / (n * n))}
    moments = _matrix(only.mapInArrow(partial(_moments, dims=dims, fit=fit), entry), (k + 1, k + 1), 15).astype(float) / n
    error = float(np.abs(moments[:k, :k] - np.outer(moments[k, :k], moments[k, :k]) - np.eye(k)).max())
    return rows.mapInArrow(partial(_rows, dims=dims, fit=fit, error=error), schema.replace(id_col, "id", 1)).withColumnRenamed("id", id_col)
