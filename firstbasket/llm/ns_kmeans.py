"""Centroid clustering on integer vectors, with norm-of-sum bounds (ns-bounds).

A component x becomes the integer floor(1024 * x), so distances, sums and centroids are whole numbers
and the result is exact, whatever the order of rows or tasks.

Bounds. A vector stores the distance to its centroid and to each other centroid as they were in the
round of their last evaluation, and that round. All centroids of all rounds are kept (clusters x
rounds x components numbers). A stored distance is loosened by the norm of its centroid's *total*
displacement from that round to now, which is never more than the sum of the single rounds' drifts.
Where the loosened upper bound lies under all loosened lower bounds the vector stays where it is,
with no distance evaluated. Otherwise the distance to its centroid is evaluated; every centroid
whose lower bound does not exceed it is evaluated too, exactly, in whole numbers. Bounds are doubles
with a margin far above their rounding, so a tie is always evaluated.

Plan. The state (vector, centroid, bounds) is a written table; a round is one pass over it without
a shuffle and a sum by (cluster, component), combined in each task. Only the sums (clusters x
components) reach the driver, and each round's table replaces the one before.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .work import Work, named

SCALE = 1024
LARGEST = 1 << 17  # components from here on have squared distances beyond a long
SLACK = 1e-9  # relative margin of a bound


def _squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    d = x - c
    return np.einsum("ij,ij->i", d, d)


def _matrix(column: pa.Array, dims: int, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, dims)


def assign(x: np.ndarray, a: np.ndarray, bound: np.ndarray, at: np.ndarray, history: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Centroids, bounds and rounds of evaluation of the rows of ``x`` against the last centroids of
    ``history``. ``bound[i, j]`` is the distance of row i to centroid j in round ``at[i, j]``."""
    now, k = history[-1], len(history[-1])
    moved = np.sqrt(np.stack([((now - c) ** 2).sum(axis=1) for c in history]).astype(float))  # [round, centroid]
    drift = moved[at, np.arange(k)]
    rows = np.arange(len(x))
    own = np.zeros((len(x), k), bool)
    own[rows, a] = True
    upper = (bound[rows, a] + drift[rows, a]) * (1 + SLACK)
    lower = np.where(own, np.inf, (bound - drift) - SLACK * (bound + drift))
    open_ = np.flatnonzero(lower.min(axis=1) <= upper) if k > 1 else rows[:0]
    if not len(open_):
        return a, bound, at
    a, bound, at = a.copy(), bound.copy(), at.copy()
    xo, ao = x[open_], a[open_]
    best = _squared(xo, now[ao])
    bound[open_, ao], at[open_, ao] = np.sqrt(best), len(history) - 1
    to, evaluated = ao.copy(), np.sqrt(best) * (1 + SLACK)
    for j in range(k):
        fails = np.flatnonzero((lower[open_, j] <= evaluated) & (ao != j))
        if not len(fails):
            continue
        d = _squared(xo[fails], now[j])
        bound[open_[fails], j], at[open_[fails], j] = np.sqrt(d), len(history) - 1
        better = (d < best[fails]) | (d == best[fails]) & (j < to[fails])
        best[fails[better]], to[fails[better]] = d[better], j
    a[open_] = to
    return a, bound, at


def _first(batches: Iterator[pa.RecordBatch], dims: int, history: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Evaluates every distance to the first centroids."""
    for batch in batches:
        x, c = _matrix(batch.column(1), dims, np.int64), history[0]
        d = np.stack([_squared(x, j) for j in c], axis=1)
        yield _state(batch, d.argmin(axis=1), np.sqrt(d), np.zeros(d.shape, np.int8))  # the first of equal ones


def _lists(m: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, m.size + 1, m.shape[1], np.int32)), pa.array(m.ravel()))


def _state(batch: pa.RecordBatch, a: np.ndarray, bound: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(a.astype(np.int32)), _lists(bound), _lists(at.astype(np.int32))],
                                      names=["id", "x", "a", "bound", "at"])


def _round(batches: Iterator[pa.RecordBatch], dims: int, history: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    k = len(history[0])
    for batch in batches:
        x = _matrix(batch.column(1), dims, np.int64)
        yield _state(batch, *assign(x, batch.column(2).to_numpy(), _matrix(batch.column(3), k, float), _matrix(batch.column(4), k, np.int64), history))


def _sums(batches: Iterator[pa.RecordBatch], dims: int, k: int) -> Iterator[pa.RecordBatch]:
    """(cluster, component, sum); component -1 holds the count. One row each a task."""
    total = np.zeros((k, dims + 1), np.int64)
    for batch in batches:
        x, a = _matrix(batch.column(1), dims, np.int64), batch.column(0).to_numpy()
        for j in np.unique(a):
            part = x[a == j]
            total[j, 0] += len(part)
            total[j, 1:] += part.sum(axis=0)
    j, i = np.nonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(j.astype(np.int32)), pa.array(i.astype(np.int32) - 1), pa.array(total[j, i])], names=["a", "i", "s"])


def _distances(batches: Iterator[pa.RecordBatch], dims: int, centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a = batch.column(2).to_numpy()
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(_squared(_matrix(batch.column(1), dims, np.int64), centroids[a]))],
                                         names=["id", "cluster", "distance"])


def integers(vectors: DataFrame, id_col: str, vec_col: str, dims: int) -> DataFrame:
    """(id, x) of the vectors with exactly ``dims`` components, none null or non-finite."""
    v = F.col(named([], vec_col))
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) != float("inf")))
    small = F.forall(v, lambda c: F.abs(c.cast("double")) < LARGEST)
    whole = F.transform(v, lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")).cast("int"))
    return (vectors.filter(v.isNotNull() & (F.size(v) == dims) & fine)
            .select(F.col(named([], id_col)).alias("id"),
                    F.when(small, whole).otherwise(F.raise_error(F.lit(f"components of {LARGEST} or more have squared distances beyond a long"))).alias("x")))


def kmeans(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", dims: int = 64, clusters: int = 8, rounds: int = 10,
           seed: int = 3) -> DataFrame:
    """One row (``id_col``, cluster, distance, cluster_inertia, inertia, centroid_sha256) per vector
    with exactly ``dims`` components, none null or non-finite; other rows have none.

    The first centroids are the vectors with the least sha256 of ``seed:id`` (a null id counts as an
    empty one; repeated ids in the order of their vectors). Of equally near centroids the smaller
    number wins; one without vectors stays where it is. Repeated rows each count and keep a row.
    With fewer vectors than ``clusters`` each is a first centroid. An empty table gives an empty
    result; other columns are not read. A component of 131072 or more stops the job, as its
    squared distances don't fit a long."""
    spark = vectors.sparkSession
    work = Work(spark, "kmeans")
    id_type = vectors.schema[id_col].dataType.simpleString()
    rows = work.save(integers(vectors, id_col, vec_col, dims), "vectors")
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    start = rows.orderBy(key, "x").limit(clusters).select("x").collect()  # at most ``clusters`` rows
    out_schema = f"id {id_type}, cluster int, distance bigint"
    if not start:
        return spark.createDataFrame([], f"{out_schema}, cluster_inertia bigint, inertia bigint, centroid_sha256 string").withColumnRenamed("id", id_col)
    history = [np.array([r.x for r in start], np.int64)]
    k = len(history[0])
    schema = f"id {id_type}, x array<int>, a int, bound array<double>, at array<int>"
    state = work.save(rows.mapInArrow(partial(_first, dims=dims, history=history), schema), "state")
    work.drop(rows)
    for _ in range(rounds):
        sums = (state.select("a", "x").mapInArrow(partial(_sums, dims=dims, k=k), "a int, i int, s bigint")
                .groupBy("a", "i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect())  # clusters * (dims + 1) rows at most
        total: dict[tuple[int, int], int] = {(r.a, r.i): int(r.s) for r in sums}
        history.append(np.array([[total.get((j, i), 0) // total[j, -1] for i in range(dims)] if (j, -1) in total else history[-1][j].tolist()
                                 for j in range(k)], np.int64))
        now = work.save(state.mapInArrow(partial(_round, dims=dims, history=history), schema), "state")
        work.drop(state)
        state = now
    final = work.save(state.select("id", "x", "a").mapInArrow(partial(_distances, dims=dims, centroids=history[-1]), out_schema), "final")
    work.drop(state)
    inertia = {r.cluster: int(r.s) for r in final.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    said = spark.createDataFrame([(j, inertia.get(j, 0), sum(inertia.values()), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
                                  for j, c in enumerate(history[-1].tolist())],
                                 "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return final.join(F.broadcast(said), "cluster").select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
