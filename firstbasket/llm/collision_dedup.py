"""Embedding near-duplicates by collision-counting projections.

A vector of length one is projected on many random directions. Two vectors of cosine ``threshold`` or
more differ on a direction by a normal deviate of standard deviation at most their distance
sqrt(2 - 2 threshold), so on a sorted projection the window of twice that around one of them (the
query) holds the other with a chance of 95 %, and an unrelated vector with a third of that. Pairs are
counted by the number of projections whose query-centred windows they share; those that reach a
count calibrated to ``RECALL`` are verified by their cosine in double precision.

Runs. A window of one sorted projection holds a third of all vectors, so a whole-table sort would meet
a third of all pairs however many machines there are. Each projection is therefore sorted within runs: cells
of equal signs on ``bits`` further directions of its own, so many that a run holds ``RUN`` unrelated
vectors whatever the table's size. A close pair shares a run and a window with a chance that has a
closed form; the number of projections follows from it and ``RECALL``. At a cosine above the
threshold both chances are larger.

Volume. Equal vectors are one row before anything is replicated. A row carries its vector, its cells
and its projections, so a pair is counted and verified where it first meets, and only there: no pair
is written. A task gives each vector's number of links and a spanning forest of the links it saw.
A run of more than ``BLOCK`` vectors (a large group of near copies) is cut into blocks, and pairs of
blocks are units of their own, so none is held whole by a task. The links themselves of a group of s
different near copies are s * s / 2 and each is verified, spread over those units.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .work import Work, named, partitions

RECALL = 0.995  # of pairs right at the threshold, for meeting, and again for the count
RUN = 8
BLOCK = 512
WINDOW = 2.0  # half a window, in distances of a pair at the threshold
QUANTUM = 1 / 64  # of a stored projection
PAIRS = 1 << 17  # pairs whose counts a task holds at once
_ROWS = 2048  # vectors projected at once
_SPREAD = 256  # vectors replicated at once
_OUT = 4096  # rows of a batch of replicas


UNIT = ("dims", "t", "cell", "i", "j")  # what is compared together


class Plan:
    """What follows from the threshold and the number of different vectors: signs that name a run,
    projections, half a window, and the least count."""

    def __init__(self, n: int, threshold: float, recall: float = RECALL):
        if not 0.5 <= threshold < 1:
            raise ValueError("the threshold must be 0.5 or more and below 1")
        self.threshold, self.bits = threshold, min(30, max(0, math.ceil(math.log2(max(1, n) / RUN))))
        reach = math.sqrt(2 - 2 * threshold)
        self.reach = math.floor(WINDOW * reach / QUANTUM) + 1  # half a window in quanta, one more for rounding
        inside = math.erf(WINDOW / math.sqrt(2))
        self.meet = (1 - math.acos(threshold) / math.pi) ** self.bits * inside
        self.projections = max(8, math.ceil(math.log(1 - recall) / math.log1p(-self.meet)))
        tail, self.count = 0.0, self.projections
        while self.count and tail < recall:  # the largest count that a pair at the threshold reaches often enough
            tail += math.comb(self.projections, self.count) * inside ** self.count * (1 - inside) ** (self.projections - self.count)
            self.count -= tail < recall
        self.count = max(1, self.count)

    def directions(self, dims: int) -> np.ndarray:
        """[dimension, projection * (1 + bits)]: of each projection its own direction, then its signs'."""
        return np.random.default_rng([13, dims]).normal(size=(dims, 1 + self.bits, self.projections)).transpose(0, 2, 1).reshape(dims, -1)


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; the first step, by a power of two, loses nothing and can't overflow."""
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0))[1][:, None])
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _table(column: pa.Array, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def _project(batches: Iterator[pa.RecordBatch], plan: Plan, kind: str) -> Iterator[pa.RecordBatch]:
    """(rep, copies, dims, v, cells, spots): vectors as bytes of ``kind``, cells of 4 bytes and spots
    (projections in quanta) of 2 bytes, one each a projection."""
    weights = 1 << np.arange(plan.bits, dtype=np.uint32)
    made: dict[int, np.ndarray] = {}
    for whole in batches:
        for at in range(0, whole.num_rows, _ROWS):
            batch = whole.slice(at, _ROWS)
            lists = batch.column(2)
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
            for dims in np.unique(lengths).tolist():
                mine = pa.array(np.flatnonzero(lengths == dims))
                x = lists.take(mine).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dims)
                if dims not in made:
                    made[dims] = plan.directions(dims)
                p = (_unit(x) @ made[dims]).reshape(len(x), plan.projections, 1 + plan.bits)
                spots = np.rint(p[:, :, 0] / QUANTUM).clip(-16000, 16000).astype("<i2")
                cells = ((p[:, :, 1:] > 0) * weights).sum(axis=2, dtype=np.uint32).astype("<u4")
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(mine), batch.column(1).take(mine), pa.array(np.full(len(x), dims, np.int32)),
                     *(pa.array([r.tobytes() for r in m], pa.binary()) for m in (x.astype(kind), cells, spots))],
                    names=["rep", "copies", "dims", "v", "cells", "spots"])


def _places(batches: Iterator[pa.RecordBatch], projections: int) -> Iterator[pa.RecordBatch]:
    """A row (rep, dims, t, cell) for each vector and projection."""
    for batch in batches:
        row = pa.array(np.repeat(np.arange(batch.num_rows), projections))
        yield pa.RecordBatch.from_arrays([batch.column(0).take(row), batch.column(1).take(row), pa.array(np.tile(np.arange(projections, dtype=np.int32), batch.num_rows)),
                                          pa.array(_table(batch.column(2), "<u4").ravel().astype(np.int64))], names=["rep", "dims", "t", "cell"])


def _spread(batches: Iterator[pa.RecordBatch], projections: int) -> Iterator[pa.RecordBatch]:
    """A row for each vector and projection, with all that the comparing task needs; where the run is
    cut into blocks (``cut``: t, blocks), one for each pair of blocks that holds the vector's own."""
    for whole in batches:
        for at in range(0, whole.num_rows, _SPREAD):
            batch = whole.slice(at, _SPREAD)
            blocks = np.ones((batch.num_rows, projections), np.int64)
            for r, cut in enumerate(batch.column(6).to_pylist()):
                for c in cut or ():
                    blocks[r, c["t"]] = c["blocks"]
            cells, spots = _table(batch.column(4), "<u4").ravel(), _table(batch.column(5), "<i2").ravel()
            many = blocks.ravel()
            place = np.repeat(np.arange(len(many)), many)  # of a vector and projection
            other = np.arange(len(place)) - np.repeat(np.cumsum(many) - many, many)
            mixed = batch.column(0).to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)
            own = mixed[place // projections].astype(np.int64) % many[place]
            for a in range(0, len(place), _OUT):
                p, b, o = place[a : a + _OUT], own[a : a + _OUT], other[a : a + _OUT]
                row = pa.array(p // projections)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(row) for c in range(6)), pa.array((p % projections).astype(np.int32)), pa.array(cells[p].astype(np.int64)),
                     pa.array(spots[p].astype(np.int32)), pa.array(np.minimum(b, o)), pa.array(np.maximum(b, o)), pa.array(b > o)],
                    names=["rep", "copies", "dims", "v", "cells", "spots", "t", "cell", "spot", "i", "j", "side"])


def forest(i: np.ndarray, j: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect ``n`` nodes just as the pairs (i, j) do, one a node at most."""
    root, us, vs = np.arange(n), [], []
    while True:
        a, b = root[i], root[j]
        open_ = a != b
        if not open_.any():
            return (np.concatenate(us), np.concatenate(vs)) if us else (root[:0], root[:0])
        i, j, hi, lo = i[open_], j[open_], np.maximum(a, b)[open_], np.minimum(a, b)[open_]
        hung = root.copy()
        np.minimum.at(hung, hi, lo)
        moved = np.unique(hi)
        us.append(moved)
        vs.append(hung[moved])
        while not np.array_equal(hung, hung[hung]):
            hung = hung[hung]
        root = hung


class _Rows:
    """Rows of whole units, sorted by unit and spot."""

    def __init__(self, batch: pa.RecordBatch, plan: Plan, kind: str):
        self.rep, self.copies, self.t, self.spot, self.i, self.j, self.side = (
            batch.column(c).to_numpy(zero_copy_only=False) for c in ("rep", "copies", "t", "spot", "i", "j", "side"))
        self.new = np.ones(len(self.rep), bool)
        self.new[1:] = False
        for c in UNIT:
            column = batch.column(c).to_numpy(zero_copy_only=False)
            self.new[1:] |= column[1:] != column[:-1]
        self.cells, self.spots, self.plan = _table(batch.column("cells"), "<u4"), _table(batch.column("spots"), "<i2"), plan
        self.x = _unit(_table(batch.column("v"), kind).astype(float))

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Each row with the later ones of its unit in its window, a bounded number at once."""
        line = np.cumsum(self.new) * 100_000 + self.spot.astype(np.int64)  # spots are under 16000 in size
        many = np.searchsorted(line, line + self.plan.reach, "right") - np.arange(len(line)) - 1
        before = np.concatenate(([0], np.cumsum(many)))
        at = 0
        while at < len(line):
            end = max(at + 1, int(np.searchsorted(before, before[at] + PAIRS, "right")) - 1)
            i = np.repeat(np.arange(at, end), many[at:end])
            j = i + 1 + np.arange(len(i)) - (before[i] - before[at])
            keep = (self.i[i] == self.j[i]) | (self.side[i] != self.side[j])  # in a pair of two blocks, one of each
            if keep.any():
                yield i[keep], j[keep]
            at = end

    def links(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The pairs that meet here first, reach the count, and have the cosine."""
        for i, j in self.pairs():
            near = np.abs(self.spots[i] - self.spots[j]) <= self.plan.reach
            first = (near & (self.cells[i] == self.cells[j])).argmax(axis=1) == self.t[i]
            good = first & (near.sum(axis=1) >= self.plan.count)
            i, j = i[good], j[good]
            hit = np.einsum("ij,ij->i", self.x[i], self.x[j]) >= self.plan.threshold
            if hit.any():
                yield i[hit], j[hit]


def _links(batches: Iterator[pa.RecordBatch], plan: Plan, kind: str) -> Iterator[pa.RecordBatch]:
    """Edges (u, v, null) and link counts (u, null, n). Rows come sorted by (dims, unit, spot); a unit
    holds about two blocks, and the last one of a batch waits for the next batch."""
    kept: pa.Table | None = None

    def found(table: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = _Rows(table.combine_chunks().to_batches()[0], plan, kind)
        n = np.zeros(len(rows.rep), np.int64)
        for i, j in rows.links():
            np.add.at(n, i, rows.copies[j])
            np.add.at(n, j, rows.copies[i])
            u, v = forest(i, j, len(n))
            yield pa.RecordBatch.from_arrays([pa.array(rows.rep[u]), pa.array(rows.rep[v]), pa.nulls(len(u), pa.int64())], names=["u", "v", "n"])
        has = np.flatnonzero(n)
        rep, of = np.unique(rows.rep[has], return_inverse=True)
        total = np.zeros(len(rep), np.int64)
        np.add.at(total, of, n[has])
        yield pa.RecordBatch.from_arrays([pa.array(rep), pa.nulls(len(rep), pa.int64()), pa.array(total)], names=["u", "v", "n"])

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([kept, table]) if kept is not None else table
        last = np.ones(table.num_rows, bool)
        for c in UNIT:
            column = table.column(c).to_numpy()
            last &= column == column[-1]
        cut = int(last.argmax())  # the last unit is the tail of the sorted rows
        kept = table.slice(cut)
        dims = table.column("dims").to_numpy()[:cut]
        for a, b in zip(*_spans(dims)):
            yield from found(table.slice(a, b - a))
    if kept is not None:
        yield from found(kept)


def _spans(values: np.ndarray) -> tuple[list[int], list[int]]:
    if not len(values):
        return [], []
    cut = (np.flatnonzero(np.diff(values)) + 1).tolist()
    return [0, *cut], [*cut, len(values)]


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.95, recall: float = RECALL) -> DataFrame:
    """One row (``id_col``, n_links, component_id, kept) per row of ``vectors``.

    n_links counts the other rows linked directly, component_id is the least id that links reach, the
    row's own included, and kept says whether they are equal. A vector that is null, empty, zero or
    holds null or non-finite components links with nothing, nor do vectors of different lengths.
    Repeated rows link with each other and keep their rows. A null id is never the least one unless it
    is alone in its component, which it then keeps. An empty table gives an empty result; other
    columns, labels included, are not read. Every link has the cosine, in double precision; one right
    at the threshold is found with a chance of about ``recall`` squared, a closer one with a higher one."""
    spark = vectors.sparkSession
    work = Work(spark, "collisions")
    v = F.col(named([], vec_col))
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) != float("inf"))) & F.exists(v, lambda c: c != 0)
    kind, element = ("<f4", "float") if vectors.select(v).dtypes[0][1] == "array<float>" else ("<f8", "double")
    zero = F.lit(0.0).cast(element)  # a zero of either sign is one value
    rows = work.save(vectors.select(F.col(named([], id_col)).alias("id"), F.when(fine, F.transform(v, lambda c: c.cast(element) + zero)).alias("v"))
                     .withColumn("h", F.when(F.col("v").isNotNull(), F.xxhash64("v"))), "rows")
    groups = work.save(rows.filter("v is not null").groupBy("h", "v").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("first_id"))
                       .withColumn("rep", F.monotonically_increasing_id()), "groups")
    plan = Plan(groups.count(), threshold, recall)
    row = "rep bigint, copies bigint, dims int, v binary, cells binary, spots binary"
    sig = work.save(groups.select("rep", "copies", "v").mapInArrow(partial(_project, plan=plan, kind=kind), row), "projected")
    places = work.save(sig.select("rep", "dims", "cells").mapInArrow(partial(_places, projections=plan.projections), "rep bigint, dims int, t int, cell bigint"), "places")
    run = ["dims", "t", "cell"]
    large = places.groupBy(*run).count().filter(F.col("count") > BLOCK).select(*run, F.ceil(F.col("count") / BLOCK).alias("blocks"))
    cut = work.save(places.join(work.save(large, "large"), run).groupBy("rep").agg(F.collect_list(F.struct("t", "blocks")).alias("cut")), "cut")  # a projection each at most
    spread = sig.join(cut, "rep", "left").select(*sig.columns, "cut").mapInArrow(
        partial(_spread, projections=plan.projections), f"{row}, t int, cell bigint, spot int, i bigint, j bigint, side boolean")
    dealt = spread.repartition(partitions(spark), *UNIT).sortWithinPartitions(*UNIT, "spot", "rep")
    found = work.save(dealt.mapInArrow(partial(_links, plan=plan, kind=kind), "u bigint, v bigint, n bigint"), "links")
    roots = connected_components(work, found.filter("v is not null").select("u", "v"))
    linked = found.filter("n is not null").groupBy(F.col("u").alias("rep")).agg(F.sum("n").alias("n"))
    placed = work.save(groups.select("h", "v", "rep", "copies", "first_id").join(linked, "rep", "left").join(roots, F.col("rep") == F.col("node"), "left")
                       .select("h", "v", "first_id", F.coalesce("root", "rep").alias("root"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "placed")
    least = work.save(placed.groupBy("root").agg(F.min("first_id").alias("component_id")), "least")
    of = work.save(placed.join(least, "root").select("h", "v", "n_links", "component_id"), "of")
    out = rows.alias("r").join(of.alias("o"), (F.col("r.h") == F.col("o.h")) & (F.col("r.v") == F.col("o.v")), "left")
    component = F.when(F.col("r.v").isNull(), F.col("r.id")).otherwise(F.col("o.component_id"))
    return out.select(F.col("r.id").alias(id_col), F.coalesce("o.n_links", F.lit(0).cast("bigint")).alias("n_links"), component.alias("component_id"),
                      F.col("r.id").eqNullSafe(component).alias("kept"))
