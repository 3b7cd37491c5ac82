"""Distributed global positions, segmented row numbers and equal-frequency deciles.

A global ``row_number`` needs a window without ``partitionBy``, which Spark executes in a single
task. Here the rows are range-partitioned on the ordering (sampled bounds, so even a very common
value is split across partitions), each partition is sorted, and a row's position is its offset
inside the partition (from ``monotonically_increasing_id``) plus the number of rows in earlier
partitions. The per-partition counts are at most ``num_partitions`` rows, a proven bound, so they
are broadcast.

The range-partitioned, sorted rows are checkpointed (reliably, to the session's checkpoint
folder) before they are read twice: Spark's range partitioner may re-sample with a seed derived
from the RDD id, so two executions of the same exchange can cut different bounds, and the count
branch must see exactly the partitions the row branch numbers. The checkpoint also cuts the
lineage, so a lost executor re-reads the files instead of re-running the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructField, StructType

from ..session import checkpoint_dir
from ..sources.dimensions import bounded_broadcast

_LOCAL_BITS = 33  # monotonically_increasing_id: partition id above bit 33, row index below


def _partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return int(num_partitions)
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def with_global_position(df: DataFrame, order: Sequence[Column | str], pos_col: str = "pos",
                         total_col: str | None = None, num_partitions: int | None = None) -> DataFrame:
    """Adds ``pos_col``: the 0-based position of each row in ``order`` (ties broken by the order
    given, so pass a total order). ``total_col`` optionally adds the row count."""
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    checkpoint_dir(df.sparkSession)
    ranged = (df.repartitionByRange(_partitions(df, num_partitions), *order)
              .sortWithinPartitions(*order).checkpoint(eager=True))
    counts = ranged.groupBy(F.spark_partition_id().alias("_pid")).agg(F.count(F.lit(1)).alias("_cnt"))
    every = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"),
                            F.sum("_cnt").over(every).alias("_total"))
    rows = (ranged
            .withColumn("_mid", F.monotonically_increasing_id())
            .withColumn("_pid", F.shiftright("_mid", _LOCAL_BITS).cast("int"))
            .withColumn("_local", F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))))
    out = rows.join(F.broadcast(offsets), "_pid", "inner").withColumn(pos_col, F.col("_off") + F.col("_local"))
    keep = list(df.columns) + [pos_col] + ([total_col] if total_col else [])
    if total_col:
        out = out.withColumn(total_col, F.col("_total"))
    return out.select(*keep)


def _changes(batch: pa.RecordBatch, names: Sequence[str], last: list | None) -> np.ndarray:
    """For each row of a sorted batch: whether it differs from the row before (``last``: the row before
    the batch) in any of ``names``. NULL equals NULL and NaN equals NaN, as in grouping."""
    out = np.zeros(batch.num_rows, bool)
    for i, name in enumerate(names):
        col = batch.column(batch.schema.get_field_index(name))
        head = pa.array([last[i] if last else None], col.type)
        both = pa.concat_arrays([head, col])
        x, y = both.slice(0, len(col)), both.slice(1)
        same = pc.fill_null(pc.equal(x, y), False)
        if pa.types.is_floating(col.type):
            same = pc.or_(same, pc.and_(pc.fill_null(pc.is_nan(x), False), pc.fill_null(pc.is_nan(y), False)))
        same = pc.or_(same, pc.and_(pc.is_null(x), pc.is_null(y)))
        out |= ~same.to_numpy(zero_copy_only=False)
    if last is None:
        out[0] = True
    return out


def _number_runs(batches: Iterator[pa.RecordBatch], names: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """Adds the partition, each row's number in its run of equal ``names`` within the partition (from 1),
    whether that run is the partition's first, and the row's number in the partition."""
    pid = TaskContext.get().partitionId()
    last, run, runs, seen = None, 0, 0, 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        new = _changes(batch, names, last)
        at = np.arange(n)
        start = np.maximum.accumulate(np.where(new, at, -1))
        number = np.where(start >= 0, at - start + 1, run + at + 1)
        first = runs + np.cumsum(new) == 1
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(n, pid, np.int32)), pa.array(number), pa.array(first), pa.array(seen + at)],
            names=[*batch.schema.names, "_pid", "_run_pos", "_first_run", "_at"])
        last = [batch.column(batch.schema.get_field_index(c))[n - 1].as_py() for c in names]
        run, runs, seen = int(number[-1]), runs + int(new.sum()), seen + n


def segment_row_number(df: DataFrame, segment: Sequence[str], order: Sequence[Column | str],
                       out_col: str = "row_number", num_partitions: int | None = None,
                       size_col: str | None = None) -> DataFrame:
    """1-based row number inside each segment (``row_number() OVER (PARTITION BY segment ORDER BY
    order)``) without gathering a segment in one task and without a join on the segment.

    Rows are range-partitioned and sorted on (segment, order), so a segment is a run of rows that may
    go on over several partitions. A pass over each partition numbers the rows of its runs (Arrow
    batches, one row kept between them). Only a partition's first run can have begun earlier: its
    carry is the sum of that segment's last runs in the partitions before. There is one carry a
    partition, a proven bound, so the carries are broadcast. ``size_col`` optionally adds the
    segment's row count, for few segments: their counts are broadcast behind a check of their number."""
    seg_cols = [F.col(c) for c in segment]
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    names = list(segment)
    checkpoint_dir(df.sparkSession)
    ranged = (df.repartitionByRange(_partitions(df, num_partitions), *seg_cols, *order)
              .sortWithinPartitions(*seg_cols, *order).checkpoint(eager=True))
    schema = StructType(ranged.schema.fields + [StructField("_pid", IntegerType()), StructField("_run_pos", LongType()),
                                                StructField("_first_run", BooleanType()), StructField("_at", LongType())])
    numbered = ranged.mapInArrow(lambda batches: _number_runs(batches, names), schema)
    key = F.struct(*names)
    ends = ranged.select(*names).mapInArrow(
        lambda batches: _number_runs(batches, names), StructType([ranged.schema[c] for c in names] + schema.fields[-4:])
    ).groupBy("_pid").agg(F.min_by(key, "_at").alias("head"), F.count_if("_first_run").alias("head_rows"),
                          F.max_by(F.struct(key.alias("key"), "_run_pos", "_first_run"), "_at").alias("tail"))
    runs = (ends.select("_pid", F.col("head").alias("key"), F.col("head_rows").alias("rows"), F.lit(True).alias("is_head"))
            .unionByName(ends.where(~F.col("tail._first_run"))
                         .select("_pid", "tail.key", F.col("tail._run_pos").alias("rows"), F.lit(False).alias("is_head"))))
    before = Window.partitionBy("key").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    carry = (runs.withColumn("_carry", F.coalesce(F.sum("rows").over(before), F.lit(0)))
             .where("is_head").select("_pid", "_carry"))
    out = (numbered.join(F.broadcast(carry), "_pid", "inner")
           .withColumn(out_col, F.col("_run_pos") + F.when(F.col("_first_run"), F.col("_carry")).otherwise(F.lit(0))))
    if size_col is None:
        return out.select(*df.columns, out_col)
    sizes = bounded_broadcast(ranged.groupBy(key.alias("_segment")).agg(F.count(F.lit(1)).alias(size_col)))
    return out.join(sizes, key.eqNullSafe(F.col("_segment")), "inner").select(*df.columns, out_col, size_col)


def decile_of(pos: Column, n: Column, k: int = 10) -> Column:
    """Equal-frequency bucket 1..k of a 0-based rank ``pos`` among ``n`` rows (1 = first):
    ``max(1, ceil(k * pos / (n - 1)))`` in integer arithmetic; a single row is bucket 1."""
    return (F.when(n <= 1, F.lit(1))
            .otherwise(F.greatest(F.lit(1), F.floor((F.lit(k) * pos + n - 2) / (n - 1)).cast("bigint")))
            ).cast("int")


def with_deciles(df: DataFrame, order: Sequence[Column | str], k: int = 10, rank_col: str = "rank",
                 decile_col: str = "decile", num_partitions: int | None = None) -> DataFrame:
    placed = with_global_position(df, order, pos_col=rank_col, total_col="_n", num_partitions=num_partitions)
    return placed.withColumn(decile_col, decile_of(F.col(rank_col), F.col("_n"), k)).drop("_n")
