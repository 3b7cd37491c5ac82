"""Mixing sources to target weights by entropy balancing.

Every document gets the rate nearest to ``SHARE`` (in relative entropy, at most ``CAP``) such that
each source's expected words meet its target. The convex dual has one multiplier a source; its
solution tilts rates exponentially in a document's size: rate = min(CAP, SHARE * exp(m * size / mean
size)). Newton steps on the dual run on the counts of (source, size), a table that stops growing with
the rows, each a grouped sum; a step that leaves the bracket of the root halves it instead.

Rates become whole copies: a document gets floor(rate), and one more if a hash of it is under the
fraction plus a shift. The shift of a source is set from histograms of (hash - fraction), refined
once, so that the words taken come near the target; where a document too large for the rest stands in
the way, the next pass leaves it out and goes on.

Per-source tables are written between the steps and joined by source, never collected; the driver
sees one count a step. SQL functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.rank import with_global_position
from .work import Work, named

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0
STEPS = 60
TOLERANCE = 1e-9
BINS = 4096
SLICE = 10_000  # repeated rows numbered in one task
GOLDEN = 0.6180339887498949
PASSES = 3


def size_of(text: Column) -> Column:
    """Words parted by white space (space, 09-0D); null: 0."""
    flat = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return F.when(flat == "", 0).otherwise(F.length(flat) - F.length(F.replace(flat, F.lit(" "), F.lit(""))) + 1).cast("long")


def _targets(work: Work, sources: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """(source, source_size, target): weights by the sources' order, targets stop at ``cap`` times the
    size and the excess goes to the others by weight until none is above."""
    ranked = with_global_position(sources, [F.col("source").asc_nulls_last()], pos_col="place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    now = work.save(ranked.select("source", "source_size", weight.alias("weight"), F.lit(False).alias("full")), "shares")
    total = now.agg(F.sum("source_size")).first()[0] or 0
    while True:
        row = now.agg(F.sum(F.when(F.col("full"), F.col("source_size") * cap)).alias("spent"),
                      F.sum(F.when(~F.col("full"), F.col("weight"))).alias("open")).first()
        rest, open_ = share * total - (row["spent"] or 0.0), row["open"] or 0.0
        wanted = F.lit(rest) * F.col("weight") / F.lit(open_ or 1.0)
        over = ~F.col("full") & (wanted > F.col("source_size") * cap)
        if not open_ or not now.filter(over).limit(1).count():
            return work.save(now.select("source", "source_size",
                                        F.when(F.col("full"), F.col("source_size") * cap).otherwise(wanted).alias("target")), "targets")
        after = work.save(now.withColumn("full", F.col("full") | over), "shares")
        work.drop(now)
        now = after


def _tilt(work: Work, sizes: DataFrame, targets: DataFrame, share: float, cap: float, steps: int, tolerance: float) -> DataFrame:
    """(source, m, mean): the multipliers. sizes: source, size, n."""
    means = sizes.groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.greatest(F.sum("n"), F.lit(1))).alias("mean"))
    now = work.save(targets.join(means, targets.source.eqNullSafe(means.source)).select(
        targets.source, "target", "source_size", F.greatest("mean", F.lit(1.0)).alias("mean"), F.lit(0.0).alias("m"),
        F.lit(-50.0).alias("lo"), F.lit(50.0).alias("hi"), F.col("target").isNull().alias("done")), "m")
    for _ in range(steps):
        s = now.select(F.col("source").alias("s"), "m", "mean", "done").filter("not done")
        x = F.col("size") / F.col("mean")
        raw = F.least(F.lit(share) * F.exp(F.least(F.col("m") * x, F.lit(50.0))), F.lit(cap))
        words = F.col("size") * F.col("n")
        sums = (sizes.join(s, sizes.source.eqNullSafe(s.s)).groupBy("s")
                .agg(F.sum(raw * words).alias("f"), F.sum(F.when(raw < cap, raw * words * x).otherwise(0.0)).alias("slope")))
        got = now.join(sums, now.source.eqNullSafe(sums.s), "left")
        apart = F.col("f") - F.col("target")
        lo, hi = F.when(apart < 0, F.col("m")).otherwise(F.col("lo")), F.when(apart > 0, F.col("m")).otherwise(F.col("hi"))
        newton = F.col("m") - apart / F.when(F.col("slope") > 0, F.col("slope"))
        step = F.when((newton > lo) & (newton < hi), newton).otherwise((lo + hi) / 2)
        ends = F.col("done") | F.col("f").isNull() | (F.abs(apart) <= F.lit(tolerance) * F.greatest("target", F.lit(1.0))) | (hi - lo < 1e-12)
        after = work.save(got.select("source", "target", "source_size", "mean", F.when(ends, F.col("m")).otherwise(step).alias("m"),
                                     F.coalesce(F.when(ends, F.col("lo")).otherwise(lo), F.col("lo")).alias("lo"),
                                     F.coalesce(F.when(ends, F.col("hi")).otherwise(hi), F.col("hi")).alias("hi"), ends.alias("done")), "m")
        work.drop(now)
        now = after
        if not now.filter("not done").limit(1).count():
            break
    return now


def _zoom(work: Work, rates: DataFrame, now: DataFrame, bins: int) -> DataFrame:
    """One refinement for each source: of ``bins`` equal parts of [at, at + width) the most that can be
    added from the first on. Advances ``at`` to the end of those parts and takes their words off ``need``."""
    s = now.select(F.col("source").alias("s"), "need", "limit", "at", "width")
    bin_ = F.floor((F.col("margin") - F.col("at")) / F.col("width") * bins)
    inside = (rates.join(s, rates.source.eqNullSafe(s.s)).filter((F.col("margin") >= F.col("at")) & (F.col("size") <= F.col("limit")))
              .withColumn("bin", bin_).filter(F.col("bin") < bins).groupBy("s", "need", "bin").agg(F.sum("size").alias("words")))
    upto = F.sum("words").over(Window.partitionBy("s").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    reach = inside.withColumn("upto", upto)
    fits = reach.filter(F.col("upto") <= F.col("need")).groupBy("s").agg(F.max("bin").alias("last"), F.max("upto").alias("added"))
    over = reach.filter(F.col("upto") > F.col("need")).groupBy(F.col("s").alias("s2")).agg(F.min("bin").alias("over"))
    got = now.join(fits, now.source.eqNullSafe(fits.s), "left").join(over, now.source.eqNullSafe(over.s2), "left")
    # Up to the part that holds too much; to the end where none does.
    edge = F.col("at") + F.coalesce("over", F.lit(bins)) * F.col("width") / bins
    return work.save(got.select("source", (F.col("need") - F.coalesce("added", F.lit(0))).alias("need"), "limit", edge.alias("at"),
                                (F.col("width") / bins).alias("width"), "start", "passes"), "shift")


def _shift(work: Work, rates: DataFrame, targets: DataFrame, bins: int) -> DataFrame:
    """(source, passes: array<struct<start, stop, limit>>): a copy is added to the documents of at most
    ``limit`` words whose margin lies in [start, stop) of a pass. ``rates`` has source, whole (words of
    the whole copies), size, margin (null where no copy can be added). A pass goes up the margins until
    the next document is larger than what is still needed; the next pass leaves such documents out."""
    base = rates.groupBy("source").agg(F.sum("whole").alias("base"))
    now = work.save(targets.join(base, targets.source.eqNullSafe(base.source)).select(
        targets.source, (F.col("target") - F.col("base")).alias("need"), F.lit(0.0).alias("limit"), F.lit(-1.0).alias("at"), F.lit(2.0).alias("width"),
        F.lit(-1.0).alias("start"), F.array().cast("array<struct<start:double,stop:double,limit:double>>").alias("passes")), "shift")
    for _ in range(PASSES):
        now = now.withColumns({"limit": F.col("need"), "start": F.col("at"), "width": F.lit(1.0) - F.col("at")})
        now = _zoom(work, rates, _zoom(work, rates, now, bins), bins)
        now = now.withColumn("passes", F.concat("passes", F.array(F.struct("start", F.col("at").alias("stop"), "limit"))))
    return work.save(now.select("source", "passes"), "passes")


def _told_apart(work: Work, rows: DataFrame) -> DataFrame:
    """``rows`` with chances that differ between repeated rows: the n-th of equal ones is moved on by n
    golden sections. Equal rows are numbered in slices of about ``SLICE``, so no task holds them all;
    which of them gets which number makes no difference."""
    key = ["id", "source", "chance"]
    again = work.save(rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "again")
    if again.isEmpty():
        return rows
    a = again.select(*(F.col(c).alias(f"{c}_2") for c in key), "n")
    same = rows.id.eqNullSafe(a.id_2) & rows.source.eqNullSafe(a.source_2) & rows.chance.eqNullSafe(a.chance_2)
    sliced = work.save(rows.join(a, same, "left").select(*rows.columns, F.when(F.col("n").isNotNull(), F.pmod(
        F.xxhash64(F.monotonically_increasing_id()), F.ceil(F.col("n") / SLICE).cast("bigint"))).alias("slice")), "sliced")
    many = sliced.filter("slice is not null")
    before = (many.groupBy(*key, "slice").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("first", F.sum("n").over(Window.partitionBy(*key).orderBy("slice").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"))
              .select(*(F.col(c).alias(f"{c}_2") for c in key), F.col("slice").alias("slice_2"), "first"))
    at = F.row_number().over(Window.partitionBy(*key, "slice").orderBy(F.lit(0)))
    numbered = many.withColumn("at", at)
    joined = numbered.join(before, numbered.id.eqNullSafe(before.id_2) & numbered.source.eqNullSafe(before.source_2)
                           & (numbered.chance == before.chance_2) & (numbered.slice == before.slice_2))
    moved = F.col("chance") + (F.col("first") + F.col("at") - 1) * F.lit(GOLDEN)
    out = joined.withColumn("moved", moved - F.floor(moved)).select(*(F.col("moved").alias(c) if c == "chance" else c for c in rows.columns))
    return work.save(sliced.filter("slice is null").select(*rows.columns).unionByName(out), "told-apart")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[float] = WEIGHTS,
        share: float = SHARE, cap: float = CAP) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, size (words), source_size, target (its source's),
    taken (words the mix takes, repeats counted), copies.

    Sources by code point, null last, take ``weights`` in turn; all targets together are ``share``
    times all sizes. A null or wordless text has size 0 and takes nothing. Rows that repeat each keep a
    row; those with equal id, source and text are numbered, and the number takes part in the rounding, so
    some of them get a copy more; a null id is rounded like any other. An
    empty table gives an empty result; columns besides the three are not read. Reruns agree."""
    work = Work(docs.sparkSession, "mix")
    id_, text = F.col(named([], id_col)), F.col(named([], text_col)).cast("string")
    chance = (F.pmod(F.xxhash64(id_.cast("string"), text), F.lit(1 << 40)) / float(1 << 40))
    rows = work.save(docs.select(id_.alias("id"), F.col(named([], source_col)).cast("string").alias("source"), size_of(text).alias("size"),
                                 chance.alias("chance")), "sizes")
    rows = _told_apart(work, rows)
    sizes = work.save(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "counts")
    targets = _targets(work, sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, share, cap)
    tilt = _tilt(work, sizes, targets, share, cap, STEPS, TOLERANCE)
    t = tilt.select(F.col("source").alias("s"), "m", "mean", "target", "source_size")
    full = F.col("target") >= F.col("source_size") * cap
    rate = F.when(full, F.lit(cap)).otherwise(F.least(F.lit(share) * F.exp(F.least(F.col("m") * F.col("size") / F.col("mean"), F.lit(50.0))), F.lit(cap)))
    whole = F.floor("rate")
    rated = work.save(rows.join(t, rows.source.eqNullSafe(t.s)).withColumn("rate", rate)
                      .select("id", "source", "size", "source_size", "target", whole.alias("copies"), (F.col("size") * whole).alias("whole"),
                              F.when(whole < F.floor(F.lit(cap)), F.col("chance") - (F.col("rate") - whole)).alias("margin")), "rated")
    shift = _shift(work, rated.select("source", "whole", "size", "margin"), targets.select("source", "target"), BINS)
    s = shift.select(F.col("source").alias("s"), "passes")
    added = F.exists("passes", lambda p: (F.col("margin") >= p["start"]) & (F.col("margin") < p["stop"]) & (F.col("size") <= p["limit"]))
    copies = F.col("copies") + F.when(F.coalesce(added, F.lit(False)), 1).otherwise(0)
    return (rated.join(s, rated.source.eqNullSafe(s.s))
            .select(F.col("id").alias(id_col), "size", F.col("source_size").cast("long").alias("source_size"), "target",
                    (F.col("size") * copies).cast("long").alias("taken"), copies.cast("long").alias("copies")))
