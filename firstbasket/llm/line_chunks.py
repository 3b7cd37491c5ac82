"""Line deduplication on content-defined chunks of lines.

A rolling hash (a cyclic polynomial over the hashes of lines that aren't blank) moves over the text.
Its window at a line is the fewest lines from it on that are several and hold ``min_words`` words, or
the line alone if it holds ``long_words``. Of the windows that start within a window, the one with the
smallest rolling hash is a boundary and opens a chunk; a long line always is one. So each stretch of
two windows has a boundary, and which line it is depends on the stretch only: an insertion before or
after it moves nothing. A chunk runs from its boundary to the end of the boundary's window.

Chunks that occur again anywhere (in another text, or further on in the same one) are removed but for
their first occurrence; equality is that of the bytes, blank lines between included. Neighbouring
repeated chunks whose first occurrences are neighbours too are joined into runs, and a run whose bytes
agree grows over the lines before and after it while they agree as well, up to a long line, which has
a chunk of its own. A repeated passage of three lines and 50 words thus goes whole, from its first
line to its last. Every line that goes has an equal one at an earlier place.

Only hashes and places are gathered at first: (hash, row, first line, last line). Those whose hash
occurs once drop out in a join with the repeated hashes. The bytes of a run, of its first occurrence
and of the few short lines about both are then fetched, once each, and compared. The joins by hash and
by first occurrence read written tables on both sides, so adaptive execution can split a very common
chunk. Texts meet their runs and their removals in merge joins whatever the sizes, so disk grows as
the input does. SQL functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .work import Work, free_names, named

LONG_WORDS = 20
MIN_WORDS = 15
BEFORE, AFTER = 32, 64  # lines that a run can grow by: more than lie between a passage's end and its next chunk, with a blank line each


def _words(line: Column) -> Column:
    """Words parted by runs of white space (space, 09-0D), as ``entropy_mix.size_of`` counts them: a
    blank line has none, and indentation adds none."""
    return F.regexp_count(line, F.lit(r"[^\x20\x09-\x0D]+"))


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once however often it occurs there."""
    return F.transform(F.array(value), body)[0]


def _chunks(text: Column, long_words: int, min_words: int) -> Column:
    """array<struct<hash, first, last>>: a text's content-defined chunks."""
    alone = max(min_words, long_words)

    # ``at``: for each word (at most min_words a line) the line it stands in, among those that aren't blank.
    def windows(solid: Column, at: Column) -> Column:
        def opened(k: Column, p: Column) -> Column:
            last = F.get(at, p + (min_words - 1))
            return F.when(F.get(at, p - 1).eqNullSafe(k), None).when(F.get(solid, k).getField("words") >= alone, k).when(
                last.isNotNull() & (k + 1 < F.size(solid)), F.greatest(last, k + 1))

        # The last line of each line's window. Only lines at the text's end have none.
        return F.filter(F.transform(at, opened), lambda x: x.isNotNull())

    def rolled(solid: Column, ends: Column) -> Column:
        return F.transform(ends, lambda last, k: F.aggregate(F.slice(solid, k + 1, last - k + 1), F.lit(0).cast("bigint"), lambda r, x: (
            F.shiftleft(r, 1).bitwiseOR(F.shiftrightunsigned(r, 63)).bitwiseXOR(x.getField("h")))))

    def boundaries(rolls: Column, ends: Column) -> Column:
        return F.array_distinct(F.transform(ends, lambda last, k: _let(F.slice(rolls, k + 1, last - k + 1), lambda near: (
            k + F.array_position(near, F.array_min(near)) - 1))))

    def chunks(hashes: Column, solid: Column, ends: Column) -> Column:
        def chunk(k: Column) -> Column:
            first = F.get(solid, k.cast("int")).getField("i")
            last = F.get(solid, F.get(ends, k.cast("int"))).getField("i")
            return F.struct(F.xxhash64(F.slice(hashes, first + 1, last - first + 1)).alias("hash"), first.alias("first"), last.alias("last"))

        return _let(rolled(solid, ends), lambda rolls: F.transform(boundaries(rolls, ends), chunk))

    def placed(hashes: Column, solid: Column) -> Column:
        at = F.flatten(F.transform(solid, lambda x, k: F.array_repeat(k, F.least(x.getField("words"), F.lit(min_words)))))
        return _let(_let(at, lambda a: windows(solid, a)), lambda ends: chunks(hashes, solid, ends))

    marks = F.transform(F.split(text, "\n", -1), lambda x, i: F.struct(i.alias("i"), F.xxhash64(x).alias("h"), _words(x).alias("words")))
    return _let(marks, lambda m: _let(F.transform(m, lambda x: x.getField("h")),
                                      lambda h: _let(F.filter(m, lambda x: x.getField("words") > 0), lambda solid: placed(h, solid))))


def _short(lines: Column, alone: int) -> Column:
    """``lines`` up to the first of ``alone`` words or more."""
    end = F.array_position(F.transform(lines, lambda x: _words(x) >= alone), True).cast("int")
    return F.when(end > 0, F.slice(lines, 1, F.greatest(end - 1, F.lit(0)))).otherwise(lines)


def _about(lines: Column, first: Column, last: Column, alone: int) -> list[Column]:
    """The short lines before ``first`` (nearest first) and after ``last``."""
    n = F.least(first, F.lit(BEFORE))
    return [_short(F.reverse(F.slice(lines, first - n + 1, n)), alone).alias("before"), _short(F.slice(lines, last + 2, AFTER), alone).alias("after")]


def _grown(ours: str, theirs: str) -> Column:
    """How many leading lines agree, the last of them not blank."""
    differs = F.array_position(F.zip_with(ours, theirs, lambda x, y: ~x.eqNullSafe(y)), True).cast("int")
    same = F.when(differs > 0, differs - 1).otherwise(F.size(ours))
    return F.coalesce(F.array_max(F.transform(F.slice(F.col(ours), 1, same), lambda x, i: F.when(_words(x) > 0, i + 1).otherwise(0))), F.lit(0))


def _removals(work: Work, docs: DataFrame, long_words: int, min_words: int) -> DataFrame:
    """(row, id, first, last) of the lines to remove, of ``docs`` (row, id_, text_)."""
    text = F.coalesce("text_", F.lit(""))
    placed = work.save(docs.select("row", F.col("id_").alias("id"), F.inline(_chunks(text, long_words, min_words))), "placed")
    repeated = work.save(placed.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("hash"), "repeated")
    hits = work.save(placed.join(repeated, "hash"), "hits")
    order = F.struct(F.col("id").isNull().alias("null"), "id", "row", "first", "last")
    kept = work.save(hits.groupBy("hash").agg(F.min(order).alias("keep")), "kept")
    again = (hits.join(kept, "hash").filter(order != F.col("keep"))
             .select("row", "id", "first", "last", F.col("keep.row").alias("kept_row"), F.col("keep.id").alias("kept_id"),
                     (F.col("first") - F.col("keep.first")).alias("shift"))
             .filter(~((F.col("row") == F.col("kept_row")) & F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("last") - F.col("shift") >= F.col("first")))))
    # Runs: chunks that overlap or touch, as their first occurrences do.
    pair = ["row", "id", "kept_row", "kept_id", "shift"]
    by = Window.partitionBy(*pair).orderBy("first", "last")
    reach = F.max("last").over(by.rowsBetween(Window.unboundedPreceding, -1))
    starts = again.withColumn("starts", F.coalesce(F.col("first") > reach + 1, F.lit(True)).cast("int"))
    runs = work.save(starts.withColumn("run", F.sum("starts").over(by.rowsBetween(Window.unboundedPreceding, 0))).groupBy(*pair, "run")
                     .agg(F.min("first").alias("first"), F.max("last").alias("last"), F.collect_set(F.struct("first", "last")).alias("parts"))
                     .withColumns({"kept_first": F.col("first") - F.col("shift"), "kept_last": F.col("last") - F.col("shift")}).drop("run", "shift"), "runs")
    place = ["kept_row", "kept_id", "kept_first", "kept_last"]
    firsts = runs.select(*place).distinct().select(
        F.col("kept_row").alias("row"), F.col("kept_id").alias("id"), F.col("kept_first").alias("first"), F.col("kept_last").alias("last"))
    wanted = runs.unionByName(firsts, allowMissingColumns=True)
    ask = ["first", "last", "parts", *place]
    wanted = wanted.groupBy(F.col("row").alias("row_"), "id").agg(F.collect_list(F.struct(*ask)).alias("asked"))
    got = docs.join(wanted.hint("merge"), (F.col("row") == F.col("row_")) & F.col("id_").eqNullSafe(F.col("id"))).select("row", "id", F.inline(_let(
        F.split(text, "\n", -1), lambda lines: F.transform("asked", lambda r: F.struct(*(r.getField(c).alias(c) for c in ask), F.array_join(
            F.slice(lines, r.getField("first") + 1, r.getField("last") - r.getField("first") + 1), "\n").alias("body"),
            *_about(lines, r.getField("first"), r.getField("last"), max(min_words, long_words)))))))
    got = work.save(got, "bodies")
    bodies = got.filter("kept_row is null").groupBy(F.col("row").alias("row_"), F.col("id").alias("id_"), F.col("first").alias("first_"),
                                                    F.col("last").alias("last_")).agg(F.first(F.struct("body", "before", "after")).alias("kept"))
    bodies = bodies.select("row_", "id_", "first_", "last_", *(F.col(f"kept.{c}").alias(f"kept_{c}") for c in ("body", "before", "after")))
    bodies = work.save(bodies, "first_bodies")
    same = got.filter("kept_row is not null").join(bodies, (F.col("kept_row") == F.col("row_")) & F.col("kept_id").eqNullSafe(F.col("id_"))
                                                   & (F.col("kept_first") == F.col("first_")) & (F.col("kept_last") == F.col("last_")))

    def part(body: str, p: Column) -> Column:
        return F.slice(F.split(body, "\n", -1), p.getField("first") - F.col("first") + 1, p.getField("last") - p.getField("first") + 1)

    whole = F.array(F.struct((F.col("first") - _grown("before", "kept_before")).alias("first"), (F.col("last") + _grown("after", "kept_after")).alias("last")))
    return work.save(same.select("row", "id", F.inline(F.when(F.col("body") == F.col("kept_body"), whole).otherwise(
        F.filter("parts", lambda p: part("body", p) == part("kept_body", p))))), "removals")


def _gone(removals: DataFrame) -> DataFrame:
    return removals.groupBy("row", F.col("id").alias("gone_id")).agg(F.collect_set(F.struct("first", "last")).alias("gone"))


def _numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``row``: with the id it tells rows apart, and a lost task finds it again: the hash of the row's id
    and text. Rows that agree in both are one row, so they keep or lose the same chunks."""
    return docs.withColumn("row", F.xxhash64(F.col(named([], id_col)).cast("string"), F.col(named([], text_col)).cast("string")))


def _taken(gone: Column) -> Column:
    """The numbers of the lines that go."""
    return F.array_distinct(F.flatten(F.transform(gone, lambda g: F.sequence(g["first"], g["last"]))))


def _rest(lines: Column, taken: Column) -> Column:
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), taken)
    return F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")


def _without(text: Column, gone: Column) -> Column:
    return F.when(gone.isNull(), text).otherwise(_let(F.split(text, "\n", -1), lambda lines: _rest(lines, _taken(gone))))


def removed_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", long_words: int = LONG_WORDS,
                   min_words: int = MIN_WORDS) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, n_lines, n_removed (lines), words_removed,
    text_sha256 (of the text that stays). See ``drop_repeated_chunks`` for the rules."""
    work = Work(docs.sparkSession, "lines")
    narrow = _numbered(docs.select(F.col(named([], id_col)).alias("id_"), F.col(named([], text_col)).cast("string").alias("text_")), "id_", "text_")
    gone = _gone(_removals(work, narrow, long_words, min_words))
    text = F.coalesce("text_", F.lit(""))

    def report(lines: Column, taken: Column) -> Column:
        words = F.aggregate(taken, F.lit(0).cast("long"), lambda total, i: total + _words(F.get(lines, i)))
        return F.struct(F.size(taken).cast("long").alias("n_removed"), words.alias("words_removed"), F.sha2(_rest(lines, taken), 256).alias("text_sha256"))

    cut = _let(F.split(text, "\n", -1), lambda lines: _let(_taken(F.col("gone")), lambda taken: report(lines, taken)))
    stays = F.struct(F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("words_removed"), F.sha2(text, 256).alias("text_sha256"))
    return (narrow.join(gone.withColumnRenamed("row", "gone_row").hint("merge"), (F.col("row") == F.col("gone_row")) & F.col("id_").eqNullSafe(F.col("gone_id")), "left")
            .select(F.col("id_").alias(id_col), F.size(F.split(text, "\n", -1)).cast("long").alias("n_lines"),
                    F.inline(F.array(F.when(F.col("gone").isNull(), stays).otherwise(cut)))))


def drop_repeated_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", long_words: int = LONG_WORDS,
                         min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of ``docs``, all columns, with repeated chunks of lines removed from the text.

    The first occurrence by id (null last) and place stays. A text of which nothing stays is empty; a
    null text stays null; rows that agree in id and text count as one row and get the same text.
    Single lines of under ``long_words`` words, such as headings, stay. Columns other than the two are passed on."""
    work = Work(docs.sparkSession, "lines")
    row, gone_row, gone_id, gone_name = free_names(docs.columns, "row", "gone_row", "gone_id", "gone")
    narrow = _numbered(docs.select(F.col(named([], id_col)).alias("id_"), F.col(named([], text_col)).cast("string").alias("text_")), "id_", "text_")
    gone = _gone(_removals(work, narrow, long_words, min_words))
    gone = gone.select(F.col("row").alias(gone_row), F.col("gone_id").alias(gone_id), F.col("gone").alias(gone_name))
    text = F.col(named([], text_col))
    keyed = docs.withColumn(row, F.xxhash64(F.col(named([], id_col)).cast("string"), text.cast("string")))
    out = keyed.join(gone.hint("merge"), (F.col(row) == F.col(gone_row)) & F.col(named([], id_col)).eqNullSafe(F.col(gone_id)), "left")
    return out.withColumn(text_col, _without(text.cast("string"), F.col(gone_name))).select(*[named([], c) for c in docs.columns])
