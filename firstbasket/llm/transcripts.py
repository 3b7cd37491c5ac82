"""Transcript parsing: roles by a hidden Markov model, then canonical turns.

A transcript is numbered lines. A state is a role together with whether the line opens a turn; a
line shows a speaker marker (or none), its length, a closing question mark, and whether it is the
first. Transition and emission counts come from transcripts whose roles are known, summed by Spark
(their number is fixed); Viterbi finds the best states of each transcript.

A transcript may be longer than a task should hold. Its lines are cut into chunks of ``CHUNK`` line
numbers, and a chunk is a (max, +) matrix from state to state: chunks are summarised in parallel, the
matrices of a transcript are multiplied in order, which settles the state at each chunk's end, and
the chunks are decoded in parallel. A transcript that fits one chunk takes the same path.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .work import Work

ROLES = ("system", "user", "assistant")
STATES = [(r, o) for r in range(len(ROLES)) for o in (True, False)]
CHUNK = 256
_CHUNKS = 512  # decoded at a time
# Speaker markers of common transcripts.
MARKERS = (
    (0, r"^\s*(?:<\|system\|>|\[system\]|#+ ?system:?|(?:system|instructions?)\s*:)\s*"),
    (1, r"^\s*(?:<\|user\|>|\[user\]|#+ ?(?:user|human):?|(?:user|human|customer|question|q)\s*:)\s*"),
    (2, r"^\s*(?:<\|assistant\|>|\[assistant\]|#+ ?(?:assistant|response):?|(?:assistant|ai|bot|agent|answer|a)\s*:)\s*"),
)
N_MARKS, N_LENGTHS = len(MARKERS) + 1, 8
N_SYMBOLS = N_MARKS * N_LENGTHS * 2 * 2


def symbol(line: Column, first: Column) -> Column:
    """What a line shows, as a number under ``N_SYMBOLS``."""
    mark = F.lit(len(MARKERS))
    for k, pattern in reversed(MARKERS):
        mark = F.when(line.rlike("(?i)" + pattern), k).otherwise(mark)
    length = F.least(F.floor(F.log2(F.length(line) + 1.0) / 1.5), F.lit(N_LENGTHS - 1))
    asks = F.rtrim(line).endswith("?")
    return (((mark * N_LENGTHS + length) * 2 + asks.cast("int")) * 2 + first.cast("int")).cast("int")


def unmarked(line: Column) -> Column:
    for _, pattern in MARKERS:
        line = F.regexp_replace(line, "(?i)" + pattern, "")
    return line


def learn(lines: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log chances (start, transition, emission), with one added to every count, from rows (conv, line,
    symbol, role, opens). Rows of other roles count for nothing."""
    known = lines.filter(F.col("role").isin(*ROLES))
    state = F.array_position(F.array(*map(F.lit, ROLES)), F.col("role")).cast("int") * 2 - 2 + F.when(F.col("opens"), 0).otherwise(1)
    known = known.select("conv", "line", "symbol", state.alias("state"))
    after = known.select("conv", (F.col("line") - 1).alias("line"), F.col("state").alias("next"))
    start, move, show = np.ones(6), np.ones((6, 6)), np.ones((6, N_SYMBOLS))
    for r in known.groupBy("state", "symbol").count().collect():
        show[r.state, r.symbol] += r["count"]
    for r in known.join(after, ["conv", "line"]).groupBy("state", "next").count().collect():
        move[r.state, r.next] += r["count"]
    for r in known.filter("line = 0").groupBy("state").count().collect():
        start[r.state] += r["count"]
    start[1::2] = 1e-9  # a transcript's first line opens a turn
    for r in range(3):  # a line that goes on has the role of the line before
        for s in range(6):
            if s // 2 != r:
                move[s, 2 * r + 1] = 1e-9
    return tuple(np.log(x / x.sum(axis=-1, keepdims=True)) for x in (start, move, show))


def _padded(symbols: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """(symbols [chunk, line], zero beyond a chunk's end; lengths)."""
    n = np.array([len(x) for x in symbols], np.int64)
    out = np.zeros((len(symbols), int(n.max(initial=0))), np.int64)
    for row, x in zip(out, symbols):
        row[: len(x)] = x
    return out, n


def _moves(at: np.ndarray, opens: np.ndarray, t: int, model: tuple) -> np.ndarray:
    """[chunk, state before, state]: chances of a step to line ``t`` of the chunks ``at``."""
    start, move, _ = model
    out = np.repeat(move[None], len(at), axis=0)
    if t == 0:
        out[opens[at]] = start
    return out


def _summary(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    """A chunk's matrix [state before, state of its last line], for many chunks at a time. Before a
    transcript's first line is state 0."""
    show = model.value[2]
    for whole in batches:
        for batch in _pieces(whole):
            symbols, n = _padded(batch.column(3).to_pylist())
            opens = batch.column(2).to_numpy() == 0
            matrix = np.repeat(np.where(np.eye(6) > 0, 0.0, -np.inf)[None], len(n), axis=0)
            for t in range(symbols.shape[1]):
                at = np.flatnonzero(n > t)
                step = _moves(at, opens, t, model.value) + show[:, symbols[at, t]].T[:, None, :]
                matrix[at] = (matrix[at][:, :, :, None] + step[:, None]).max(axis=2)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(matrix.reshape(len(n), 36)), pa.list_(pa.float64()))],
                                             names=["conv", "chunk", "matrix"])


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The best path through a transcript's chunks: each one's state before it and at its end."""
    for batch in batches:
        before, ends = [], []
        for matrices in batch.column(1).to_pylist():
            value, back, path = np.full(6, -np.inf), [], []
            value[0] = 0.0
            for m in matrices:
                score = value[:, None] + np.array(m, float).reshape(6, 6)
                back.append(score.argmax(axis=0))
                value = score.max(axis=0)
            state, into = int(value.argmax()), []
            for b in reversed(back):
                path.append(state)
                state = int(b[state])
                into.append(state)
            before.append(into[::-1])
            ends.append(path[::-1])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(before, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int32()))],
                                         names=["conv", "before", "ends"])


def _decode(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    """The best states of many chunks at a time, each between its known ends."""
    show = model.value[2]
    for whole in batches:
        for batch in _pieces(whole):
            symbols, n = _padded(batch.column(2).to_pylist())
            opens = batch.column(1).to_numpy() == 0
            every = np.arange(len(n))
            value = np.full((len(n), 6), -np.inf)
            value[every, batch.column(3).to_numpy()] = 0.0
            back = np.zeros((symbols.shape[1], len(n), 6), np.int64)
            for t in range(symbols.shape[1]):
                at = np.flatnonzero(n > t)
                score = value[at][:, :, None] + _moves(at, opens, t, model.value)
                back[t, at] = score.argmax(axis=1)
                value[at] = score.max(axis=1) + show[:, symbols[at, t]].T
            state, states = batch.column(4).to_numpy().astype(np.int64), np.zeros(symbols.shape, np.int64)
            for t in range(symbols.shape[1] - 1, -1, -1):
                at = np.flatnonzero(n > t)
                states[at, t] = state[at]
                state[at] = back[t, at, state[at]]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x[:k] for x, k in zip(states, n)], pa.list_(pa.int64()))],
                                             names=["conv", "first", "states"])


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, _CHUNKS):
        yield batch.slice(at, _CHUNKS)


def decode(work: Work, lines: DataFrame, model: tuple[np.ndarray, np.ndarray, np.ndarray]) -> DataFrame:
    """(conv, line, role_found, opens_found) of rows (conv, line: from 0 without gaps, symbol)."""
    block = work.spark.sparkContext.broadcast(model)
    kind = lines.schema["conv"].dataType.simpleString()
    chunks = (lines.groupBy("conv", F.floor(F.col("line") / CHUNK).alias("chunk")).agg(F.sort_array(F.collect_list(F.struct("line", "symbol"))).alias("l"))
              .select("conv", "chunk", F.get("l", F.lit(0))["line"].alias("first"), F.transform("l", lambda x: x["symbol"]).alias("symbols")))
    chunks = work.save(chunks, "chunks")
    sums = chunks.mapInArrow(partial(_summary, model=block), f"conv {kind}, chunk bigint, matrix array<double>")
    rows = sums.groupBy("conv").agg(F.transform(F.sort_array(F.collect_list(F.struct("chunk", "matrix"))), lambda x: x["matrix"]).alias("matrices"))
    ends = rows.mapInArrow(_ends, f"conv {kind}, before array<int>, ends array<int>")
    ends = work.save(ends.select("conv", F.posexplode(F.arrays_zip("before", "ends")).alias("chunk", "x"))
                     .select("conv", F.col("chunk").cast("long").alias("chunk"), "x.before", F.col("x.ends").alias("end")), "ends")
    found = (chunks.join(ends, ["conv", "chunk"]).select("conv", "first", "symbols", "before", "end")
             .mapInArrow(partial(_decode, model=block), f"conv {kind}, first bigint, states array<bigint>"))
    state = F.col("state")
    return (found.select("conv", "first", F.posexplode("states").alias("at", "state"))
            .select("conv", (F.col("first") + F.col("at")).alias("line"),
                    F.get(F.array(*map(F.lit, ROLES)), F.floor(state / 2).cast("int")).alias("role_found"), (state % 2 == 0).alias("opens_found")))


def render(decoded: DataFrame) -> DataFrame:
    """(conv, turn, role, text) of rows (conv, line, role_found, opens_found, text): lines from one
    opening to the next make a turn, their markers removed. A line's turn is the count of openings up to
    it, made from the openings of whole chunks and of the lines in a chunk."""
    from pyspark.sql import Window
    d = decoded.withColumn("chunk", F.floor(F.col("line") / CHUNK))
    here = Window.partitionBy("conv", "chunk").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    opened = d.groupBy("conv", "chunk").agg(F.sum(F.col("opens_found").cast("int")).alias("n"))
    opened = opened.select(F.col("conv").alias("c"), F.col("chunk").alias("k"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    turn = F.col("base") + F.sum(F.col("opens_found").cast("int")).over(here) - 1
    numbered = d.join(opened, (F.col("conv") == F.col("c")) & (F.col("chunk") == F.col("k"))).withColumn("turn", turn)
    return (numbered.groupBy("conv", "turn").agg(F.sort_array(F.collect_list(F.struct("line", "role_found", unmarked(F.col("text")).alias("text")))).alias("l"))
            .select("conv", F.col("turn").cast("long").alias("turn"), F.get("l", F.lit(0))["role_found"].alias("role"),
                    F.array_join(F.transform("l", lambda x: x["text"]), "\n").alias("text")))


def parse(transcripts: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lines with role_found and opens_found, turns) of transcript lines (conv, line, text, role, opens),
    the model learned from the rows of ``known`` of the same columns. conv must not be null."""
    work = Work(transcripts.sparkSession, "transcripts")
    shown = lambda df: df.withColumn("symbol", symbol(F.col("text"), F.col("line") == 0))
    lines = work.save(shown(transcripts), "lines")
    found = decode(work, lines, learn(shown(known)))
    out = work.save(lines.join(found, ["conv", "line"]), "decoded")
    return out, render(out.select("conv", "line", "role_found", "opens_found", "text"))


def as_transcripts(conversations: DataFrame) -> DataFrame:
    """Plain transcript lines (conv, line, text, role, opens) of a table of turns (conv_id, turn, role,
    text), written as transcripts are found: a conversation has a marker style of its own, and a turn
    opens with its role's marker two times in three and with none otherwise. Turns are ordered by
    number (null first), then role and text; a null text is an empty line; a null conv_id is one
    conversation, written ''; equal rows are equal turns. The line numbers of a conversation go on
    from turn to turn by sums over blocks of turn numbers."""
    from pyspark.sql import Window
    styles = [("System: ", "User: ", "Assistant: "), ("<|system|>", "<|user|>", "<|assistant|>"), ("[system] ", "[user] ", "[assistant] "),
              ("### System: ", "### Human: ", "### Response: "), ("Instructions: ", "Q: ", "A: ")]
    conv = F.coalesce(F.col("conv_id").cast("string"), F.lit(""))
    pick = F.pmod(F.crc32(conv.cast("binary")), F.lit(len(styles)))
    place = F.coalesce(F.array_position(F.array(*map(F.lit, ROLES)), F.col("role")), F.lit(0)).cast("int")
    marker = F.lit("")
    for k, names in enumerate(styles):
        for r, name in enumerate(names):
            marker = F.when((pick == k) & (place == r + 1), name).otherwise(marker)
    bare = F.pmod(F.xxhash64(conv, "turn"), F.lit(3)) == 0
    text = F.concat(F.when(bare, "").otherwise(marker), F.coalesce("text", F.lit("")))
    turns = conversations.select(conv.alias("conv"), "turn", "role", F.split(text, "\n", -1).alias("lines")).withColumn("n", F.size("lines"))
    block = F.floor(F.coalesce(F.col("turn"), F.lit(-1)) / CHUNK)
    turns = turns.withColumn("block", block)
    blocks = turns.groupBy("conv", "block").agg(F.sum("n").alias("n"))
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(F.col("conv").alias("c"), F.col("block").alias("b"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    here = Window.partitionBy("conv", "block").orderBy("turn", "role", "lines").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("n").over(here), F.lit(0)) + F.col("base")
    placed = turns.join(blocks, (F.col("conv") == F.col("c")) & (F.col("block") == F.col("b"))).select("conv", first.alias("first"), "role", "lines")
    return placed.select("conv", "first", "role", F.posexplode("lines").alias("at", "text")).select(
        "conv", (F.col("first") + F.col("at")).cast("long").alias("line"), "text", "role", (F.col("at") == 0).alias("opens"))


def canonical(conversations: DataFrame) -> DataFrame:
    """Parses the transcripts of a table of conversations back: one row a conversation (conv_id text,
    held_out, n_lines, n_right: lines whose role was recovered, n_turns, rendered_sha256 of the canonical
    rendering ``<|role|>\\ntext<|end|>\\n`` of its turns' digests in order). The model learns from the
    conversations whose crc32 isn't divisible by 5; the others are held out."""
    work = Work(conversations.sparkSession, "chat")
    lines = work.save(as_transcripts(conversations), "transcripts")
    held = F.pmod(F.crc32(F.col("conv").cast("binary")), F.lit(5)) == 0
    decoded, turns = parse(lines, lines.filter(~held))
    right = decoded.groupBy("conv").agg(F.count(F.lit(1)).alias("n_lines"), F.sum((F.col("role") == F.col("role_found")).cast("long")).alias("n_right"))
    shown = turns.select("conv", F.struct("turn", F.sha2(F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"), F.col("text"), F.lit("<|end|>\n")), 256).alias("d")).alias("t"))
    text = shown.groupBy("conv").agg(F.count(F.lit(1)).alias("n_turns"), F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list("t")), lambda t: t["d"]), ""), 256).alias("rendered_sha256"))
    return right.join(text, "conv").select(F.col("conv").alias("conv_id"), held.alias("held_out"), "n_lines", F.coalesce("n_right", F.lit(0)).alias("n_right"), "n_turns", "rendered_sha256")
