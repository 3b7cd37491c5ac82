"""Benchmark decontamination by suffix arrays over the training documents.

A task packs whole documents into shards of about ``SHARD_WORDS`` words and builds a suffix array of
each shard. Every test suffix (each word offset of each benchmark item that starts a window) is
binary-searched in it, which gives the range of document positions that begin with the suffix's
window; from those the verbatim match is extended to its full length. Shards hold whole documents, so
the result of a document needs no shuffle, and affected documents are dropped where they are read.

A suffix array only orders the positions that can start a match: those whose word starts a window
and that are followed by enough words of the benchmark's vocabulary. That loses nothing, as a window
that occurs consists of such words.

The benchmark reaches the executors in blocks of at most ``block_words`` words, one broadcast each:
one block for any usual benchmark. With more blocks the documents are passed once per block and carry
what was found so far (hit ranges and item ids) in a table written between the passes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .work import Work, free_names, named

WINDOW = 10
SHARD_WORDS = 1 << 20
BLOCK_WORDS = 4_000_000
#: ASCII letters in lower case and digits stay, other ASCII parts words; bytes of longer code points stay.
_CLEAN = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_CLEAN).split()


class Suffixes:
    """The test suffixes of one block of items: distinct windows, and where in which item each starts."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        self.window = window
        self.names = [name for name, _ in items]
        tokens = [[self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words] for _, words in items]
        self.depth = max(map(len, tokens), default=0)
        windows: dict[tuple, int] = {}
        at: list[tuple[int, int, int]] = []  # window, item, offset
        for item, t in enumerate(tokens):
            for o in range(max(1, len(t) - window + 1) if t else 0):
                at.append((windows.setdefault(tuple(t[o : o + window]), len(windows)), item, o))
        self.start = np.zeros(len(windows) + 1, np.int64)
        self.at = np.array(sorted(at), np.int64).reshape(-1, 3)
        np.add.at(self.start, self.at[:, 0] + 1, 1)
        self.start = np.cumsum(self.start)
        self.length = np.array([len(w) for w in windows], np.int64)
        self.first = np.zeros((len(windows), window), np.int32)
        for w, k in windows.items():
            self.first[k, : len(w)] = w
        self.flat = np.concatenate([np.array(t + [0], np.int32) for t in tokens] or [np.zeros(1, np.int32)])
        self.item_start = np.concatenate(([0], np.cumsum([len(t) + 1 for t in tokens]))).astype(np.int64)
        #: The least length of the windows that start with a word; 0 where none does.
        self.need = np.zeros(len(self.vocabulary) + 1, np.int64)
        for k in np.argsort(-self.length, kind="stable"):
            self.need[self.first[k, 0]] = self.length[k]


def suffix_array(tokens: np.ndarray, positions: np.ndarray, depth: int, bits: int) -> np.ndarray:
    """``positions`` in the order of the suffixes that start there, compared up to ``depth`` words.
    ``tokens`` ends with ``depth`` zeros; words take ``bits`` bits. Keys pack as many words as fit;
    only positions that are still equal get the next key."""
    per = max(1, 62 // bits)

    def key(at: np.ndarray, k: int) -> np.ndarray:
        out = np.zeros(len(at), np.int64)
        for j in range(k, min(k + per, depth)):
            out = out << bits | tokens[at + j]
        return out

    first = key(positions, 0)
    order = np.argsort(first, kind="stable")
    out, value = positions[order], first[order]
    group = np.cumsum(np.concatenate(([0], value[1:] != value[:-1])))
    open_ = np.arange(len(out))
    for k in range(per, depth, per):
        size = np.bincount(group[open_], minlength=group[-1] + 1 if len(group) else 1)
        open_ = open_[size[group[open_]] > 1]
        if not len(open_):
            break
        value = key(out[open_], k)
        order = np.lexsort((value, group[open_]))
        out[open_], value = out[open_][order], value[order]
        old = group[open_]
        fresh = np.concatenate(([True], (old[1:] != old[:-1]) | (value[1:] != value[:-1])))
        group[open_] = np.cumsum(fresh) - 1  # numbers the open groups anew; the closed ones are done
    return out


def _search(tokens: np.ndarray, order: np.ndarray, s: Suffixes, upper: bool) -> np.ndarray:
    """For each window the first place in ``order`` whose suffix is not before it (``upper``: after it)."""
    lo, hi = np.zeros(len(s.length), np.int64), np.full(len(s.length), len(order), np.int64)
    reach = np.arange(s.window)
    inside = reach[None, :] < s.length[:, None]
    while (live := np.flatnonzero(lo < hi)).size:
        mid = (lo[live] + hi[live]) // 2
        here = tokens[order[mid][:, None] + reach]
        differs = (here != s.first[live]) & inside[live]
        at = differs.argmax(axis=1)
        row = np.arange(len(live))
        less = here[row, at] < s.first[live][row, at]
        go = np.where(differs[row, at], less, upper)
        lo[live] = np.where(go, mid + 1, lo[live])
        hi[live] = np.where(go, hi[live], mid)
    return lo


def _spread(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, ... (count[0] of them), start[1], ..."""
    return np.repeat(start - np.cumsum(count) + count, count) + np.arange(count.sum())


def search_shard(texts: list[list[bytes]], s: Suffixes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hit, matches, found): which words of the shard a window covers (with one word between texts);
    rows (text, position in it, item, offset in it, length) of the verbatim matches that can't be
    extended on either side; distinct (text, item) pairs."""
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes)))
    get = s.vocabulary.get
    tokens = np.zeros(starts[-1] + max(s.depth, s.window) + 1, np.int32)
    for a, t in zip(starts.tolist(), texts):
        tokens[a : a + len(t)] = np.fromiter((get(w, 0) for w in t), np.int32, len(t))
    n = int(starts[-1])
    none = np.empty((0, 5), np.int64)
    hit = np.zeros(n, bool)
    end = np.minimum.accumulate(np.where(tokens[:n] == 0, np.arange(n), n)[::-1])[::-1]
    need = s.need[tokens[:n]]
    positions = np.flatnonzero((need > 0) & (end - np.arange(n) >= need))
    if not len(positions):
        return hit, none, none[:, :2]
    order = suffix_array(tokens, positions, max(s.depth, 1), max(1, int(len(s.vocabulary)).bit_length()))
    lo, hi = _search(tokens, order, s, False), _search(tokens, order, s, True)
    count = hi - lo
    window, where = np.repeat(np.arange(len(count)), count), order[_spread(lo, count)]
    if not len(where):
        return hit, none, none[:, :2]
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, where, 1)
    np.add.at(edge, where + s.length[window], -1)
    hit = np.cumsum(edge[:n]) > 0
    text = np.searchsorted(starts, where, side="right") - 1
    pairs, found = np.unique(text * len(count) + window), set()
    per = s.start[1:] - s.start[:-1]
    t, w = pairs // len(count), pairs % len(count)
    found = np.unique(np.stack((np.repeat(t, per[w]), s.at[_spread(s.start[w], per[w]), 1]), axis=1), axis=0)
    matches = []
    for a in range(0, len(where), 1 << 18):  # extend what can't be extended to the left
        win, pos = window[a : a + (1 << 18)], where[a : a + (1 << 18)]
        k = per[win]
        at, p = s.at[_spread(s.start[win], k)], np.repeat(pos, k)
        begin = s.item_start[at[:, 1]] + at[:, 2]
        length = np.repeat(s.length[win], k)
        left = (at[:, 2] == 0) | (p == 0) | (tokens[p - 1] != s.flat[begin - 1])
        at, p, begin, length = at[left], p[left], begin[left], length[left]
        go = np.arange(len(p))
        while len(go):
            q = s.flat[begin[go] + length[go]]
            go = go[(q != 0) & (q == tokens[p[go] + length[go]])]
            length[go] += 1
        doc = np.searchsorted(starts, p, side="right") - 1
        matches.append(np.stack((doc, p - starts[doc], at[:, 1], at[:, 2], length), axis=1))
    return hit, np.concatenate(matches), found


def _shards(texts: list[bytes | None], limit: int) -> Iterator[tuple[int, list[list[bytes]]]]:
    """(index of the first, words of each) of runs of whole texts of about ``limit`` words."""
    first, run, size = 0, [], 0
    for i, t in enumerate(texts):
        words = words_of(t) if t else []
        run.append(words)
        size += len(words) + 1
        if size >= limit:
            yield first, run
            first, run, size = i + 1, [], 0
    if run:
        yield first, run


def _merge(ranges: np.ndarray, n: int) -> list[int]:
    """The covered words as start, end, start, end, ..."""
    return np.flatnonzero(np.diff(np.concatenate(([0], ranges.astype(np.int8), [0])))).tolist()


def _scan(batches: Iterator[pa.RecordBatch], block, window: int, text_at: int, state_at: int | None, out: str,
          shard_words: int, state_name: str = "") -> Iterator[pa.RecordBatch]:
    """One pass over documents. out: 'state' (all columns and what was found so far), 'report', 'clean'."""
    s = Suffixes(block.value, window)
    for batch in batches:
        texts = batch.column(text_at).cast(pa.large_binary()).to_pylist()
        before = batch.column(state_at).to_pylist() if state_at is not None else [None] * len(texts)
        states = []
        for first, run in _shards(texts, shard_words):
            hit, matches, found = search_shard(run, s)
            items: dict[int, list] = {}
            for t, item in found.tolist():
                items.setdefault(t, []).append(s.names[item])
            longest = np.zeros(len(run), np.int64)
            np.maximum.at(longest, matches[:, 0], matches[:, 4])
            at = 0
            for t, words in enumerate(run):
                mask, old = hit[at : at + len(words)], before[first + t]
                at += len(words) + 1
                names = {x for x in items.get(t, []) if x is not None}
                if old:
                    mask = mask.copy()
                    for a, b in zip(old["hit"][::2], old["hit"][1::2]):
                        mask[a:b] = True
                    names |= set(old["items"])
                states.append({"n_words": len(words), "n_hit": int(mask.sum()), "hit": _merge(mask, len(words)) if out == "state" else [],
                               "items": sorted(names), "longest": int(max(longest[t], old["longest"] if old else 0))})
        if out == "state":
            columns = [c for i, c in enumerate(batch.columns) if i != state_at]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(states, _STATE)],
                                             names=[*(x for i, x in enumerate(batch.schema.names) if i != state_at), state_name])
        elif out == "clean":
            keep = batch.filter(pa.array([x["n_hit"] == 0 for x in states], pa.bool_()))
            yield keep.select([i for i in range(batch.num_columns) if i != state_at])
        else:
            digest = [hashlib.sha256(",".join(x["items"]).encode()).hexdigest() for x in states]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([x[k] for x in states], pa.int64()) for k in ("n_words", "n_hit")),
                 pa.array([len(x["items"]) for x in states], pa.int64()), pa.array(digest, pa.string()),
                 pa.array([x["n_hit"] > 0 for x in states], pa.bool_()), pa.array([x["longest"] for x in states], pa.int64())],
                names=["id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "longest_match"])


def _matches(batches: Iterator[pa.RecordBatch], block, window: int, shard_words: int) -> Iterator[pa.RecordBatch]:
    s = Suffixes(block.value, window)
    for batch in batches:
        for first, run in _shards(batch.column(1).cast(pa.large_binary()).to_pylist(), shard_words):
            _, m, _ = search_shard(run, s)
            if len(m):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(m[:, 0] + first)), pa.array(m[:, 1]), pa.array([s.names[i] for i in m[:, 2]], pa.string()),
                     pa.array(m[:, 3]), pa.array(m[:, 4])], names=["id", "doc_word", "item", "item_word", "length"])


_STATE = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("hit", pa.list_(pa.int64())),
                    ("items", pa.list_(pa.string())), ("longest", pa.int64())])
_STATE_SQL = "struct<n_words:bigint,n_hit:bigint,hit:array<bigint>,items:array<string>,longest:bigint>"


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_words: int) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """The items, a block at a time: the driver holds one block and never the whole table."""
    rows = benchmark.select(F.col(named(benchmark.columns, item_col)).cast("string"), F.col(named(benchmark.columns, text_col)).cast("string"))
    block, size = [], 0
    for name, text in rows.toLocalIterator():
        words = words_of((text or "").encode())
        if words:
            block.append((name, words))
            size += len(words)
        if size >= block_words:
            yield block
            block, size = [], 0
    yield block


def _run(docs: DataFrame, benchmark: DataFrame, out: str, schema: str, text_col: str, item_col: str, item_text_col: str, window: int,
         block_words: int, shard_words: int) -> DataFrame:
    """Passes ``docs`` over the blocks of the benchmark; the last pass gives ``out``."""
    spark, state_at = docs.sparkSession, None
    work, df, pending = Work(spark, "decontaminate"), docs, None
    text_at = [c.lower() for c in docs.columns].index(text_col.lower())
    for block in _blocks(benchmark, item_col, item_text_col, block_words):
        if pending is not None:
            (column,) = free_names(docs.columns, "found")
            names = ", ".join(f"{named([], f.name)} {f.dataType.simpleString()}" for f in docs.schema)
            scan = partial(_scan, block=pending, window=window, text_at=text_at, state_at=state_at, out="state", shard_words=shard_words,
                           state_name=column)
            df = work.save(df.mapInArrow(scan, f"{names}, {named([], column)} {_STATE_SQL}"), "found")
            state_at = len(docs.columns)
        pending = spark.sparkContext.broadcast(block)
    return df.mapInArrow(partial(_scan, block=pending, window=window, text_at=text_at, state_at=state_at, out=out,
                                 shard_words=shard_words), schema)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS,
                  shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, n_words, n_hit (words inside an occurrence of a
    window), n_items (items with an occurring window), items_sha256, contaminated, longest_match
    (words of the longest verbatim match that holds a window).

    A window is ``window`` consecutive words of an item; an item of fewer words, but not none, is one
    window. A null or wordless text has no words and is clean; an item without words has no window;
    an item whose id is null hits but isn't counted in n_items. Rows that repeat each keep a row, an
    item id that repeats counts once, an empty benchmark hits nothing, other columns are not read."""
    id_type = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(F.col(named(docs.columns, id_col)).alias("id"), F.col(named(docs.columns, text_col)).cast("string").alias("text"))
    out = _run(narrow, benchmark, "report", f"id {id_type}, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, "
               "contaminated boolean, longest_match bigint", "text", item_col, item_text_col, window, block_words, shard_words)
    return out.withColumnRenamed("id", id_col)


def longest_matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                    item_text_col: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS,
                    shard_words: int = SHARD_WORDS) -> DataFrame:
    """The verbatim matches that hold a window and can't be extended on either side: ``id_col``,
    doc_word and item_word (where they start, from 0), item, length in words."""
    id_type = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(F.col(named(docs.columns, id_col)).alias("id"), F.col(named(docs.columns, text_col)).cast("string").alias("text"))
    out = None
    for block in _blocks(benchmark, item_col, item_text_col, block_words):
        part = narrow.mapInArrow(partial(_matches, block=docs.sparkSession.sparkContext.broadcast(block), window=window, shard_words=shard_words),
                                 f"id {id_type}, doc_word bigint, item string, item_word bigint, length bigint")
        out = part if out is None else out.unionByName(part)
    return out.withColumnRenamed("id", id_col)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                      item_text_col: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS,
                      shard_words: int = SHARD_WORDS) -> DataFrame:
    """The rows of ``docs`` (all columns) that no window of the benchmark occurs in."""
    return _run(docs, benchmark, "clean", docs.schema, text_col, item_col, item_text_col, window, block_words, shard_words)
