"""SimHash near-duplicates by anchor-point covering.

A document's 64-bit fingerprint has bit b set if more than half of its shingle hashes have it set.
Two fingerprints link at ``max_bits`` (4) or fewer differing bits.

Covering. The 64 bits are two halves; of 4 differing bits at most 1 lies in the low half or at most
2 in the high half. Each half has as anchors a perfect code: the words of the binary Hamming code of
length 31 (covering radius 1), with the 32nd bit free. Every fingerprint is *at home* at the one
anchor within the radius, and is replicated to every anchor within radius + threshold of the half
(17 anchors in the low half, 172 in the high one). Whatever links to a fingerprint in a half is
therefore replicated to its home anchor there, so comparing replicas with the homes of each anchor
loses no link.

Volume. Equal fingerprints are one row before anything is replicated, so a group of exact copies of
any size costs one fingerprint. Rows are dealt by anchor and sorted, homes first; a task streams over
them in Arrow batches and holds the homes of one anchor. An anchor gives a spanning forest of its
links (at most one edge per row), not all pairs, and the edges go to connected components.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .work import Work, free_names, named, null_safe, partitions

RADIUS = 1
CODE_BITS = 31  # length of the Hamming code; the 32nd bit of a half is free
LOW_BITS_THRESHOLD = 1
BLOCK = 1 << 16  # shingles whose bits are counted at once
CELLS = 1 << 21  # cells of a distance table at once


def fingerprint(text: bytes, words_per_shingle: int = 4, seed: int = 42) -> int:
    """SimHash of a UTF-8 text: A-Z lower-cased, words parted by white space (space, 09-0D)."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= words_per_shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    joined, k = b" ".join(words), words_per_shingle
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - k + 1].tolist()
    stops, digest = ends[k - 1 :].tolist(), xxhash.xxh64_intdigest
    n, ones = len(starts), np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        h = np.array([digest(joined[a:b], seed) for a, b in zip(starts[at : at + BLOCK], stops[at : at + BLOCK])], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], words: int, seed: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).cast(pa.large_binary()).to_pylist()
        fps = np.fromiter((fingerprint(t or b"", words, seed) for t in texts), np.uint64, len(texts))
        keys = np.fromiter((xxhash.xxh64_intdigest(t, 42) if t is not None else 42 for t in texts), np.uint64, len(texts))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys.view(np.int64)), pa.array(fps.view(np.int64))],
                                         names=["id", "text_key", "fp"])


@cache
def _offsets(weight: int) -> np.ndarray:
    """[syndrome, k]: the words of at most ``weight`` bits to xor to a word of that syndrome to reach
    the code. Each syndrome has equally many from weight 2 on; -1 pads the others."""
    rows: list[list[int]] = [[] for _ in range(CODE_BITS + 1)]
    for w in range(weight + 1):
        for at in combinations(range(CODE_BITS), w):
            s = 0
            for b in at:
                s ^= b + 1
            rows[s].append(sum(1 << b for b in at))
    out = np.full((CODE_BITS + 1, max(map(len, rows))), -1, np.int64)
    for s, r in enumerate(rows):
        out[s, : len(r)] = r
    return out


_PARITY = [sum(1 << b for b in range(CODE_BITS) if (b + 1) >> j & 1) for j in range(5)]


def anchors(half: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Of words of 32 bits (int64): the home anchor of each, and the anchors within
    ``RADIUS + threshold`` of each as a table with -1 where there is none."""
    code, free = half & ((1 << CODE_BITS) - 1), half >> CODE_BITS
    syndrome = sum((np.bitwise_count(code & m).astype(np.int64) & 1) << j for j, m in enumerate(_PARITY))
    home = np.where(syndrome > 0, code ^ (1 << np.maximum(syndrome - 1, 0)), code) | free << CODE_BITS
    near = []
    for flip in (0, 1):
        off = _offsets(RADIUS + threshold - flip)[syndrome]
        near.append(np.where(off < 0, -1, (code[:, None] ^ off) | (free ^ flip)[:, None] << CODE_BITS))
    return home, np.concatenate(near, axis=1)


def _replicas(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            fp = batch.column(0).slice(at, 4096).to_numpy(zero_copy_only=False)
            bits = fp.view(np.uint64)
            for block, threshold in ((0, LOW_BITS_THRESHOLD), (1, max_bits - LOW_BITS_THRESHOLD - 1)):
                home, near = anchors((bits >> np.uint64(32 * block) & np.uint64(0xFFFFFFFF)).astype(np.int64), threshold)
                rows, cols = np.nonzero(near >= 0)
                key = np.concatenate((home, near[rows, cols])) | block << 32
                away = np.concatenate((np.zeros(len(fp), bool), np.ones(len(rows), bool)))
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(away), pa.array(np.concatenate((fp, fp[rows])))],
                                                 names=["anchor", "away", "fp"])


class _Anchor:
    """The homes of one anchor and which of them are linked so far."""

    def __init__(self, key: int, homes: np.ndarray, max_bits: int):
        self.key, self.homes, self.max_bits = key, homes, max_bits
        self.root = np.arange(len(homes))

    def link(self, fps: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Edges that connect all of ``fps`` to the homes they are near to, without all the pairs."""
        if not len(self.homes):
            return
        step = max(1, CELLS // len(self.homes))
        for at in range(0, len(fps), step):
            part = fps[at : at + step]
            near = np.bitwise_count((part[:, None] ^ self.homes[None, :]).view(np.uint64)) <= self.max_bits
            first = near.argmax(axis=1)
            hit = near[np.arange(len(part)), first]
            yield part[hit], self.homes[first[hit]]
            row, other = np.nonzero(near)
            one = first[row]
            while True:
                a, b = self.root[one], self.root[other]
                open_ = a != b
                if not open_.any():
                    break
                one, other, hi, lo = one[open_], other[open_], np.maximum(a, b)[open_], np.minimum(a, b)[open_]
                hung = self.root.copy()
                np.minimum.at(hung, hi, lo)
                moved = np.unique(hi)
                yield self.homes[moved], self.homes[hung[moved]]
                while not np.array_equal(hung, hung[hung]):
                    hung = hung[hung]
                self.root = hung


def _links(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by anchor, homes before replicas."""
    anchor = _Anchor(-1, np.empty(0, np.int64), max_bits)
    for batch in batches:
        key, away, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        if not len(key):
            continue
        edges: list[tuple[np.ndarray, np.ndarray]] = []
        cut = np.flatnonzero(np.diff(key)) + 1
        starts, stops = np.concatenate(([0], cut)), np.concatenate((cut, [len(key)]))
        homes = np.add.reduceat(~away, starts)
        lone = (homes == 1) & (stops - starts > 2)
        lone[[0, -1]] = False  # the first and last anchor may go on in other batches
        if lone.any():  # anchors with one home: all at once
            size = (stops - starts)[lone]
            of = np.repeat(fp[starts[lone]], size)
            rows = np.repeat(starts[lone] - np.cumsum(size) + size, size) + np.arange(size.sum())
            near = np.bitwise_count((fp[rows] ^ of).view(np.uint64)) <= max_bits
            edges.append((fp[rows][near], of[near]))
        rest = homes > 1
        rest[[0, -1]] = True
        for a, b, h in zip(starts[rest].tolist(), stops[rest].tolist(), homes[rest].tolist()):
            if anchor.key != key[a]:
                anchor = _Anchor(int(key[a]), fp[a : a + h], max_bits)
            elif h:
                anchor = _Anchor(anchor.key, np.concatenate((anchor.homes, fp[a : a + h])), max_bits)
            edges += anchor.link(fp[a + h : b])
        if edges:
            u, v = (np.concatenate(x) for x in zip(*edges))
            u, v = u[u != v], v[u != v]
            if len(u):
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def _tables(work: Work, docs: DataFrame, id_col: str, text_col: str, words: int, max_bits: int,
            seed: int) -> tuple[DataFrame, DataFrame]:
    """(rows: id, text_key, fp), (groups: fp, component_id, least text_key of the component's first id)."""
    if not 2 <= max_bits <= 4:
        raise ValueError("the covering of two halves is laid out for 2 to 4 differing bits")
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = work.save(
        docs.select(F.col(named(docs.columns, id_col)).alias("id"), F.col(named(docs.columns, text_col)).cast("string").alias("text"))
        .mapInArrow(partial(_fingerprints, words=words, seed=seed), f"id {id_type}, text_key bigint, fp bigint"), "fingerprints")
    groups = work.save(rows.groupBy("fp").agg(F.min("id").alias("first_id")), "groups")
    n = partitions(work.spark)
    dealt = (groups.select("fp").repartition(n).mapInArrow(partial(_replicas, max_bits=max_bits), "anchor bigint, away boolean, fp bigint")
             .repartition(n, "anchor").sortWithinPartitions("anchor", "away"))
    roots = connected_components(work, dealt.mapInArrow(partial(_links, max_bits=max_bits), "u bigint, v bigint"))
    rooted = work.save(groups.join(roots, F.col("fp") == F.col("node"), "left")
                       .select("fp", "first_id", F.coalesce("root", "fp").alias("root")), "rooted")
    least = work.save(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "least")
    return rows, work.save(rooted.join(least, "root").select("fp", "component_id", "root"), "components")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, max_bits: int = 4,
                    seed: int = 42) -> DataFrame:
    """One row (``id_col``, fingerprint, component_id) per row of ``docs``.

    component_id is the smallest id that links reach, the row's own included. A null or wordless
    text has fingerprint zero and links like any other; a text of fewer words than a shingle is one
    shingle. Rows with a null id keep a row and take the least id that is not null in their component
    (null if there is none). Repeated rows each keep a row; an empty table gives an empty result;
    columns besides the two are not read."""
    work = Work(docs.sparkSession, "simhash")
    rows, groups = _tables(work, docs, id_col, text_col, words, max_bits, seed)
    return rows.join(groups, "fp").select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                          "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4,
                         max_bits: int = 4, seed: int = 42) -> DataFrame:
    """The rows of ``docs``, all columns, of which one stays for each component: the one with the
    least id (null last), ties by the text's hash, and one of rows that repeat in both."""
    work = Work(docs.sparkSession, "simhash")
    rows, groups = _tables(work, docs, id_col, text_col, words, max_bits, seed)
    placed = rows.join(groups, "fp").select("root", F.struct(F.col("id").isNull().alias("last"), "id", "text_key").alias("row"))
    kept = work.save(placed.groupBy("root").agg(F.min("row").alias("row")).select("row.id", "row.text_key"), "kept")
    again = work.save(rows.join(kept, null_safe([rows.id, rows.text_key], [kept.id, kept.text_key]), "left_semi")
                      .groupBy("id", "text_key").count().filter("count > 1").select("id", "text_key"), "again")
    a, b = free_names(docs.columns, "kept_id", "kept_key")
    keyed = docs.withColumns({a: F.col(named(docs.columns, id_col)), b: F.xxhash64(F.col(named(docs.columns, text_col)).cast("string"))})
    on = null_safe([keyed[a], keyed[b]], [F.col("k.id"), F.col("k.text_key")])
    out = keyed.join(kept.alias("k"), on, "left_semi")
    if not again.isEmpty():
        once = out.join(again.alias("k"), on, "left_anti")
        out = once.unionByName(out.join(again.alias("k"), on, "left_semi").dropDuplicates([a, b]))
    return out.select(*[named(docs.columns, c) for c in docs.columns])
