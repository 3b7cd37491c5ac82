"""Quality classifier from weak labels.

Heuristic labellers vote on every whole text: good, junk, toxic, or no vote. Where a table of human
labels is given, it settles the class of the rows it covers. Expectation-maximisation
(one accuracy a labeller, votes independent given the class) runs on the counts of vote patterns
over all documents: there are few patterns however many documents, so they are all that
reaches the driver. The posterior of a pattern then labels documents, and all of them train a hashed linear
scorer, however many there are: logistic regression on 2**16 hashed word beginnings and whole words, each by the logarithm of its share of the
text's words, and a few shares. The scorer alone, which sees nothing but the text,
decides on every document: it generalises from the labellers' own cues to words that go with them.

A text is counted word by word once, and what the labellers and the scorer want of a word is looked
up in a table of the words met so far: both are sums over a text's different words. Features are kept as
bytes, places as 16-bit and sums as 32-bit numbers.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import partial
from itertools import islice, repeat
from operator import eq
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.dimensions import bounded_broadcast
from .work import Work, named

NONE, GOOD, JUNK, TOXIC = 0, 1, 2, 3
CLASSES = (GOOD, JUNK, TOXIC)
DIM = 1 << 16
DENSE = 16  # the first places hold shares, the others hashed word beginnings
STEMS = (4, 6)  # lengths of the word beginnings, in bytes
SHARE = 100.0  # a word counts log(1 + this much times its share of the text's words)
FIT_TASKS, FIT_ROWS = 8, 10_000  # tasks that share the training rows in each of some hundred evaluations: 8, or one for so many rows
MIN_ROWS = 5  # training rows with a hashed feature, others than a person's by their weight, or it gets no weight
REGULAR = 3e-5
HUMAN_WEIGHT = 20.0  # of a row that a person labelled, in training the scorer
PRIOR_ROWS = 100  # the n other rows are a prior beside those: together they weigh n / (1 + n / this), so at most this
# Common insults, a small lexicon for the toxicity labellers.
INSULTS = frozenset((
    "idiot", "idiots", "moron", "morons", "stupid", "dumb", "loser", "losers", "scum", "trash", "garbage", "worthless", "pathetic",
    "disgusting", "clown", "clowns", "imbecile", "fool", "jerk", "creep", "vermin", "filth", "dimwit", "halfwit", "scumbag",
    "bastard", "asshole", "bitch", "retard", "cretin",
))
_EDGES = ".,;:!?\"'()[]{}<>|*$#%&-_=+~`/\\"
_ODD = frozenset("*$#%&|@^~<>{}\\_+=")
LABEL_BROADCAST_ROWS = 1_000_000  # an id and two numbers each
_KINDS = (str.isalpha, str.isupper, _ODD.__contains__, "!".__eq__, lambda c: c.isalnum() or c in ".,;:?")
_INSULT_AT = {w: i for i, w in enumerate(sorted(INSULTS), 1)}
_MEMO = 1 << 17  # words whose properties a task keeps
_ROWS, _HELD = 256, 1 << 17  # texts that a task holds as Python strings at once; their different words, by text, that are read together


def _place(crc: Iterable[int], n: int) -> np.ndarray:
    return DENSE + np.fromiter(crc, np.int64, n) % (DIM - DENSE)


class _Run(NamedTuple):
    """Some texts, read."""

    shares: list[dict[str, float]]  # what the labellers look at, over each whole text
    text: np.ndarray  # of every different word of each text: the text's number here,
    places: np.ndarray  # the word's places, DIM for none,
    value: np.ndarray  # and what it counts
    weight: np.ndarray | None  # each text's summed weight of its words, where there are coefficients


class _Words:
    """A table of the words met. Of each: letters, upper-case ones, odd characters, exclamation marks, whether
    it has a clean end, its length without edges, the insult it is (a number, or 0), and its places among the
    hashed features. A large table's texts go on bringing new words, so those of some texts are computed at once."""

    def __init__(self, coef: np.ndarray | None = None):
        self.coef = None if coef is None else np.append(coef, 0.0)  # of no place: none
        self.at: dict[str, int] = {}
        self.rows = np.zeros((1 << 12, 7))
        self.places = np.full((1 << 12, len(STEMS) + 1), DIM, np.int32)  # DIM stands for no place
        self.kinds = np.zeros(0x110000, np.uint8)  # of the characters met: a bit for each of _KINDS, and the highest

    def _kinds(self, text: str) -> np.ndarray:
        code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        for c in np.unique(code[self.kinds[code] == 0]).tolist():
            self.kinds[c] = 128 + sum(kind(chr(c)) << i for i, kind in enumerate(_KINDS))
        return self.kinds[code]

    def _add(self, new: list[str]) -> None:
        """The properties of ``new``, the last words in the table. No word holds a line end."""
        first, n = len(self.at) - len(new), len(new)
        while first + n > len(self.rows):
            self.rows = np.concatenate((self.rows, np.zeros_like(self.rows)))
            self.places = np.concatenate((self.places, np.full_like(self.places, DIM)))
        kinds, ends = self._kinds("\n".join(new)), np.cumsum(np.fromiter(map(len, new), np.int64, n) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        cores = [w.strip(_EDGES) for w in "\n".join(new).lower().split("\n")]
        rows, places = self.rows[first : first + n], self.places[first : first + n]
        for i in range(4):
            rows[:, i] = np.add.reduceat(kinds >> i & 1, starts, dtype=np.int64)
        rows[:, 4] = kinds[ends - 1] >> 4 & 1
        rows[:, 5] = np.fromiter(map(len, cores), np.int64, n)
        rows[:, 6] = np.fromiter(map(_INSULT_AT.get, cores, repeat(0)), np.int64, n)
        raw = "\n".join(cores).encode().split(b"\n")
        size = np.fromiter(map(len, raw), np.int64, n)
        for i, (k, over) in enumerate(zip(STEMS, (0, *STEMS))):  # a word no longer than the last beginning has no other
            places[:, i] = np.where(size > over, _place(map(crc32, [x[:k] for x in raw]), n), DIM)
        places[:, -1] = np.where(size > 0, _place(map(crc32, raw, repeat(crc32(b"="))), n), DIM)

    def read(self, texts: Iterable[str]) -> Iterator[_Run]:
        held, new, distinct = [], [], 0
        for text in texts:
            if not held and len(self.at) > _MEMO:
                self.at.clear()
            words = text.split()
            count = Counter(words)
            if some := [w for w in count if w not in self.at]:
                self.at.update(zip(some, range(len(self.at), len(self.at) + len(some))))
                new += some
            held.append((len(text), len(words), sum(map(eq, words, islice(words, 1, None))),
                         np.fromiter(map(self.at.__getitem__, count), np.int64, len(count)), np.fromiter(count.values(), float, len(count))))
            distinct += len(count)
            if len(held) == _ROWS or distinct > _HELD:
                yield self._run(held, new)
                held, new, distinct = [], [], 0
        if held:
            yield self._run(held, new)

    def _run(self, held: list[tuple], new: list[str]) -> _Run:
        if new:
            self._add(new)
        chars, n, adjacent, at, each = zip(*held)
        texts, kinds = len(held), np.array([len(x) for x in at])
        text, at, each = np.repeat(np.arange(texts), kinds), np.concatenate(at), np.concatenate(each)
        met, some = self.rows[at], np.maximum(1, n)
        value = np.log1p((SHARE / some)[text] * each)

        def total(of: np.ndarray) -> np.ndarray:
            return np.bincount(text, weights=each * of, minlength=texts)

        letters, upper, odd, shout, clean, length = (total(met[:, i]) for i in range(6))
        insult = np.flatnonzero(met[:, 6])
        columns = {"n": n, "odd": odd / np.maximum(1, chars), "upper": upper / np.maximum(1, letters), "bare": total(met[:, 5] == 0) / some,
                   "distinct": kinds / some, "adjacent": np.array(adjacent) / some, "shout": shout / some, "clean_ends": clean / some,
                   "length": length / some, "insults": total(met[:, 6] > 0),
                   "insult_kinds": np.bincount(np.unique(np.stack((text[insult], met[insult, 6])), axis=1)[0].astype(np.int64), minlength=texts)}
        shares = [dict(zip(columns, row)) for row in zip(*(np.asarray(x).tolist() for x in columns.values()))]
        places = self.places[at]
        weight = None if self.coef is None else np.bincount(text, weights=value * self.coef[places].sum(axis=1), minlength=texts)
        return _Run(shares, text, places, value, weight)


def shares(text: str) -> dict[str, float]:
    return next(_Words().read([text])).shares[0]


def votes(s: dict[str, float]) -> tuple[int, ...]:
    """The labellers' votes. A labeller that finds nothing gives no vote. Those for good texts look at
    several shares at once, with wider or narrower bounds than those against, so they overlap."""
    long, kind = s["n"] >= 30, s["insults"] == 0

    def junk(found: bool) -> int:
        return JUNK if found else NONE

    return (
        junk(s["odd"] > 0.03),
        junk(s["upper"] > 0.5 and s["n"] >= 4),
        junk(s["bare"] > 0.1),
        junk(s["shout"] > 0.3),
        junk(s["clean_ends"] < 0.6),
        junk(s["adjacent"] > 0.3),
        junk(long and s["distinct"] < 0.2),
        junk(s["length"] < 1 or s["length"] > 25),
        NONE if kind else TOXIC,
        TOXIC if s["insults"] >= 3 and s["insults"] >= s["n"] / 200 else NONE,
        TOXIC if s["insult_kinds"] >= 2 else NONE,
        GOOD if s["n"] and kind and s["odd"] < 0.01 and s["upper"] < 0.25 and s["clean_ends"] > 0.9
        and s["adjacent"] < 0.2 and (not long or s["distinct"] > 0.2) else NONE,
        GOOD if s["n"] and kind and s["bare"] < 0.02 and s["shout"] < 0.05 and s["adjacent"] < 0.05 and s["clean_ends"] > 0.8 else NONE,
        GOOD if s["n"] and s["insults"] <= s["n"] / 500 and s["odd"] < 0.04 and s["upper"] < 0.55 and s["clean_ends"] > 0.7
        and s["bare"] < 0.05 and s["adjacent"] < 0.25 and (not long or s["distinct"] > 0.25) else NONE,
    )


N_LABELLERS = 14  # of votes()


def _dense(s: dict[str, float]) -> list[float]:
    return [10 * min(s["odd"], 0.3), 3 * s["upper"], 10 * min(s["bare"], 0.3), 3 * min(s["shout"], 1.0), 3 * (1 - s["clean_ends"]),
            3 * s["adjacent"], 3 * max(0.0, 0.4 - s["distinct"]) * (s["n"] >= 30), 3.0 * (s["length"] > 25), 1.0 * (s["n"] == 0)]


def _texts(column: pa.Array) -> Iterator[str]:
    for at in range(0, len(column), _ROWS):
        for t in column.slice(at, _ROWS).to_pylist():
            yield t or ""


def _code(s: dict[str, float]) -> int:
    return sum(x << 2 * i for i, x in enumerate(votes(s)))


def _packed(flat: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The rows' numbers as bytes: Spark copies such a value as a whole, and an array number by number."""
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer((ends * flat.itemsize).astype(np.int32)), pa.py_buffer(flat.tobytes())])


def _unpacked(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """All the rows' numbers, and how many each row has."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), kind), np.fromiter(map(len, rows), np.int64, len(rows)) // np.dtype(kind).itemsize


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's vote pattern, with the person's above the labellers', and its features by place: the shares, and
    the sums over its different words."""
    words = _Words()
    for batch in batches:
        at = 0
        for run in words.read(_texts(batch.column(2))):
            part = batch.slice(at, len(run.shares))
            at += part.num_rows
            dense = np.array([_dense(s) for s in run.shares])
            text = np.concatenate((np.repeat(np.arange(len(dense)), dense.shape[1]), np.repeat(run.text, run.places.shape[1])))
            key = text * (DIM + 1) + np.concatenate((np.tile(np.arange(dense.shape[1]), len(dense)), run.places.ravel()))
            flat = np.concatenate((dense.ravel(), np.repeat(run.value, run.places.shape[1])))
            real = (flat != 0) & (key % (DIM + 1) != DIM)
            key, flat = key[real], flat[real]
            order = np.argsort(key, kind="stable")
            key = key[order]
            first = np.flatnonzero(np.diff(key, prepend=-1))
            total = np.add.reduceat(flat[order], first).astype(np.float32) if len(first) else np.zeros(0, np.float32)
            ends = np.searchsorted(key[first], np.arange(part.num_rows + 1) * (DIM + 1))
            pattern = np.array([_code(s) for s in run.shares], np.int64) + (part.column(3).to_numpy(zero_copy_only=False).astype(np.int64) << 2 * N_LABELLERS)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(pattern), _packed((key[first] % (DIM + 1)).astype(np.uint16), ends), _packed(total, ends)],
                names=["id", "h", "pattern", "places", "shares"])


def _rows_of_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many rows of (pattern, places) have each place: those that a person labelled, and others."""
    n = np.zeros((2, DIM), np.int64)
    for batch in batches:
        flat, at = _unpacked(batch.column(1), np.uint16)
        person = np.repeat(batch.column(0).to_numpy() >> 2 * N_LABELLERS > 0, at)
        n += np.bincount(flat + DIM * person, minlength=2 * DIM).reshape(2, DIM)
    place = np.flatnonzero(n.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.int32)), pa.array(n[1, place]), pa.array(n[0, place])], names=["place", "person", "others"])


def _training(batches: Iterator[pa.RecordBatch], often: np.ndarray, reject: dict[int, float], other: float) -> Iterator[pa.RecordBatch]:
    """Rows (label, weight, features): one for each class that the pattern leaves possible."""
    for batch in batches:
        code = batch.column(0).to_pylist()
        p = np.array([reject[c] for c in code])
        w = np.where(np.array(code, np.int64) >> 2 * N_LABELLERS, HUMAN_WEIGHT, other)
        row = np.concatenate((np.flatnonzero(p > 1e-6), np.flatnonzero(1 - p > 1e-6)))
        label = (np.arange(len(row)) < (p > 1e-6).sum()).astype(float)
        flat, at = _unpacked(batch.column(1), np.uint16)
        keep = often[flat]
        of = np.repeat(np.arange(len(at)), at)[keep]
        ends = np.concatenate(([0], np.cumsum(np.bincount(of, minlength=len(at))))).astype(np.int32)
        indices = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat[keep].astype(np.int32))).take(pa.array(row))
        values = pa.ListArray.from_arrays(pa.array(ends), pa.array(_unpacked(batch.column(2), np.float32)[0][keep].astype(float))).take(pa.array(row))
        features = pa.StructArray.from_arrays([pa.array(np.zeros(len(row), np.int8)), pa.array(np.full(len(row), DIM, np.int32)), indices, values],
                                              names=["type", "size", "indices", "values"])  # how Spark lays out a sparse vector
        yield pa.RecordBatch.from_arrays([pa.array(label), pa.array(w[row] * np.where(label > 0, p[row], 1 - p[row])), features], names=["label", "weight", "features"])


def _score_read(batches: Iterator[pa.RecordBatch], model, threshold: float) -> Iterator[pa.RecordBatch]:
    """Scores from the features that the training read."""
    coef, intercept = model.value
    for batch in batches:
        flat, length = _unpacked(batch.column(1), np.uint16)
        z = intercept + np.bincount(np.repeat(np.arange(len(length)), length), weights=coef[flat] * _unpacked(batch.column(2), np.float32)[0], minlength=len(length))
        score = 1 / (1 + np.exp(-np.clip(z, -500.0, 500.0)))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), pa.array(score < threshold)], names=["id", "score", "keep"])


def _score(batches: Iterator[pa.RecordBatch], model, text_at: int, threshold: float) -> Iterator[pa.RecordBatch]:
    coef, intercept = model.value
    words = _Words(coef)
    for batch in batches:
        score = []
        for run in words.read(_texts(batch.column(text_at))):
            for s, weight in zip(run.shares, run.weight.tolist()):
                d = _dense(s)
                z = intercept + weight + float(np.dot(coef[: len(d)], d))
                score.append(1 / (1 + math.exp(-max(-500.0, min(500.0, z)))))
        yield batch.filter(pa.array([s < threshold for s in score], pa.bool_()))


def estimate(patterns: list[tuple[int, int]], labellers: int = N_LABELLERS, rounds: int = 100) -> tuple[np.ndarray, np.ndarray, dict[int, np.ndarray]]:
    """Expectation-maximisation on (pattern, count) rows. A pattern holds a labeller's vote in two
    bits each, and above them a person's, which settles the class. A labeller that votes is right with a chance of its own (its accuracy), whatever the
    class, and otherwise takes either wrong class; no vote says nothing. Returns the classes' shares,
    the accuracies, and each pattern's posterior over ``CLASSES``."""
    code = np.array([p for p, _ in patterns], np.int64)
    n = np.array([c for _, c in patterns], float)
    vote = np.stack([code >> 2 * j & 3 for j in range(labellers)], axis=1)
    right = vote[:, :, None] == np.array(CLASSES)
    cast = (vote != NONE)[:, :, None]
    person = code >> 2 * labellers
    settled = (person[:, None] == np.array(CLASSES)).astype(float)
    accuracy, share = np.full(labellers, 0.8), np.full(len(CLASSES), 1 / len(CLASSES))
    post = np.zeros((len(code), len(CLASSES)))
    for _ in range(rounds):
        a = accuracy[None, :, None]
        log = np.log(share) + np.where(cast, np.where(right, np.log(a), np.log((1 - a) / (len(CLASSES) - 1))), 0).sum(axis=1)
        post = np.exp(log - log.max(axis=1, keepdims=True))
        post = np.where(person[:, None] != NONE, settled, post / post.sum(axis=1, keepdims=True))
        weight = post * n[:, None]
        share = (weight.sum(axis=0) + 1) / (n.sum() + len(CLASSES))
        agree = (right * weight[:, None, :]).sum(axis=(0, 2))
        accuracy = (agree + 4) / ((cast[:, :, 0] * n[:, None]).sum(axis=0) + 5)
    return share, accuracy, {int(p): post[i] for i, p in enumerate(code)}


def train(docs: DataFrame, labels: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
          train_rows: int | None = None) -> tuple[np.ndarray, float]:
    """The scorer's (coefficients, intercept), learned from ``docs``.

    ``labels``: id_col, quality (0: junk), toxic (1: toxic), nulls for no vote; of several rows of an
    id the worst counts. All documents take part in the estimate of the labellers, and all train the
    scorer, however many there are: those that a person labelled by that, with ``HUMAN_WEIGHT``, the others by
    their posterior, as a prior (``PRIOR_ROWS``). Of rows that repeat one takes part. A caller may set a bound of about ``train_rows``
    rows: those that a person labelled come first, and a hash of id and text chooses."""
    work, read = _features_read(docs, labels, id_col, text_col)
    model = _fit(read, train_rows)
    work.drop(read)
    return model


def _features_read(docs: DataFrame, labels: DataFrame | None, id_col: str, text_col: str) -> tuple[Work, DataFrame]:
    """(id, h, pattern, places, shares) of every row of ``docs``, written: its texts are read once."""
    work = Work(docs.sparkSession, "quality")
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(named([], id_col)).alias("id"), F.col(named([], text_col)).cast("string").alias("text"))
    person = F.lit(NONE)
    if labels is not None:
        said = labels.groupBy(F.col(named([], id_col)).alias("said_id")).agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
        person = (F.when(F.col("toxic") == 1, TOXIC).when(F.col("quality") == 0, JUNK)
                  .when(F.coalesce("quality", F.lit(0)) + F.coalesce(1 - F.col("toxic"), F.lit(0)) > 0, GOOD).otherwise(NONE))
        # Broadcast behind a count, so that the texts aren't shuffled for it; more labels meet them in a shuffle.
        rows = rows.join(bounded_broadcast(said, LABEL_BROADCAST_ROWS), F.col("id") == F.col("said_id"), "left")
    rows = rows.select("id", F.xxhash64("id", "text").alias("h"), "text", person.alias("person"))
    return work, work.save(rows.mapInArrow(_read, f"id {id_type}, h bigint, pattern bigint, places binary, shares binary"), "read")


def _fit(read: DataFrame, train_rows: int | None) -> tuple[np.ndarray, float]:
    from pyspark.ml.classification import LogisticRegression

    patterns = [tuple(r) for r in read.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).collect()]
    if not patterns:
        return np.zeros(DIM), 0.0
    _, _, post = estimate(patterns)
    data, n = read, sum(n for _, n in patterns)
    if train_rows is not None:  # the caller's bound
        by_person = sum(n for p, n in patterns if p >> 2 * N_LABELLERS)
        part = [min(1.0, bound / m) if m else 0.0 for bound, m in ((train_rows, by_person), (max(0, train_rows - by_person), n - by_person))]
        below = F.when(F.shiftright("pattern", 2 * N_LABELLERS) > 0, math.ceil(part[0] * (1 << 20))).otherwise(math.ceil(part[1] * (1 << 20)))
        data = read.filter(F.pmod("h", F.lit(1 << 20)) < below)
    if not read.groupBy("id", "h").count().filter("count > 1").isEmpty():
        data = data.dropDuplicates(["id", "h"])
    reject = {p: float(1 - x[0]) for p, x in post.items()}
    used = {r.pattern: r["count"] for r in data.groupBy("pattern").count().collect()}
    others = sum(m for p, m in used.items() if not p >> 2 * N_LABELLERS)
    other = PRIOR_ROWS / (PRIOR_ROWS + others) if others < sum(used.values()) else 1.0
    seen = {1.0 for p in used if reject[p] > 1e-6} | {0.0 for p in used if 1 - reject[p] > 1e-6}
    if len(seen) < 2:
        return np.zeros(DIM), 20.0 if seen == {1.0} else -20.0
    held = data.select("pattern", "places").mapInArrow(_rows_of_places, "place int, person bigint, others bigint").groupBy("place").agg(
        (F.sum("person") + F.sum("others") * other).alias("rows")).filter(F.col("rows") >= MIN_ROWS)
    often = np.zeros(DIM, bool)  # of DIM places at most
    often[:DENSE] = True
    often[[r.place for r in held.select("place").collect()]] = True
    rows = data.select("pattern", "places", "shares").coalesce(max(FIT_TASKS, n // FIT_ROWS)).mapInArrow(partial(_training, often=often, reject=reject, other=other), _train_schema())
    model = LogisticRegression(maxIter=100, tol=1e-9, regParam=REGULAR, standardization=False, weightCol="weight").fit(rows)
    return model.coefficients.toArray(), float(model.intercept)


def _train_schema():
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql.types import DoubleType, StructField, StructType
    return StructType([StructField("label", DoubleType()), StructField("weight", DoubleType()), StructField("features", VectorUDT())])


def classify(docs: DataFrame, labels: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
             train_rows: int | None = None, threshold: float = 0.5) -> DataFrame:
    """One row (``id_col``, score, keep) per row of ``docs``: score is the chance that the text is
    junk or toxic, keep whether it is under ``threshold``.

    A null text is an empty one, which like any other is judged by the scorer. Ids may be null or
    repeat; equal texts score equally; an empty table gives an empty result; other columns of
    ``docs`` are not read."""
    _, read = _features_read(docs, labels, id_col, text_col)
    model = docs.sparkSession.sparkContext.broadcast(_fit(read, train_rows))
    id_type = docs.schema[id_col].dataType.simpleString()
    return (read.select("id", "places", "shares").mapInArrow(partial(_score_read, model=model, threshold=threshold), f"id {id_type}, score double, keep boolean")
            .withColumnRenamed("id", id_col))


def drop_rejected(docs: DataFrame, labels: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
                  train_rows: int | None = None, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` (all columns) that the scorer keeps."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, id_col, text_col, train_rows))
    text_at = [c.lower() for c in docs.columns].index(text_col.lower())
    return docs.mapInArrow(partial(_score, model=model, text_at=text_at, threshold=threshold), docs.schema)
