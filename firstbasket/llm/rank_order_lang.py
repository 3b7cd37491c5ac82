"""Language identification by rank-order profiles.

A language's profile is the ranked list of the most frequent character n-grams (1 to 3 letters of
lower-cased words, word ends marked) of its training texts. A document's own list is compared with
every profile by the out-of-place distance: the sum over its n-grams of how far their ranks lie
apart, with the profile's length for those that it lacks.

Training counts are combined inside each task (their number is bounded by the distinct n-grams, not
by the rows), summed by Spark, and cut to the top of each language there, so the driver and the
broadcast hold ``profile_size`` rows a language. Every text is read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .work import named

PROFILE_SIZE = 300
UNKNOWN = "und"
_NONE, _EDGE = 0, 1  # no character; the end of a word
_CODE = 21  # bits of a code point


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _words(text: str) -> np.ndarray:
    """Code points + 2 of the letters, in lower case, each run of anything else as one word end."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    code = np.where(_letters()[code], code.astype(np.int64) + 2, _EDGE)
    code = np.concatenate(([_EDGE], code, [_EDGE]))
    return code[np.concatenate(([True], (code[1:] != _EDGE) | (code[:-1] != _EDGE)))]


def _grams(code: np.ndarray, bits: int) -> np.ndarray:
    """The 1- to 3-grams of letters and word ends as numbers; none goes over a word end."""
    one = code[code != _EDGE] << 2 * bits
    a, b = code[:-1], code[1:]
    two = (a << 2 * bits | b << bits)
    c = code[2:]
    three = (code[:-2] << 2 * bits | code[1:-1] << bits | c)[code[1:-1] != _EDGE]
    return np.concatenate((one, two, three))


class _Codes:
    """Short codes for the characters of a batch, in the order of their code points."""

    def __init__(self, codes: list[np.ndarray]):
        seen = np.zeros(0x110002, bool)
        for c in codes:
            seen[c] = True
        self.full = np.concatenate(([_NONE, _EDGE], np.flatnonzero(seen[2:]) + 2)).astype(np.int64)
        self.bits = max(2, int(len(self.full) - 1).bit_length())
        self.short = np.zeros(0x110002, np.int64)
        self.short[self.full] = np.arange(len(self.full))

    def count(self, codes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(n-grams in short codes, ascending; how often each)."""
        if 3 * self.bits <= 22 and sum(map(len, codes)) > 1 << 3 * self.bits - 3:
            total = np.zeros(1 << 3 * self.bits, np.int64)
            for c in codes:
                total += np.bincount(_grams(self.short[c], self.bits), minlength=len(total))
            key = np.flatnonzero(total)
            return key, total[key]
        kind = np.int32 if 3 * self.bits < 32 else np.int64
        key = np.sort(np.concatenate([_grams(self.short[c], self.bits).astype(kind) for c in codes]))
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        return key[first].astype(np.int64), np.diff(np.concatenate((first, [len(key)])))

    def lengthen(self, key: np.ndarray) -> np.ndarray:
        mask = (1 << self.bits) - 1
        return (self.full[key >> 2 * self.bits] << 2 * _CODE | self.full[key >> self.bits & mask] << _CODE | self.full[key & mask])


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        by: dict[str, list[np.ndarray]] = {}
        for lang, text in zip(langs, texts):
            code = _words(text)
            if len(code) > 1:
                by.setdefault(lang, []).append(code)
        codes = _Codes([c for x in by.values() for c in x])
        for lang, x in by.items():
            key, n = codes.count(x)
            old, had = total.get(lang, (np.empty(0, np.int64), np.empty(0, np.int64)))
            keys, place = np.unique(np.concatenate((old, codes.lengthen(key))), return_inverse=True)
            sums = np.zeros(len(keys), np.int64)
            np.add.at(sums, place, np.concatenate((had, n)))
            total[lang] = keys, sums
    for lang, (keys, sums) in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(sums)], names=["lang", "gram", "n"])


class Profiles:
    def __init__(self, rows: list[tuple[str, int, int]], size: int):
        """rows: language, n-gram, rank from 0."""
        self.size = size
        self.langs = sorted({r[0] for r in rows})
        self.grams = np.unique(np.array([r[1] for r in rows], np.int64))
        self.rank = np.full((len(self.grams) + 1, len(self.langs)), -1, np.int64)
        of = {x: i for i, x in enumerate(self.langs)}
        for lang, gram, rank in rows:
            self.rank[np.searchsorted(self.grams, gram), of[lang]] = rank

    def best(self, grams: np.ndarray) -> tuple[str, float]:
        """Of n-grams in rank order: the nearest language, and how near (1: the same list)."""
        at = np.searchsorted(self.grams, grams)
        at[at == len(self.grams)] = 0
        at[self.grams[at] != grams] = len(self.grams)
        rank = self.rank[at]
        apart = np.where(rank < 0, self.size, np.abs(rank - np.arange(len(grams))[:, None])).sum(axis=0)
        k = int(apart.argmin())
        return self.langs[k], 1.0 - float(apart[k]) / (self.size * len(grams))


def _predict(batches: Iterator[pa.RecordBatch], profiles, size: int) -> Iterator[pa.RecordBatch]:
    known: Profiles = Profiles(profiles.value, size)
    for batch in batches:
        lang, score = [], []
        texts = batch.column(2).to_pylist()
        for first in range(0, len(texts), 512):
            words = [_words(t) if t else np.empty(0, np.int64) for t in texts[first : first + 512]]
            codes = _Codes(words)
            for w in words:
                if len(w) < 2 or not known.langs:
                    lang.append(UNKNOWN), score.append(0.0)
                    continue
                key, n = codes.count([w])
                if len(key) > size:
                    least = np.partition(n, len(n) - size)[len(n) - size]
                    key, n = key[n >= least], n[n >= least]
                top = codes.lengthen(key[np.argsort(-n, kind="stable")[:size]])
                x, s = known.best(top)
                lang.append(x), score.append(s)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                         names=["id", "held_out", "lang_pred", "score"])


def held_out(id_: Column, folds: int = 5) -> Column:
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % folds == 0, F.lit(False))


def profiles(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", size: int = PROFILE_SIZE) -> DataFrame:
    """(lang, gram, rank): the ``size`` most frequent n-grams of each language over all rows of
    ``docs`` whose text and language aren't null; ties by the n-gram's code."""
    rows = docs.select(F.col(named([], lang_col)).cast("string").alias("lang"), F.col(named([], text_col)).cast("string").alias("text"))
    counts = (rows.filter("lang is not null and text is not null").mapInArrow(_learn, "lang string, gram bigint, n bigint")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    # Spark cuts each task's rows to the limit before they meet when it is set on the row number itself.
    return counts.withColumn("row", F.row_number().over(order)).filter(F.col("row") <= size).select("lang", "gram", (F.col("row") - 1).alias("rank"))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 5,
             size: int = PROFILE_SIZE) -> DataFrame:
    """One row (``id_col``, held_out, lang_pred, score) per row of ``docs``.

    Profiles are learned from the rows that aren't held out (crc32 of the id as text mod ``folds``
    is not 0) and whose language isn't null; a row with a null id is neither held out nor learned
    from. A text that is null or has no letter is ``und`` with score 0, as is every text when nothing
    could be learned. Equal distances go to the language that sorts first. Repeated rows each count
    and keep a row; other columns are not read."""
    id_type = docs.schema[id_col].dataType.simpleString()
    id_, text = F.col(named([], id_col)), F.col(named([], text_col)).cast("string")
    learned = docs.filter(F.crc32(id_.cast("string").cast("binary")) % folds != 0)
    known = [tuple(r) for r in profiles(learned, text_col, lang_col, size).collect()]
    block = docs.sparkSession.sparkContext.broadcast(known)
    out = (docs.select(id_.alias("id"), held_out(id_, folds).alias("held_out"), text.alias("text"))
           .mapInArrow(partial(_predict, profiles=block, size=size), f"id {id_type}, held_out boolean, lang_pred string, score double"))
    return out.withColumnRenamed("id", id_col)
