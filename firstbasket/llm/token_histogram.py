"""Token counts as an exact histogram of encoded lengths.

Every whole text is encoded with a public tokenizer (its file's path is a parameter; the file's bytes
reach the executors by broadcast, about a megabyte) and documents are counted by length. Sums over
that histogram answer totals, quantiles and truncated totals for every context limit. They are sums
from a length to the end, made in two levels, blocks of lengths and lengths in a block, so no window
holds more than ``BLOCK`` lengths or the blocks.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .work import Work, named

BLOCK = 1024
#: The pre-tokenizer that goes with the byte-level ranks (fixed value).
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A long run of what the pattern takes for white space. Its engine keeps a step for each character of
#: such a run, and a million of them end the process.
LONG_RUN = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{4096,}")
_ENCODINGS: dict = {}


def _encoding(ranks: bytes):
    import tiktoken
    key = hash(ranks)
    if key not in _ENCODINGS:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines()) if a}
        _ENCODINGS[key] = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
    return _ENCODINGS[key]


def count_tokens(encoding, text: str) -> int:
    """The exact number of tokens. A long run of white space is encoded as the one piece that the
    pattern makes of it: all of it at the end of the text, else all but its last character, which
    the pattern looks at together with what follows."""
    n, at = 0, 0
    for run in LONG_RUN.finditer(text):
        stop = run.end() if run.end() == len(text) else run.end() - 1
        n += len(encoding.encode_ordinary(text[at : run.start()])) + len(encoding._encode_single_piece(text[run.start() : stop]))
        at = stop
    return n + len(encoding.encode_ordinary(text[at:]))


def _lengths(batches: Iterator[pa.RecordBatch], ranks) -> Iterator[pa.RecordBatch]:
    encoding = _encoding(ranks.value)
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([count_tokens(encoding, t) if t else 0 for t in batch.column(1).to_pylist()], pa.int64())],
                                         names=["id", "n_tokens"])


def token_counts(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (``id_col``, n_tokens) per row of ``docs``; a null or empty text has 0 tokens. Strings that
    look like special tokens are ordinary text. The ranks file is read on the driver."""
    with open(ranks_path, "rb") as f:
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(named([], id_col)).alias("id"), F.col(named([], text_col)).cast("string").alias("text"))
    return rows.mapInArrow(partial(_lengths, ranks=ranks), f"id {id_type}, n_tokens bigint").withColumnRenamed("id", id_col)


def length_histogram(counts: DataFrame, tokens_col: str = "n_tokens") -> DataFrame:
    """One row per length that occurs: n_tokens, docs, and, over all documents, docs_ge and tokens_ge
    (those of that length or more), tokens_truncated (all tokens if texts are cut at this length) and
    share_le (share of documents of that length or less: length is the quantile of every share in
    (share_le of the length before, share_le]).

    For a context limit L that is no length, the row of the next length h > L answers: docs_ge is the
    same and tokens_truncated(L) = tokens_truncated(h) - (h - L) * docs_ge. Null lengths don't count."""
    spark = counts.sparkSession
    work = Work(spark, "lengths")
    hist = work.save(counts.filter(F.col(named([], tokens_col)).isNotNull()).groupBy(F.col(named([], tokens_col)).cast("long").alias("n_tokens"))
                     .agg(F.count(F.lit(1)).alias("docs")).withColumn("block", F.floor(F.col("n_tokens") / BLOCK)), "histogram")
    tokens = F.col("n_tokens") * F.col("docs")
    blocks = hist.groupBy("block").agg(F.sum("docs").alias("d"), F.sum(tokens).alias("t"))
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0).cast("long")
    blocks = blocks.select("block", F.coalesce(F.sum("d").over(later), zero).alias("d_later"), F.coalesce(F.sum("t").over(later), zero).alias("t_later"),
                           F.sum("d").over(every).alias("d_all"), F.sum("t").over(every).alias("t_all"))
    here = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    out = (hist.withColumns({"d_here": F.sum("docs").over(here), "t_here": F.sum(tokens).over(here)}).join(blocks, "block")
           .withColumns({"docs_ge": F.col("d_here") + F.col("d_later"), "tokens_ge": F.col("t_here") + F.col("t_later")}))
    return out.select("n_tokens", "docs", "docs_ge", "tokens_ge",
                      (F.col("t_all") - F.col("tokens_ge") + F.col("n_tokens") * F.col("docs_ge")).alias("tokens_truncated"),
                      ((F.col("d_all") - F.col("docs_ge") + F.col("docs")) / F.col("d_all")).alias("share_le"))
