"""Connected components of an edge table by alternating large-star and small-star steps.

Each step hangs a node's neighbours on the smallest of them. A step is an aggregate (partial on the
map side) and a join of two written tables, which adaptive execution can split where one node has
very many neighbours. Nothing but an edge count and a checksum reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .work import Work


def _checksum(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)).alias("n"),
                    F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0)).alias("x")).first()
    return row["n"], row["x"]


def _large_star(work: Work, edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    mins = work.save(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "large-min")
    out = work.save(both.filter("v > u").join(mins, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(),
                    "large")
    work.drop(mins)
    return out


def _small_star(work: Work, edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    mins = work.save(down.groupBy("u").agg(F.min("v").alias("m")), "small-min")
    hung = down.join(mins, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    out = work.save(hung.unionByName(mins.select("u", F.col("m").alias("v"))).distinct(), "small")
    work.drop(mins)
    return out


def connected_components(work: Work, edges: DataFrame) -> DataFrame:
    """``edges``: u, v (any order, repeats and loops allowed, no nulls). Returns one row
    (node, root) per node that has an edge to another node, with root the smallest node of its
    component; the root itself has no row. Without edges the result is empty."""
    edges = work.save(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                      .distinct(), "edges")
    before = _checksum(edges)
    while before[0]:
        large = _large_star(work, edges)
        small = _small_star(work, large)
        work.drop(edges, large)
        edges, now = small, _checksum(small)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
