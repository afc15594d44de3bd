"""Connected components over an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitlake.llm.common import stage

MAX_ROUNDS = 60


def _stars(e: DataFrame) -> DataFrame:
    """One large-star and one small-star step on edges ``(u, v)`` with u > v.

    Large star: every larger neighbour of ``u`` moves to the least of ``u`` and
    its neighbours.  Small star: the smaller neighbours of ``u``, and ``u``,
    move to the least of them.  Minima are aggregates with partial sums, and the
    joins back are plain equi joins whose hot keys AQE splits."""
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = (both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
             .filter("u <> v").distinct())
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(least, "u")
    return (small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v"))).distinct())


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (u, v)`` that is not the root
    (least node) of its component.  Every round is written to the shared
    folder.  O(log n) rounds; the loop ends when a round changes nothing."""
    e = (edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
         .filter("u <> v").distinct())
    e = stage(e, "edges")

    def mark(df: DataFrame):
        return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())

    seen = mark(e)
    for _ in range(MAX_ROUNDS):
        if not seen[0]:
            break
        e = stage(_stars(e), "edges")
        now = mark(e)
        if now == seen:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = now
    else:
        raise RuntimeError("components: no fixed point")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
