"""Connected components of a table of links, by alternating star contractions.

Each round links every node's larger neighbours to the smallest node near them, then the smaller ones. Rounds
are a grouping and a join on nodes, both combined before they are shuffled, and each is checkpointed. The
driver sees one row a round, a digest of the links that tells when they no longer change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavemill.llm.shared import cut


def roots(links: DataFrame) -> DataFrame:
    """(``node``, ``root``) of every node in links ``a`` - ``b``: the smallest node that it reaches."""
    edges = cut(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                .where("u <> v").distinct())
    before = None
    while (now := _digest(edges)) != before:
        before = now
        edges = cut(_small_star(_large_star(edges)))
    inner = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return inner.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
                           F.bit_xor(F.xxhash64("v", "u"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
