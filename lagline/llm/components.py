"""Connected components of a table of links, by star contraction.

Every round hangs each node on its smallest neighbour, first the larger neighbours, then the
smaller ones, until all links are stars around the smallest node of their component. The rounds
grow with the logarithm of the longest chain. Rounds are written to the shared folder; nothing
but two numbers per round comes to the driver. Minima are taken by pre-aggregated groups, and
the links of a node with very many neighbours stay spread over join partitions that adaptive
execution may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagline.llm.common import settled


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """node and root (its component's smallest node) for every node of a link.

    Links may repeat, point either way or to the node itself; null ends are no links. Nodes are
    of any ordered type.
    """
    a, b = F.col(left), F.col(right)
    pairs = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    pairs = pairs.where(a.isNotNull() & b.isNotNull() & (F.col("u") != F.col("v"))).distinct()
    now = settled(pairs)
    before = None
    while True:
        state = _state(now)
        if state[0] == 0 or state == before:
            break
        before = state
        now = settled(_small_star(_large_star(now)))
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(now.select("v", "v")).distinct()


def _state(pairs: DataFrame) -> tuple:
    row = pairs.agg(
        F.count("*"),
        F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0)),
        F.coalesce(F.bit_xor(F.hash("u", "v")), F.lit(0)),
    ).first()
    return tuple(row)


def _large_star(pairs: DataFrame) -> DataFrame:
    both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    hung = both.where("v > u").join(least, "u")
    return hung.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    hung = pairs.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m"))
    return hung.union(least).toDF("u", "v").distinct()
