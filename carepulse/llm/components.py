"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carepulse.llm.common import pinned


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v").cast("decimal(38,0)"))).head())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): each node that has a link, with the smallest node reachable from it.

    Every step joins each node with the minimum of its neighbours (pre-aggregated), so a node with very many
    links is one row per task before the shuffle and a split join after it. The number of steps grows with the
    logarithm of the longest chain. Null and self links are left out; no links give an empty result.
    """
    edges = pinned(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).dropna().where("u <> v").distinct())
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        edges = pinned(small)
        before, state = state, _state(edges)
        if state == before:
            break
    heads = edges.select(F.col("v").alias("node")).distinct()
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(heads.select("node", F.col("node").alias("component"))))
