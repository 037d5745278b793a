"""Connected components of an edge table, by joins and sums only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import written

#: Tasks that share the edges of one node.
SALTS = 16


def _with_least(edges: DataFrame, least: DataFrame, key: str) -> DataFrame:
    """Edges with the least neighbour of one of their ends. Least neighbours are summed per task before they are
    shuffled, and each is there once per salt, so that a node with very many edges is no single task's work. They are
    joined by sorting: Spark does not count the salts into their size, and would broadcast tables of many times its limit.
    """
    salts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint")))
    copies = least.select(F.col("u").alias(key), "m", salts.alias("salt")).hint("merge")
    return edges.withColumn("salt", F.pmod(F.xxhash64("u", "v"), F.lit(SALTS))).join(copies, [key, "salt"]).drop("salt")


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for all nodes that have an edge to another node.

    Rounds of a large-star step (each greater neighbour of a node goes to the node's least neighbour) and a small-star
    step (the lesser neighbours go there) make every component a star around its least node; the depth about halves
    with each round, and there are never more edges than before. A round is a written table, so a lost executor repeats
    one round at most.
    """
    links = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    links = written(links, "links")
    state = None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = _with_least(links, least, "v").select("u", F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _with_least(large, least, "u")
        small = small.select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
        links = written(small.select(F.col("e.u").alias("u"), F.col("e.m").alias("v")).where("u != v").distinct(), "links")
        before, state = state, links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
