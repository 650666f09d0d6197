"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.functions.staging import stage


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(u, v)``; the root is the smallest node reachable.

    Alternates two star operations (link larger neighbours to the smallest neighbour, then
    smaller ones to the smallest) until the edges stay as they are: about log(n) rounds, each
    written to the shared folder so that a lost executor costs a task. Neighbourhoods are only
    ever reduced to a minimum, so a node with many edges is no large group.
    """
    now = stage(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                .filter("u <> v").distinct())
    mark = _mark(now)
    while True:
        now = stage(_small_star(_large_star(now)))
        before, mark = mark, _mark(now)
        if mark == before:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _mark(edges: DataFrame):
    return edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")),
                     F.bit_xor(F.xxhash64("v", "u"))).first()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.join(least, "u").filter("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()
