"""Connected components of a graph that no single machine holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattspan.llm.common import stage


def components(edges: DataFrame, first: str, second: str, label: str) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for all nodes but roots.

    Alternates two star steps. In the first, every node's greater neighbours are linked to
    the least of its neighbourhood; in the second, its lesser ones and itself. All is done
    by minima and joins, so a node with very many neighbours is never gathered. Each round
    is stored; rounds grow with the logarithm of the longest path.
    """
    u, v = F.col(first), F.col(second)
    pairs = edges.where(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
    current = stage(pairs.distinct(), f"{label}-edges")

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003)).first())

    before = mark(current)
    while before[0]:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").where("v <> m")
        large = stage(large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), label)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        )
        current = stage(small.select("e.u", "e.v").where("u <> v").distinct(), label)
        after = mark(current)
        if after == before:
            break
        before = after
    return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
