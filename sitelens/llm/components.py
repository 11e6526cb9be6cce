"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.llm.common import gauge, saved


def _stamp(e: DataFrame) -> dict:
    return gauge(e, F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h"))


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node with a link; root is the smallest node reachable.

    Each round hangs every node's larger neighbours, then its smaller ones,
    below its smallest neighbour, until nothing moves (a logarithmic number of
    rounds).  Every round is a written table; the driver sees a count and a
    checksum.
    """
    e = saved(links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    was = _stamp(e)
    while was["n"]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("x"))
        e = saved(small.select("x.u", "x.v").where("u > v").distinct(), "links")
        now = _stamp(e)
        if now == was:
            break
        was = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
