"""Positions and running totals in a global order, with no task that sees all rows.

A window without a partition key would bring every row to one task.  Here rows
are dealt out in ranges of the order, each range is summed, the sums are added
up over the ranges (one row a range), and every row adds what lies before it in
its own range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def running_total(df: DataFrame, order: list[str | Column], value: Column, name: str,
                  spread_ties: bool = False) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` over all rows before it in ``order`` (0 for the first).

    The order should be total.  ``spread_ties`` appends a row number to it, so
    that many equal rows do not fall into one range; which of them comes first
    is then open.  The dealt-out rows are checkpointed; the broadcast table
    has one row a range.
    """
    ensure_checkpoint_dir(df.sparkSession)
    cols = list(df.columns)
    by = [F.col(f"`{o}`") if isinstance(o, str) else o for o in order]
    named = df.select("*", value.alias("_v"))
    if spread_ties:
        named = named.withColumn("_tie", F.monotonically_increasing_id())
        by.append(F.col("_tie"))
    dealt = named.repartitionByRange(*by).withColumn("_range", F.spark_partition_id()).checkpoint()
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy("_range").agg(F.sum("_v").alias("_s"))
    offsets = sums.select("_range", F.coalesce(F.sum("_s").over(before.orderBy("_range")), F.lit(0)).alias("_before"))
    own = F.coalesce(F.sum("_v").over(before.partitionBy("_range").orderBy(*by)), F.lit(0))
    return (dealt.join(F.broadcast(offsets), "_range")
            .select(*[F.col(f"`{c}`") for c in cols], (F.col("_before") + own).alias(name)))


def with_position(df: DataFrame, order: list[str | Column], name: str = "position",
                  spread_ties: bool = True) -> DataFrame:
    """``df`` with its 0-based place in ``order`` (gapless; equal rows get different places)."""
    return running_total(df, order, F.lit(1).cast("long"), name, spread_ties)
