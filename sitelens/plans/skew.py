"""Skew-safe building blocks.

Any grouping key (a title shared by a third of all pages, one seed word, one
frequent term) may be hot.  Aggregates are safe by themselves (partial
aggregation before the shuffle); what is not safe is sending every row of a
hot key to one task, as a window partitioned by that key or a plain join on it
would.  ``join_group_stat`` aggregates per key and joins the result back on a
salted key: only the hot keys are salted, each over as many tasks as its size
needs, and only their per-key rows are replicated.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_TASK = 1_000_000   # a hot key gets one salt per this many rows
MAX_HOT_KEYS = 10_000       # bound on the broadcast hot-key table


def salt_of(c: Column, salts) -> Column:
    n = salts if isinstance(salts, Column) else F.lit(salts)
    return F.pmod(F.xxhash64(c), n.cast("long")).cast("int")


def hot_keys(big: DataFrame, keys: list[str], rows_per_task: int = ROWS_PER_TASK,
             counts: DataFrame | None = None) -> DataFrame:
    """(keys..., _salts) for the keys of ``big`` with more rows than
    ``max(rows_per_task, total / MAX_HOT_KEYS)``: at most ``MAX_HOT_KEYS``
    rows, each with ``ceil(rows / threshold)`` salts.  ``counts`` may give
    precomputed per-key counts in a ``_rows`` column."""
    if counts is None:
        counts = big.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    total = counts.agg(F.sum("_rows")).first()[0] or 0
    threshold = max(rows_per_task, math.ceil(total / MAX_HOT_KEYS))
    return counts.filter(F.col("_rows") > threshold).select(
        *keys, F.ceil(F.col("_rows") / F.lit(threshold)).cast("int").alias("_salts"))


def skew_join(big: DataFrame, small: DataFrame, keys: list[str], spread_by: str,
              rows_per_task: int = ROWS_PER_TASK, hot: DataFrame | None = None) -> DataFrame:
    """Inner equi-join of ``big`` and ``small`` on non-null ``keys`` that
    stays balanced when a key is hot: a hot key's ``big`` rows are spread
    over its salts (hash of ``spread_by``) and its ``small`` rows are
    replicated once per salt; every other key joins unsalted.  The hot-key
    table is broadcast; its size is bounded by ``MAX_HOT_KEYS``."""
    hot = F.broadcast(hot if hot is not None else hot_keys(big, keys, rows_per_task))
    b = (big.join(hot, keys, "left")
         .withColumn("_salt", F.when(F.col("_salts").isNull(), F.lit(0))
                     .otherwise(salt_of(F.col(f"`{spread_by}`"), F.col("_salts"))))
         .drop("_salts"))
    s = (small.join(hot, keys, "left")
         .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)))
         .drop("_salts"))
    return b.join(s, keys + ["_salt"]).drop("_salt")


def join_group_stat(df: DataFrame, keys: list[str], stats: list[Column],
                    spread_by: str, rows_per_task: int = ROWS_PER_TASK,
                    materialize: bool = False) -> DataFrame:
    """Attach per-group aggregates ``stats`` (grouped by ``keys``) to every row.

    Null keys group together, like a window partition.  The per-key
    aggregates (with each key's row count, partial aggregation) are
    checkpointed and joined back with ``skew_join``: hot keys are salted over
    as many tasks as their size needs, all other keys join unsalted.

    ``materialize``: also write the input once with ``checkpoint()`` when it
    is expensive to recompute (a Python stage upstream); it is read twice.
    """
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    surrogate = []
    for i, k in enumerate(keys):
        c = F.col(f"`{k}`")
        surrogate += [c.isNull().alias(f"_n{i}"), F.coalesce(c.cast("string"), F.lit("")).alias(f"_v{i}")]
    gk = [f"_{p}{i}" for i in range(len(keys)) for p in ("n", "v")]
    base = df.select("*", *surrogate)
    if materialize:
        base = base.checkpoint()
    per_key = base.groupBy(*gk).agg(*stats, F.count(F.lit(1)).alias("_rows")).checkpoint()
    hot = hot_keys(base, gk, rows_per_task, counts=per_key)
    return skew_join(base, per_key.drop("_rows"), gk, spread_by, hot=hot).drop(*gk)


def spread_join(big: DataFrame, small: DataFrame, keys: list[str], by: str, how: str = "inner", salts: int | None = None, slim: DataFrame | None = None) -> DataFrame:
    """big joined with small (one row per key), however many rows of big share a key.

    A key's rows of big are dealt over salts by a hash of column ``by``; small
    gets one row for every (key, salt) that big has, found by a partial
    aggregation, so a key with few rows costs no more than in a plain join.
    Null keys match nothing.  Rows of big are not sorted.  ``slim`` has the keys
    and ``by`` of every row of big, where those are cheaper to read alone.
    """
    salts = salts or 4 * int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = F.pmod(F.xxhash64(by), F.lit(salts)).cast("int")
    used = (big if slim is None else slim).select(*keys, salt.alias("_salt")).distinct()
    near = used.join(small, keys)
    return big.withColumn("_salt", salt).join(near.hint("shuffle_hash"), [*keys, "_salt"], how).drop("_salt")
