"""Bloom filters: drop rows whose key a list surely lacks, where the rows lie.

A plain semi-join shuffles both sides once the list is too large to broadcast,
with everything a row carries (page bytes).  ``maybe_listed`` broadcasts a
filter of bounded size instead and tests it in the scan's stage, so rows leave it
only by passing; the few that pass wrongly are for an exact join on short rows
further down.

The filter is made of blocks of 64 words: a key's hash picks one block, and five
bits in it.  Blocks are built by one aggregation (``bit_or`` of partial words)
and joined to the rows by their number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 64          # words of 64 bits in a block
PROBES = 5
BITS_PER_KEY = 16   # about 3 in 1,000 rows pass wrongly
MAX_BYTES = 32 << 20


def _place(key: Column, i: int) -> Column:
    """Bit of the block that probe i tests: 12 bits of a second hash."""
    return F.shiftrightunsigned(F.xxhash64(key, F.lit("place")), 12 * i).bitwiseAND(F.lit(WORDS * 64 - 1)).cast("int")


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def block_count(keys: int, max_bytes: int = MAX_BYTES) -> int:
    """Blocks for so many keys, never more than max_bytes of them."""
    return max(1, min(max_bytes // (WORDS * 8), -(-keys * BITS_PER_KEY // (WORDS * 64))))


def filter_blocks(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """(_block, _words): the filter of the keys, without empty blocks."""
    k = F.col(f"`{key}`")
    places = F.array(*[_place(k, i) for i in range(PROBES)])
    word = F.floor(F.col("_p") / 64).cast("int")
    words = (keys.where(k.isNotNull()).select(_block(k, blocks).alias("_block"), F.explode(places).alias("_p"))
             .select("_block", word.alias("_w"), F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_p") % 64).alias("_bit"))
             .groupBy("_block", "_w").agg(F.bit_or("_bit").alias("_bits")))
    by_word = F.map_from_entries(F.collect_list(F.struct("_w", "_bits")))
    return (words.groupBy("_block").agg(by_word.alias("_m"))
            .select("_block", F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), lambda i: F.coalesce(F.col("_m")[i], F.lit(0).cast("long"))).alias("_words")))


def with_maybe(df: DataFrame, key: str, keys: DataFrame, name: str, list_key: str | None = None, max_bytes: int = MAX_BYTES) -> DataFrame:
    """``df`` with boolean ``name``: false only where ``key`` is surely not among ``keys``.

    ``keys`` is read twice (counted, then put into the filter).  A list that is
    too long for ``max_bytes`` leaves more rows unsure.  A null key is not listed.
    """
    blocks = block_count(keys.count(), max_bytes)
    k = F.col(f"`{key}`")
    hit = k.isNotNull()
    for i in range(PROBES):
        word = F.get("_words", F.floor(_place(k, i) / 64).cast("int"))
        hit = hit & (F.call_function("shiftright", word, _place(k, i) % 64).bitwiseAND(F.lit(1).cast("long")) == 1)
    table = F.broadcast(filter_blocks(keys, list_key or key, blocks))     # at most max_bytes
    return (df.withColumn("_block", _block(k, blocks)).join(table, "_block", "left")
            .select(*[F.col(f"`{c}`") for c in df.columns if c != name], F.coalesce(hit, F.lit(False)).alias(name)))


def maybe_listed(df: DataFrame, key: str, keys: DataFrame, list_key: str | None = None, max_bytes: int = MAX_BYTES) -> DataFrame:
    """Rows of ``df`` whose ``key`` may be among ``keys``: all that are, and a few that are not.  Null keys go."""
    return with_maybe(df, key, keys, "_listed", list_key, max_bytes).where("_listed").drop("_listed")
