"""Merkle manifest of a dataset: one tree per group, one over the groups' roots.

``manifest`` gives every row its leaf, its group's root, the root of all, a digest of its
proof and the root folded from a (possibly tampered) leaf along that proof.

Method: a leaf's place in its group is a rank query on a bitmap of the group's ids.
Ids set bits in words of 64, words without a bit are not kept (that is the compression),
and partial words merge by ``bit_or``.  The directory holds the
number of rows before each word: word counts are added up inside chunks of
``CHUNK`` words, chunk counts over all chunks by ranges.  A leaf's place is the
directory's number plus the bits below its own: no row is sorted.
Nodes are then reduced by places: every ``RADIX`` consecutive nodes become
one, three levels at a time, in arrays of up to ``BLOCK`` slots keyed by
(group, place div BLOCK); a group with a third of all rows is just more keys.  Proofs go
down again the same way: a block hands each of its slots the siblings above it.

Built-in functions only; one row of sizes is read by the driver.

Defined results: a null id comes before all others (with the smallest long); rows that repeat an id are leaves of their own, ordered by
leaf; equal leaves are interchangeable; a null group is a group, first in
order; a group of one row has its leaf as root, and one group its root as
that of all; null fields count as ``-``; no rows, no result; columns of other
names do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from sitelens.llm.common import gauge, saved, spread_join
from sitelens.plans.ranking import running_total, with_position

RADIX = 8
LEVELS = 3  # of the tree in one block
BLOCK = RADIX ** LEVELS
CHUNK_BITS = 9  # a chunk of the directory holds 2 ** 9 words
FIRST_ID = -(1 << 63)


def sha(*parts: Column) -> Column:
    """Lowercase hex digest of all parts, one after the other."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the number of bytes, a colon and the value."""
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def group_key(c: Column) -> Column:
    """Text that sorts like the group by its bytes, null first."""
    return F.coalesce(F.concat(F.lit("+"), c.cast("string")), F.lit(""))


# ---- places ------------------------------------------------------------------

def _below(bit: Column) -> Column:
    """A word with all bits below this one."""
    return F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), bit.cast("int")))


def bitmap_index(rows: DataFrame) -> DataFrame:
    """(g, w, bits, many, start, total) per word of every group's bitmap of column id.

    start: rows of the group before the word; total: rows of the group; many: ids with more than one row.
    """
    ids = rows.groupBy("g", "id").agg(F.count("*").alias("c"))
    bit = F.col("id").bitwiseAND(F.lit(63))
    words = (ids.select("g", F.shiftright("id", 6).alias("w"), bit.alias("p"), "c").groupBy("g", "w")
             .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("p").cast("int"))).alias("bits"), F.sum("c").alias("n"),
                  F.collect_list(F.when(F.col("c") > 1, F.struct("p", "c"))).alias("many"))
             .withColumn("k", F.shiftright("w", CHUNK_BITS)))
    words = saved(words, "bitmaps")
    chunks = saved(running_total(words.groupBy("g", "k").agg(F.sum("n").alias("rows")), ["g", "k"], F.col("rows"), "before"), "directory")
    groups = chunks.groupBy("g").agg(F.sum("rows").alias("total"), F.min("before").alias("base"))
    directory = spread_join(chunks, groups, ["g"], "k").select("g", "k", (F.col("before") - F.col("base")).alias("before"), "total")
    inner = F.coalesce(F.sum("n").over(Window.partitionBy("g", "k").orderBy("w").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (words.withColumn("inner", inner).join(directory, ["g", "k"])
            .select("g", "w", "bits", "many", "n", (F.col("before") + F.col("inner")).alias("start"), "total"))


def places(rows: DataFrame) -> DataFrame:
    """rows (g, id, leaf, uid, ...) with pos, the row's place in its group by (id, leaf), and total, the rows of the group."""
    index = saved(bitmap_index(rows), "index")
    repeated = gauge(index, F.count_if(F.col("n") > F.bit_count("bits")).alias("n"))["n"]
    bit = F.col("id").bitwiseAND(F.lit(63))
    got = spread_join(rows.withColumn("w", F.shiftright("id", 6)), index.drop("n"), ["g", "w"], "uid").withColumn("p", bit)
    more = F.aggregate(F.filter("many", lambda x: x["p"] < F.col("p")), F.lit(0).cast("long"), lambda a, x: a + x["c"] - 1)
    got = got.withColumn("pos", F.col("start") + F.bit_count(F.col("bits").bitwiseAND(_below(F.col("p")))) + more)
    twin = F.exists("many", lambda x: x["p"] == F.col("p"))
    names = [*rows.columns, "pos", "total"]
    if not repeated:
        return got.select(*names)
    got = saved(got.select(*names, twin.alias("twin")), "places")
    twins = saved(with_position(got.where("twin"), ["g", "id", "leaf", "uid"], "turn", spread_ties=False), "twins")
    first = twins.groupBy("g", "id").agg(F.min("turn").alias("first"))
    turned = spread_join(twins, first, ["g", "id"], "uid").withColumn("pos", F.col("pos") + F.col("turn") - F.col("first"))
    return got.where("not twin").select(*names).unionByName(turned.select(*names))


# ---- trees -------------------------------------------------------------------

def _levels(total: Column) -> Column:
    """Levels above the leaves of a tree."""
    powers = F.array(*[F.lit(RADIX ** i) for i in range(21)])
    return F.size(F.filter(powers, lambda p: p < total))


def _runs(nodes: Column) -> Column:
    """The level above nodes."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / RADIX).cast("int")),
                       lambda i: F.sha2(F.array_join(F.slice(nodes, i * RADIX + 1, F.lit(RADIX)), "").cast("binary"), 256))


class Tree:
    """Nodes of all groups' trees: per round a table of blocks (g, block, total, l0 to l3), written once."""

    def __init__(self, blocks: DataFrame, most: int):
        """blocks: (g, block, total, l0) of the leaves, BLOCK slots each; most: leaves of the largest group."""
        self.rounds: list[DataFrame] = []
        while True:
            left = _levels(F.col("total")) - LEVELS * len(self.rounds)
            for i in range(LEVELS):
                blocks = blocks.withColumn(f"l{i + 1}", F.when(left > i, _runs(F.col(f"l{i}"))).otherwise(F.array().cast("array<string>")))
            top = F.coalesce(*[F.get(f"l{i}", F.when(left >= i, F.lit(0))) for i in range(LEVELS, 0, -1)], F.get("l0", F.lit(0)))
            blocks = saved(blocks.withColumn("top", top).withColumn("left", F.greatest(F.lit(0), F.least(F.lit(LEVELS), left))), "blocks")
            self.rounds.append(blocks)
            most = -(-most // BLOCK)
            if most <= 1:
                break
            slots = blocks.groupBy("g", F.floor(F.col("block") / BLOCK).alias("next")).agg(
                F.any_value("total").alias("total"), F.array_sort(F.collect_list(F.struct("block", "top"))).alias("s"))
            blocks = slots.select("g", F.col("next").alias("block"), "total", F.transform("s", lambda x: x["top"]).alias("l0"))

    def roots(self) -> DataFrame:
        """(g, root)"""
        return self.rounds[-1].select("g", F.col("top").alias("root"))

    def blocks_with_steps(self, above: DataFrame) -> DataFrame:
        """The first round's blocks joined to the steps above them.

        above: (g, steps, ...) above each group's root; a step holds the siblings left and right of a node.
        """
        carried = [c for c in above.columns if c not in ("g", "steps")]
        upper = above.withColumn("block", F.lit(0).cast("long"))
        for blocks in reversed(self.rounds[1:]):
            slots = blocks.join(upper, ["g", "block"]).select("g", "block", *carried, F.posexplode("l0").alias("i", "h"), "l0", "l1", "l2", "left", "steps")
            upper = slots.select("g", (F.col("block") * BLOCK + F.col("i")).alias("block"), *carried, steps_of(F.col("i")).alias("steps"))
        return self.rounds[0].join(upper, ["g", "block"])


def steps_of(i: Column) -> Column:
    """Steps of slot i of a block, then those above the block."""
    steps = []
    for level in range(LEVELS):
        at = F.floor(i / RADIX ** level).cast("int")
        own, nodes = at % RADIX, F.col(f"l{level}")
        steps.append(F.struct(F.array_join(F.slice(nodes, at - own + 1, own), "").alias("before"), F.array_join(F.slice(nodes, at + 2, F.lit(RADIX - 1) - own), "").alias("after")))
    return F.concat(F.slice(F.array(*steps), F.lit(1), F.col("left")), F.col("steps"))


def fold(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its steps make."""
    return F.aggregate(steps, leaf, lambda h, s: sha(s["before"], h, s["after"]))


def proof_digest(steps: Column) -> Column:
    """Digest of all siblings, from the leaf's level up, left to right."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(s["before"], s["after"])), "").cast("binary"), 256)


def manifest(df: DataFrame, fields: list[str], key: str = "doc_id", group: str = "lang", tampered: dict[str, Column] | None = None,
             where: Column | None = None) -> DataFrame:
    """Leaves, roots and proofs of all rows of df.

    fields: columns of a leaf, in order.  tampered: changed columns, by name, of the
    rows for which ``where`` holds; their folded root starts from the changed leaf.
    Columns: key, leaf, subroot, root, proof_sha256, folded_root, verified.
    """
    spark = df.sparkSession
    leaf = sha(*[field(F.col(f"`{c}`")) for c in fields])
    changed = sha(*[field((tampered or {}).get(c, F.col(f"`{c}`"))) for c in fields])
    rows = saved(df.select(
        group_key(F.col(f"`{group}`")).alias("g"), F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(FIRST_ID)).alias("id"), F.col(f"`{key}`").alias("name"),
        leaf.alias("leaf"), F.when(where if where is not None else F.lit(False), changed).alias("changed"), F.monotonically_increasing_id().alias("uid")), "leaves")
    if rows.isEmpty():
        return spark.createDataFrame([], f"`{key}` {df.schema[key].dataType.simpleString()}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")

    slot = F.struct((F.col("pos") % BLOCK).alias("slot"), "name", "leaf", "changed")
    blocks = (places(rows).groupBy("g", F.floor(F.col("pos") / BLOCK).alias("block"))
              .agg(F.any_value("total").alias("total"), F.array_sort(F.collect_list(slot)).alias("rows"))
              .withColumn("l0", F.transform("rows", lambda x: x["leaf"])))
    blocks = saved(blocks, "leaf-blocks")
    tree = Tree(blocks, gauge(blocks, F.max("total").alias("n"))["n"])

    subroots = saved(with_position(tree.roots().withColumnRenamed("root", "subroot"), ["g"], "pos", spread_ties=False), "subroots")
    n = subroots.count()
    tops = (subroots.groupBy(F.floor(F.col("pos") / BLOCK).alias("block")).agg(F.array_sort(F.collect_list(F.struct("pos", "g", "subroot"))).alias("rows"))
            .select(F.lit("").alias("g"), "block", F.lit(n).cast("long").alias("total"), "rows", F.transform("rows", lambda x: x["subroot"]).alias("l0")))
    top = Tree(tops, n)
    start = top.roots().select("g", "root", F.array().cast("array<struct<before:string,after:string>>").alias("steps"))
    above = (top.blocks_with_steps(start).select("root", "l0", "l1", "l2", "left", "steps", F.posexplode("rows").alias("i", "r"))
             .select(F.col("r.g").alias("g"), F.col("r.subroot").alias("subroot"), "root", steps_of(F.col("i")).alias("steps")))

    each = (tree.blocks_with_steps(saved(above, "above")).select("subroot", "root", "l0", "l1", "l2", "left", "steps", F.posexplode("rows").alias("i", "r"))
            .select(F.col("r.name").alias(key), F.col("r.leaf").alias("leaf"), F.col("r.changed").alias("changed"), "subroot", "root", steps_of(F.col("i")).alias("steps")))
    folded = each.select(key, "leaf", "subroot", "root", proof_digest(F.col("steps")).alias("proof_sha256"), fold(F.coalesce("changed", "leaf"), F.col("steps")).alias("folded_root"))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))
