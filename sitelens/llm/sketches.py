"""Document fingerprints: bottom-k sketches of shingle hashes.

Method: a text's words (runs of anything but white space) give shingles of
``WORDS`` words; the ``K`` smallest distinct 64-bit shingle hashes are its
sketch.  The sketch of a union is the K smallest of the members' sketches, so
sketches merge across parts.  Two sketches estimate resemblance (the share of
the union's sketch that both have), containment, and, from the K-th smallest
hash, the number of distinct shingles; texts with at most K shingles are exact.

Everything is built-in functions: arrays are hashed, sorted and cut inside the
row, and a document's neighbour in id order comes from one exchange by ranges of
ids, whose first rows travel to the range before as well.

Defined results: a null text is empty; an empty text has the empty sketch and
two empty sketches are alike (1.0); fewer words than a shingle are one shingle;
rows that repeat an id follow each other in the order of their text's hash (an
id of over ``RANGE_ROWS`` rows or so: in an order that depends on how Spark reads
them); a null id comes last; an empty table gives an empty result.  Above
RANGE_ROWS * MAX_RANGES documents (33 million) ranges grow with the table, not their number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitelens.llm.common import gauge

K = 128
WORDS = 5
RANGE_ROWS = 512  # documents in a range of ids, unless that makes over MAX_RANGES ranges
MAX_RANGES = 1 << 16
LAST = (1 << 63) - 1


def _let(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.transform(F.array(value), lambda x: body(x))[0]


def shingle_hashes(text: Column, words: int = WORDS) -> Column:
    """Array of the hashes of all shingles of a text (null: none)."""
    split = F.array_remove(F.split(F.coalesce(text, F.lit("")), r"\s+"), "")

    def shingles(h: Column) -> Column:
        n = F.size(h) - (words - 1)
        every = F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda i: F.xxhash64(*[h[i + F.lit(j)] for j in range(words)]))
        return F.when(F.size(h) == 0, F.array().cast("array<bigint>")).when(n < 1, F.array(F.xxhash64(h))).otherwise(every)

    return _let(F.transform(split, lambda w: F.xxhash64(w)), shingles)


def bottom(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def sketch(text: Column, k: int = K, words: int = WORDS) -> Column:
    """Bottom-k sketch of a text: ascending array of hashes."""
    return bottom(shingle_hashes(text, words), k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of common shingles, 0 to 1."""
    both = _let(merge(a, b, k), lambda u: F.size(F.array_intersect(F.array_intersect(a, b), u)) / F.size(u))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(both)


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles (exact below k)."""
    share = (F.element_at(a, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has, 0 to 1."""
    j = resemblance(a, b, k)
    common = j / (1 + j) * (distinct_count(a, k) + distinct_count(b, k))
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), common / distinct_count(a, k)))


def merge_groups(df: DataFrame, group: str, column: str, k: int = K) -> DataFrame:
    """(group, column): one merged sketch per group.

    Hashes leave their rows, repeats go before the shuffle, and only the k
    smallest of a group and task are exchanged, so a hot group stays small.
    """
    each = df.select(group, F.explode(column).alias("h")).distinct()
    top = each.withColumn("r", F.row_number().over(Window.partitionBy(group).orderBy("h"))).where(F.col("r") <= k)
    got = top.groupBy(group).agg(F.sort_array(F.collect_list("h")).alias(column))
    return df.select(group).distinct().join(got, group, "left").select(group, F.coalesce(column, F.array().cast("array<bigint>")).alias(column))


def text_of(sketch: Column) -> Column:
    """Sketch as text: 16 hex digits a hash."""
    return F.array_join(F.transform(sketch, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def with_next(df: DataFrame, columns: dict[str, Column], key: str = "doc_id", text: str = "text") -> DataFrame:
    """df with struct ``own`` of the given columns and struct ``next`` of the row after it in key order (after the last: the first).

    Columns of those names are replaced.

    Ranges of keys are cut at approximate quantiles.  The first rows of a range
    go to the range before as its closing rows as well, so every neighbour
    is found in one exchange, with no window over the whole table.  A key that
    fills several ranges is cut by a hash of text and row, in whose order its rows then follow.
    """
    key_of = F.coalesce(F.col(key).cast("long"), F.lit(LAST))
    n = df.count()
    ranges = max(1, min(MAX_RANGES, -(-n // RANGE_ROWS)))
    got = gauge(df, F.min(key_of).alias("lo"), F.percentile_approx(key_of, [i / ranges for i in range(ranges)], max(10_000, 4 * ranges)).alias("q")) if n else {"lo": 0, "q": []}
    cuts: list[tuple[int, int, int]] = []  # smallest key of a run of ranges, its first range, how many ranges that key fills
    for v in sorted([got["lo"], *got["q"][1:]]):
        if cuts and cuts[-1][0] == v:
            cuts[-1] = (v, cuts[-1][1], cuts[-1][2] + 1)
        else:
            cuts.append((v, sum(cuts[-1][1:]) if cuts else 0, 1))
    total = sum(cuts[-1][1:])
    wide = max(1, round(len(cuts) ** 0.5))
    groups = [cuts[i: i + wide] for i in range(0, len(cuts), wide)]
    # two short searches: the group of cuts, then the cut in it
    kind = "array<struct<v:bigint,first:bigint,many:bigint>>"
    tops = F.lit([g[0][0] for g in groups]).cast("array<bigint>")
    inner = F.array(*[F.array(*[F.struct(F.lit(v).cast("long").alias("v"), F.lit(f).cast("long").alias("first"), F.lit(m).cast("long").alias("many")) for v, f, m in g]).cast(kind) for g in groups])
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), key_of.alias("at"), F.xxhash64(F.col(text)).alias("hash"), F.monotonically_increasing_id().alias("n"))
    rows = rows.withColumn("g", F.greatest(F.size(F.filter(tops, lambda x: x <= F.col("at"))), F.lit(1)))
    rows = rows.withColumn("cut", F.element_at(F.filter(F.element_at(inner, F.col("g")), lambda x: x["v"] <= F.col("at")), -1))
    hot = F.col("cut.many") > 1
    rows = rows.withColumn("tie", F.when(hot, F.xxhash64("hash", "n")).otherwise(F.col("hash")))
    # a hot key's hashes are spread evenly, so each of its ranges begins in the first eighth of its share of them
    share = (F.col("tie").cast("double") + F.lit(2.0**63)) / F.lit(2.0**64) * F.col("cut.many")
    part = F.when(F.col("at") == F.col("cut.v"), F.least(F.floor(share), F.col("cut.many") - 1)).otherwise(F.col("cut.many") - 1)
    rows = rows.withColumn("bucket", F.when(hot, F.col("cut.first") + part).otherwise(F.col("cut.first")))
    opens = (F.col("at") == F.col("cut.v")) & (~hot | (share - F.floor(share) < 0.125))
    to = F.array(F.struct(F.col("bucket"), F.lit(0).alias("closing")))
    closing = F.array(F.struct(F.pmod(F.col("bucket") - 1, F.lit(total)).alias("bucket"), F.lit(1).alias("closing")))
    rows = rows.withColumn("to", F.explode(F.when(opens, F.concat(to, closing)).otherwise(to)))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.select("row", "at", "tie", "to.bucket", "to.closing").repartition(parts, "bucket")
    own = rows.select("at", "tie", "bucket", "closing", "row", F.struct(*[c.alias(a) for a, c in columns.items()]).alias("own"))
    # of the closing rows only the first can follow another one
    w = Window.partitionBy("bucket").orderBy("closing", "at", "tie")
    return own.withColumn("next", F.lead("own").over(w)).where("closing = 0").select(
        *[F.col(f"row.`{c}`") for c in df.columns if c not in ("own", "next")], "own", "next")


def edited_fingerprints(df: DataFrame, k: int = K, words: int = WORDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text.

    The edited text has the last half (rounded down) of its code points
    replaced by as many first code points of the next document's text.
    """
    t = F.coalesce(F.col(f"row.{text}"), F.lit(""))
    d = with_next(df.select(key, text), {"text": t, "sketch": sketch(t, k, words)}, key, text)
    n = F.char_length("own.text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("own.text"), F.lit(1), n - half), F.substring(F.col("next.text"), F.lit(1), half))
    d = d.select(key, "own", "next", n.cast("long").alias("n_chars"), edited.alias("edited"))
    d = d.select("*", sketch(F.col("edited"), k, words).alias("edited_sketch"))
    return d.select(key, "n_chars", F.sha2(F.col("edited"), 256).alias("edited_sha256"), text_of(F.col("own.sketch")).alias("fingerprint"),
                    text_of(F.col("edited_sketch")).alias("edited_fingerprint"),
                    resemblance(F.col("own.sketch"), F.col("edited_sketch"), k).alias("near_edited"),
                    resemblance(F.col("own.sketch"), F.col("next.sketch"), k).alias("near_next"),
                    containment(F.col("own.sketch"), F.col("edited_sketch"), k).alias("contained_in_edited"),
                    distinct_count(F.col("own.sketch"), k).alias("n_shingles"))
