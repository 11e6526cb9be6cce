"""Removal of repeated byte strings by sparse, distributed prefix doubling.

Every byte covered by a string of ``LENGTH`` bytes that also starts in a
document with a smaller id is removed; strings are judged on the input.

Method: suffixes are ranked by prefixes of growing length, and a position
leaves as soon as its rank is unique.  Ranking every byte position would move
some forty times the input per sort, so only positions that a local rule picks
are ranked: of the ``WINDOW`` grams of ``GRAM`` bytes inside a string of
LENGTH bytes, the one with the smallest hash (the leftmost of equals).  The
choice depends on that string alone, so equal strings pick the same place in
themselves.  Consecutive strings of one document that pick the same gram form
a run.

1. Prefix ``GRAM``: runs are exchanged and sorted by their gram's rank, within
   it by the rank of the whole run (its bytes and place of the gram).  A run
   that a smaller document has too is covered from end to end.
2. Prefix 34 (the gram and the ``HALF`` bytes right or left of it): where one
   gram has several different runs, the smallest document of each is ranked
   again on either side; sides found in a single document leave.
3. Prefix 50: the strings of the remaining sides are ranked one by one.

Ranks are 64-bit hashes under the gram's own 64-bit hash (two strings count as
equal if both agree), so no sort needs a global numbering.  Runs that a batch
holds twice are settled before the exchange, which keeps a passage shared by a
third of all documents to one row a batch.

A row is known by a 64-bit hash of its doc_id and text (``row``), by which it is
grouped and cut; its doc_id (``doc``) only says which documents are smaller.

Defined results: a null text is empty; matches never cross documents; a null
doc_id counts as larger than any other; rows that share a doc_id, or have none,
are documents of one rank, of which none loses what only its equals hold; rows
that repeat both doc_id and text are treated alike; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitelens.llm.common import saved

LENGTH = 50
GRAM = 18
WINDOW = LENGTH - GRAM + 1
HALF = (LENGTH - GRAM) // 2
BITS = WINDOW  # a string starts 0 to LENGTH - GRAM bytes before its gram
CHUNK = 1 << 19  # bytes of text worked on at a time
LAST = (1 << 63) - 1  # stands for a null key
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)
_BASE = 0x5851F42D4C957F2D  # odd


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _M3
    x = (x ^ (x >> np.uint64(29))) * _M1
    return x ^ (x >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, by doubling."""
    out = np.ones(max(n, 1), np.uint64)
    size = 1
    while size < n:
        step = np.uint64(pow(base, size, 1 << 64))
        out[size: 2 * size] = out[: min(size, n - size)] * step
        size *= 2
    return out


_TABLE = _mix(np.arange(1, 257, dtype=np.uint64) * _M2)
_UP = _powers(_BASE, 2 * CHUNK + 64)
_DOWN = _powers(pow(_BASE, -1, 1 << 64), 2 * CHUNK + 64)


def _runs(data: np.ndarray, borders: np.ndarray):
    """Runs of texts laid end to end (borders from 0, 16 bytes of padding).

    Returns first string, number of strings, gram place, gram rank, run rank.
    """
    n = int(borders[-1])
    m = n - LENGTH + 1  # strings
    if m <= 0:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),) * 2
    words = np.lib.stride_tricks.as_strided(data[:8].view(np.uint64), (n - 7,), (1,))
    m_grams = n - GRAM + 1
    gram = words[:m_grams] * _M1
    for at in (8, GRAM - 8):  # 8 bytes at a time, the last ones overlapping
        gram = _mix(gram) ^ words[at: at + m_grams] * _M2
    gram = _mix(gram)
    value, place = gram, np.arange(len(gram), dtype=np.int32)
    size = 1
    while size < WINDOW:  # smallest of windows of growing size, leftmost of equals
        step = min(size, WINDOW - size)
        left = value[:-step] <= value[step:]
        value, place = np.where(left, value[:-step], value[step:]), np.where(left, place[:-step], place[step:])
        size += step
    ok = np.ones(m, bool)  # strings inside one text
    for b in borders[1:-1]:
        ok[max(0, b - LENGTH + 1): b] = False
    at = np.flatnonzero(ok)
    pick = place[at]
    new = np.ones(len(at), bool)
    new[1:] = (pick[1:] != pick[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(at)))
    start, gram_at = at[first].astype(np.int64), pick[first].astype(np.int64)
    down = _DOWN if n < len(_DOWN) else _powers(pow(_BASE, -1, 1 << 64), n + 1)
    up = _UP if n < len(_UP) else _powers(_BASE, n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_TABLE[data[:n]] * down[:n], out=total[1:])
    body = (total[start + count - 1 + LENGTH] - total[start]) * up[start]
    shape = ((gram_at - start) * 64 + count).astype(np.uint64)
    return start, count, gram_at - start, gram[gram_at], _mix(body ^ _mix(shape * _M2))


def _positions(df: DataFrame) -> DataFrame:
    """(gram, run, doc, row, pos) of every text's runs; pos packs start, bytes ahead of the gram and strings.

    A run that a smaller document of the same batch has as well is settled: it
    is covered.  Its pos is negative and its ranks are replaced by a hash of its own
    place, so that it takes part in no comparison.
    """
    def run(batches):
        for batch in batches:
            docs, hashes = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            texts = batch.column(2).cast(pa.large_binary())
            off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset: texts.offset + len(texts) + 1]
            raw = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] else np.empty(0, np.uint8)
            for doc, start, count, ahead, gram, rank in _pieces(raw, off):
                ids, own, pos = docs[doc], hashes[doc], (start << 16) | (ahead << 8) | count
                order = np.lexsort((ids, rank, gram))
                g, r, d, o, pos = gram[order], rank[order], ids[order], own[order], pos[order]
                head = np.ones(len(g), bool)
                head[1:] = (g[1:] != g[:-1]) | (r[1:] != r[:-1])
                if len(d):
                    settled = d > d[np.flatnonzero(head)][np.cumsum(head) - 1]
                    g[settled] = _mix(_mix(o[settled].view(np.uint64)) ^ pos[settled].view(np.uint64) * _M2)
                    r[settled] = 0
                    pos[settled] = -pos[settled]
                yield pa.RecordBatch.from_pydict({"gram": pa.array(g.view(np.int64)), "run": pa.array(r.view(np.int64)),
                                                  "doc": pa.array(d, pa.int64()), "row": pa.array(o, pa.int64()), "pos": pa.array(pos, pa.int64())})

    return df.mapInArrow(run, "gram long, run long, doc long, row long, pos long")


def _pieces(raw: np.ndarray, off: np.ndarray):
    """Runs of a batch's texts, about CHUNK bytes at a time; a longer text in overlapping parts."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + CHUNK, "right")) - 1)
        a, e = int(off[i]), int(off[j])
        while True:
            # parts overlap by a string less one byte; a run cut there differs from its like and is ranked again
            stop = e if j > i + 1 else _part_end(raw, a, e)
            data = np.zeros(stop - a + 24, np.uint8)
            data[: stop - a] = raw[a:stop]
            borders = (off[i: j + 1] - a).astype(np.int64) if j > i + 1 else np.array([0, stop - a])
            start, count, ahead, gram, rank = _runs(data, borders)
            at = np.searchsorted(borders, start, "right") - 1
            base = (borders[at] if j > i + 1 else np.full(len(start), int(off[i]) - a))
            yield i + at, start - base, count, ahead, gram, rank
            if stop >= e:
                break
            a = stop - LENGTH + 1
        i = j


def _part_end(raw: np.ndarray, a: int, e: int) -> int:
    return e if e - a <= 2 * CHUNK else a + CHUNK


def _hits(place, mask):
    """Covered strings around one gram as a number: the gram's place, then a bit for every
    string, numbered by how many bytes it starts before the gram."""
    return F.shiftleft(place.cast("long"), BITS).bitwiseOR(mask).alias("hits")


def _doc(key: str):
    return F.coalesce(F.col(key).cast("long"), F.lit(LAST))


def _row(key: str, text: str):
    """With ``_doc`` what a row is known by: a hash of its key and text."""
    return F.xxhash64(F.col(key).cast("long"), F.col(text))


def covered_strings(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, row, hits): strings of each text that a smaller document has, by gram (see ``_hits``)."""
    spark = df.sparkSession
    docs = df.select(_doc(key).alias("doc"), _row(key, text).alias("row"), F.col(text).alias("text")).where(F.length("text") >= 1)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    # prefix GRAM: one exchange serves both windows
    by_run, by_gram = Window.partitionBy("gram", "run"), Window.partitionBy("gram")
    ranked = (_positions(docs).repartition(parts, "gram")
              .withColumn("least", F.min("doc").over(by_run))
              .withColumn("several", F.min("run").over(by_gram) != F.max("run").over(by_gram))
              .withColumn("covered", (F.col("pos") < 0) | (F.col("doc") > F.col("least")))
              .where("covered or several"))
    pos = F.abs("pos")
    first = saved(ranked.select(F.when(~F.col("covered"), F.col("gram")).alias("gram"), "doc", "row", F.shiftright(pos, 16).cast("int").alias("start"),
                                F.shiftright(pos, 8).bitwiseAND(F.lit(255)).cast("int").alias("ahead"),
                                pos.bitwiseAND(F.lit(255)).cast("int").alias("count"), "covered"), "runs")
    whole = F.expr("shiftleft(shiftleft(1L, count) - 1, ahead - count + 1)")
    done = first.where("covered").select("doc", "row", _hits(F.col("start") + F.col("ahead"), whole))
    rest = _contexts(docs, first.where("not covered").select("gram", "doc", "row", "start", "ahead", "count")).repartition(parts, "gram")

    # prefix 34: the gram with the bytes left (0) or right (1) of it, if a string reaches that far
    at_gram = F.col("ahead") + 1
    left, right = F.col("ahead") >= HALF, F.col("count") + LENGTH - 1 - F.col("ahead") >= GRAM + HALF
    side = F.array_compact(F.array(
        F.when(left, F.struct(F.lit(0).alias("side"), F.xxhash64(F.substring(F.col("bytes"), at_gram - HALF, F.lit(GRAM + HALF))).alias("rank"))),
        F.when(right, F.struct(F.lit(1).alias("side"), F.xxhash64(F.substring(F.col("bytes"), at_gram, F.lit(GRAM + HALF))).alias("rank")))))
    w = Window.partitionBy("gram", "side", "rank")
    sides = (rest.withColumn("s", F.explode(side)).select("gram", "doc", "row", "start", "ahead", "count", "bytes", "s.side", "s.rank")
             .withColumn("lo", F.min("doc").over(w)).withColumn("hi", F.max("doc").over(w)).where("lo < hi"))

    # prefix 50: strings that start at least HALF bytes before the gram go by its left side, others by the right one
    least_o = F.col("ahead") - F.col("count") + 1
    lo_o = F.when(F.col("side") == 0, F.greatest(least_o, F.lit(HALF))).otherwise(least_o)
    hi_o = F.when(F.col("side") == 0, F.col("ahead")).otherwise(F.least(F.col("ahead"), F.lit(HALF - 1)))
    strings = (sides.withColumn("from", lo_o.cast("int")).withColumn("to", hi_o.cast("int")).where("from <= to")
               .withColumn("o", F.explode(F.sequence("from", "to")))
               .select("gram", "doc", "row", "o", (F.col("start") + F.col("ahead")).alias("place"),
                       F.xxhash64(F.substring(F.col("bytes"), F.col("ahead") - F.col("o") + 1, F.lit(LENGTH))).alias("rank")))
    w = Window.partitionBy("gram", "o", "rank")
    late = (strings.withColumn("lo", F.min("doc").over(w)).where("lo < doc")
            .groupBy("gram", "doc", "row", "place").agg(F.bit_or(F.expr("shiftleft(1L, o)")).alias("mask")))
    late = saved(late.select("doc", "row", _hits(F.col("place"), F.col("mask"))), "strings")
    return done.unionByName(late)


def _contexts(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """runs with their bytes, from one join with the texts.  Equal rows have equal runs, which count once."""
    each = runs.groupBy("doc", "row").agg(F.collect_set(F.struct("gram", "start", "ahead", "count")).alias("runs"))  # at most a document's length
    cut = F.transform("runs", lambda r: F.struct(
        r["gram"].alias("gram"), r["start"].alias("start"), r["ahead"].alias("ahead"), r["count"].alias("count"),
        F.substring(F.col("raw"), r["start"] + 1, r["count"] + LENGTH - 1).alias("bytes")))
    return (docs.join(each, ["doc", "row"]).select("doc", "row", F.col("text").cast("binary").alias("raw"), "runs")
            .select("doc", "row", F.explode(cut).alias("r")).select("r.gram", "doc", "row", "r.start", "r.ahead", "r.count", "r.bytes"))


def with_hits(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """df with ``removed``: a document's covered strings as an array, null if none."""
    per = (covered_strings(df, key, text).groupBy(F.col("doc").alias("_doc"), F.col("row").alias("_row"))
           .agg(F.collect_set("hits").alias("removed")))  # at most a document's length
    d = df.drop("removed").withColumns({"_doc": _doc(key), "_row": _row(key, text)})
    return d.join(per, ["_doc", "_row"], "left").drop("_doc", "_row")


def merge_hits(hits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal covered runs of bytes: starts and ends."""
    row, o = np.nonzero((hits[:, None] >> np.arange(BITS)) & 1)
    a = np.unique((hits >> BITS)[row] - o)
    new = np.ones(len(a), bool)
    new[1:] = a[1:] > a[:-1] + LENGTH
    first = np.flatnonzero(new)
    return a[first], a[np.append(first[1:], len(a)) - 1] + LENGTH


def _lists(col: pa.Array) -> list[np.ndarray]:
    """Rows of a list column as arrays (null: empty)."""
    flat = col.flatten().to_numpy(zero_copy_only=False)
    size = pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size)
    return [flat[e - n: e] for n, e in zip(size.tolist(), ends.tolist())]


def _cut(raw: bytes, removed: np.ndarray, whole_chars: bool = False) -> tuple[bytes, int, int]:
    """Remaining bytes, number of removed ones and of their maximal runs.

    whole_chars: a run gives up bytes of characters that it covers in part.
    """
    if not len(removed):
        return raw, 0, 0
    a, e = merge_hits(removed)
    if whole_chars:
        inside = lambda i: i < len(raw) and raw[i] & 0xC0 == 0x80
        pairs = []
        for x, y in zip(a.tolist(), e.tolist()):
            while inside(x):
                x += 1
            while y > x and inside(y):
                y -= 1
            pairs.append((x, max(x, y)))
    else:
        pairs = list(zip(a.tolist(), e.tolist()))
    keep, last = [], 0
    for x, y in pairs:
        keep.append(raw[last:x])
        last = y
    keep.append(raw[last:])
    return b"".join(keep), sum(y - x for x, y in pairs), len(pairs)


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """df with ``text`` reduced to what is kept, in whole characters (null stays null)."""
    src = with_hits(df, key, text)
    schema = T.StructType([f for f in src.schema.fields if f.name != "removed"])

    def run(batches):
        for batch in batches:
            texts, gone = batch.column(text).to_pylist(), _lists(batch.column("removed"))
            kept = [x if not len(r) else _cut(x.encode(), r, True)[0].decode() for x, r in zip(texts, gone)]
            cols = {n: batch.column(n) for n in schema.names}
            yield pa.RecordBatch.from_pydict(cols | {text: pa.array(kept, pa.string())})

    return src.mapInArrow(run, schema)


def repeat_digests(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_bytes, n_removed, n_spans, kept_sha256 per document."""
    src = with_hits(df.select(key, text), key, text)
    schema = T.StructType([df.schema[key], T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
                           T.StructField("n_spans", T.LongType()), T.StructField("kept_sha256", T.StringType())])

    def run(batches):
        for batch in batches:
            rows = [((x or "").encode(), r) for x, r in zip(batch.column(text).to_pylist(), _lists(batch.column("removed")))]
            cut = [_cut(x, r) for x, r in rows]
            yield pa.RecordBatch.from_pydict({
                key: batch.column(key), "n_bytes": pa.array([len(x) for x, _ in rows], pa.int64()),
                "n_removed": pa.array([c[1] for c in cut], pa.int64()), "n_spans": pa.array([c[2] for c in cut], pa.int64()),
                "kept_sha256": pa.array([hashlib.sha256(c[0]).hexdigest() for c in cut], pa.string())})

    return src.select(key, text, "removed").mapInArrow(run, schema)
