"""Best-fit packing of token pieces into sequences.

``cut_documents`` tokenises texts and cuts them into pieces of at most
``capacity`` tokens; ``pack`` places pieces of given lengths.

Method (bulk-synchronous best fit): pieces are range-sorted by length and
numbered within their length; open sequences ("gaps") are numbered within
their free space.  A round sweeps from the longest piece down, each taking the
smallest gap that still fits (its successor among the gaps); pieces that want
the same gap size are told apart by rank, the r-th piece of a run taking the
r-th gap.  Matched rows meet in one equi-join on the match number, all gaps are
updated, and the next round follows; when no gap fits, as many empty sequences
are opened as the waiting pieces fill by their lengths.  Lengths fall in bands of a factor two
(longest first, as in best-fit decreasing), and a gap of k times the band's
longest piece takes k pieces a round, so rounds stay few at any size.

Lengths are whole numbers up to ``capacity``, so a sweep needs only the number
of pieces per length and of gaps per free space: at most ``capacity`` + 1
counts each on the driver, whatever the input.  Pieces, gaps and matches are
rows of Spark tables throughout; a hot length is spread over range partitions.

Defined results: null or empty text is one piece holding the separator alone;
an empty table gives an empty result; equal lengths are placed in the order of
a row number; every other column of ``pack``'s input passes through unchanged
whatever its name.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitelens.llm.bpe import load, row_slices
from sitelens.llm.common import parts_for, saved

CAPACITY = 2048
SEPARATOR = 0
ROUNDS_A_SAVE = 4  # rounds whose matches are joined and written together


def cut_documents(df: DataFrame, path: str, capacity: int = CAPACITY, separator: int = SEPARATOR,
                  key: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """Pieces of every text: key, piece, start, length, ids_crc32 (and ids).

    A text's ids are followed by the separator; only longer ones are cut, and
    then the first piece holds the remainder.
    """
    fields = [df.schema[key], T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
              T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())]
    if keep_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))

    def run(batches):
        bpe = load(path)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for a, e in row_slices(texts):
                got, per = bpe.encode(texts.slice(a, e - a))
                ends = np.cumsum(per)
                size = per + 1
                flat = np.insert(got, ends, separator).astype("<u4")  # the separator after each text
                total = np.cumsum(size)
                count = -(-size // capacity)
                first = size - (count - 1) * capacity
                doc = np.repeat(np.arange(e - a), count)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
                length = np.where(piece == 0, first[doc], capacity)
                start = np.where(piece == 0, 0, first[doc] + (piece - 1) * capacity)
                at = (total - size)[doc] + start
                out = {key: keys.slice(a, e - a).take(pa.array(doc)), "piece": pa.array(piece, pa.int32()),
                       "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()),
                       "ids_crc32": pa.array([zlib.crc32(flat[x:x + n]) for x, n in zip(at, length)], pa.int64())}
                if keep_ids:
                    off = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
                    out["ids"] = pa.ListArray.from_arrays(pa.array(off), pa.array(flat.astype(np.int32)))
                yield pa.RecordBatch.from_pydict(out)

    return df.select(key, text).mapInArrow(run, T.StructType(fields))


def _sweep(waiting: dict[int, int], done: dict[int, int], gaps: np.ndarray, hi: int):
    """One round over counts.

    Returns rows for pieces (length, lo, hi, match0, per_gap, x0), rows for
    gaps (free, lo, hi, match0, new_free, new_rank0) and the new gap counts;
    lo and hi are rank ranges, match numbers are consecutive.
    """
    per = np.maximum(1, np.arange(len(gaps)) // hi)
    slots = gaps * per
    filled: dict[int, list[tuple[int, int]]] = {}
    for length in sorted(waiting, reverse=True):
        c = length
        while waiting[length]:
            open_at = np.flatnonzero(slots[c:] > 0)
            if not open_at.size:
                break
            c += int(open_at[0])
            n = min(waiting[length], int(slots[c]))
            filled.setdefault(c, []).append((length, n))
            slots[c] -= n
            waiting[length] -= n
    new = gaps.copy()
    used = {c: -(-sum(n for _, n in runs) // int(per[c])) for c, runs in filled.items()}
    for c, n in used.items():
        new[c] -= n
    piece_rows, gap_rows, match = [], [], 0
    for c, runs in sorted(filled.items()):
        k, x = int(per[c]), 0
        left = []  # [length, count] still to be laid into gaps
        for length, n in runs:
            piece_rows.append((length, done[length], done[length] + n, match, k, x))
            done[length] += n
            x += n
            left.append([length, n])
        gap, i = 0, 0
        while i < len(left):
            length, n = left[i]
            whole = n // k
            if whole:  # so many gaps get k pieces of one length
                take, count, room = [(i, whole * k)], whole, c - k * length
            else:  # one gap gets the rest of this length and of the next ones
                take, room, free = [], c, k
                for j in range(i, len(left)):
                    m = min(free, left[j][1])
                    take.append((j, m))
                    room -= m * left[j][0]
                    free -= m
                    if not free:
                        break
                count = 1
            gap_rows.append((c, gap, gap + count, match, room, int(new[room]) if room != c else 0))
            new[room] += count
            gap += count
            for j, m in take:
                left[j][1] -= m
            while i < len(left) and not left[i][1]:
                i += 1
        if gap < gaps[c]:
            gap_rows.append((c, gap, int(gaps[c]), None, c, 0))
        match += gap
    return piece_rows, gap_rows, new


PIECE_ROW = ("at", "lo", "hi", "match0", "per_gap", "x0", "round")
GAP_ROW = ("free_at", "lo", "hi", "match0", "new_free", "new_rank0", "round")


def _local(spark, rows: list[tuple], names: tuple[str, ...]) -> DataFrame:
    return spark.createDataFrame(pa.table({n: pa.array(list(c), pa.int64()) for n, c in zip(names, zip(*rows))}))


def pack(pieces: DataFrame, capacity: int = CAPACITY, length: str = "length") -> DataFrame:
    """pieces with sequence_id and offset (columns of those names are replaced).

    Every length must be from 1 to capacity.
    """
    spark = pieces.sparkSession
    out_cols = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    base = saved(pieces.select(F.struct(*[F.col(f"`{c}`") for c in out_cols]).alias("row"),
                               F.col(f"`{length}`").cast("long").alias("length"),
                               F.monotonically_increasing_id().alias("id")), "pieces")
    counts = {r["length"]: r["n"] for r in base.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if any(n is None or not 1 <= n <= capacity for n in counts):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    result = [base.where(F.col("length") == capacity).select("row", (-1 - F.col("id")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]

    # range sort by length; a row's rank in its length follows from its place and the parts' counts
    order = saved(base.where(F.col("length") < capacity).repartitionByRange("length", "id").sortWithinPartitions("length", "id")
                  .withColumn("place", F.monotonically_increasing_id()), "order")
    part = F.shiftright("place", 33)
    first = order.groupBy(part.alias("part"), "length").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = saved(first.select("part", "length", "first", before.alias("before")), "first")
    ranked = saved(order.withColumn("part", part).join(first, ["part", "length"]).select(
        "row", "length", (F.col("place") - F.col("first") + F.col("before")).alias("rank")), "ranked")

    gaps = np.zeros(capacity + 1, np.int64)
    gap_df = spark.createDataFrame([], "seq long, free long, rank long")
    done = {n: 0 for n in counts}
    opened, hi = 0, capacity - 1
    while hi >= 1:
        lo = hi // 2 + 1 if hi > max(1, capacity // 128) else 1
        waiting = {n: counts[n] for n in range(lo, hi + 1) if n in counts}
        in_band = ranked.where(F.col("length").between(lo, hi))
        sides, rounds = [], 0
        while any(waiting.values()):
            if not gaps[min(n for n, m in waiting.items() if m):].any():
                # a sequence holds capacity // n pieces of length n
                need = math.ceil(sum(m / (capacity // n) for n, m in waiting.items()))
                gap_df = gap_df.union(spark.range(0, need, 1, parts_for(need, 1_000_000)).select(
                    (F.col("id") + opened).alias("seq"), F.lit(capacity).cast("long").alias("free"), (F.col("id") + int(gaps[capacity])).alias("rank")))
                opened += need
                gaps[capacity] += need
            piece_rows, gap_rows, gaps = _sweep(waiting, done, gaps, hi)
            # at most one row per length and gap size met in a sweep: about 3 x capacity rows
            # (the round is a column, so that plans and their code are the same in every round)
            p = F.broadcast(_local(spark, [(*r, rounds) for r in piece_rows], PIECE_ROW))
            g = F.broadcast(_local(spark, [(*r, rounds) for r in gap_rows], GAP_ROW))
            x = F.col("x0") + F.col("rank") - F.col("lo")
            left = in_band.join(p, (F.col("length") == F.col("at")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi"))).select(
                "row", "length", x.alias("x"), "round", (F.col("match0") + F.floor(x / F.col("per_gap"))).alias("match"))
            met = saved(gap_df.where("free > 0").join(g, (F.col("free") == F.col("free_at")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")), "left").select(
                "seq", "free", "round", (F.col("match0") + F.col("rank")).alias("match"), F.coalesce("new_free", "free").alias("new_free"),
                F.coalesce(F.col("new_rank0") + F.col("rank") - F.col("lo"), F.col("rank")).alias("new_rank")), "gaps")
            sides.append((left, met.where("match is not null").select("seq", "free", "round", "match")))
            gap_df = met.select("seq", F.col("new_free").alias("free"), F.col("new_rank").alias("rank"))
            rounds += 1
            if len(sides) == ROUNDS_A_SAVE or not any(waiting.values()):
                result.append(saved(_meet(sides, capacity), "placed"))
                sides = []
        hi = lo - 1
    out = result[0]
    for more in result[1:]:
        out = out.unionByName(more)
    return out.select(*[F.col("row").getField(c).alias(c) for c in out_cols], "sequence_id", "offset")


def _meet(sides: list[tuple[DataFrame, DataFrame]], capacity: int) -> DataFrame:
    """Matched pieces and gaps of some rounds, joined on round and match number."""
    left, right = sides[0]
    for a, b in sides[1:]:
        left, right = left.unionByName(a), right.unionByName(b)
    w = Window.partitionBy("round", "match").orderBy("x").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.coalesce(F.sum("length").over(w), F.lit(0))  # at most per_gap rows a match
    return left.join(right, ["round", "match"]).select(
        "row", F.col("seq").alias("sequence_id"), (F.lit(capacity) - F.col("free") + ahead).alias("offset"))
