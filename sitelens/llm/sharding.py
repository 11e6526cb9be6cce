"""Shards of near equal bytes by histogram sort.

``shard_by_bytes`` gives every row a shard and a gapless slot in it.

Method: rows are ordered by a 24-byte key (hash of the group, id, number of
the row), so no two rows share one and any order can be cut anywhere.  To
find the keys that cut the order into equal bytes, a round counts the exact
bytes and rows below a set of probe keys, one partial histogram a task, summed
by Spark; every cut keeps the interval that holds its target, narrowed to the
smallest and largest key seen in it, and the next round probes inside.  A cut
is settled when a probe is within ``TOLERANCE`` of a shard, or when no key lies
between its two neighbours.  Then each row's range is known and the rows are
exchanged once; the last histogram gives each range's first slot, so slots need
no second pass.

Equal texts share the hash and lie next to each other: a group stays in one
shard unless a cut within tolerance must go through it, as when it is larger
than a shard; it is then cut by id, and rows of one id by their numbers.

Shards are made of ranges of about ``RANGE_ROWS`` rows, so the last sort is
spread over tasks however few the shards are.  The driver holds PROBES keys a
cut.

Defined results: null text has size 1; null ids come first in their group;
identical rows are interchangeable and get different slots; an empty table
gives an empty result; a shard may be empty when single rows outweigh it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitelens.llm.common import gauge, saved

PROBES = 32
TOLERANCE = 0.001  # of a shard
RANGE_ROWS = 1_000_000
WIDTH = 24  # bytes of a key
TOP = 1 << (8 * WIDTH)


def order_key(group: Column, id: Column) -> Column:
    """16 bytes that sort by the group's hash, then by id (null first); the row's number follows later."""
    low = F.coalesce(id.cast("long"), F.lit(-(1 << 63))).bitwiseXOR(F.lit(-(1 << 63)))
    return F.unhex(F.concat(F.lpad(F.hex(group), 16, "0"), F.lpad(F.hex(low), 16, "0")))


def _bytes(k: int) -> bytes:
    return min(k, TOP - 1).to_bytes(WIDTH, "big")


def _probe_array(keys: list[int]) -> np.ndarray:
    # fixed width: zero bytes at the end compare like the padding they are
    return np.array([_bytes(k) for k in keys], f"S{WIDTH}") if keys else np.empty(0, f"S{WIDTH}")


def _keys(col: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), f"S{WIDTH}")


def _histogram(rows: DataFrame, probes: list[int]) -> list[tuple[int, int, int, int]]:
    """Per interval between probes: bytes, rows, smallest and largest key."""
    def run(batches):
        p = _probe_array(probes)
        size, n = np.zeros(len(p) + 1, np.int64), np.zeros(len(p) + 1, np.int64)
        lo, hi = {}, {}
        for batch in batches:
            if not batch.num_rows:
                continue
            k = _keys(batch.column(0))
            at = np.searchsorted(p, k, "right")
            size += np.bincount(at, batch.column(1).to_numpy(), len(p) + 1).astype(np.int64)
            n += np.bincount(at, minlength=len(p) + 1)
            order = np.lexsort((k, at))
            a = at[order]
            first = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
            last = np.append(first[1:], len(a)) - 1
            for x, f, e in zip(a[first].tolist(), order[first], order[last]):
                f, e = k[f].ljust(WIDTH, b"\0"), k[e].ljust(WIDTH, b"\0")
                lo[x], hi[x] = min(lo.get(x, f), f), max(hi.get(x, e), e)
        x = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict({"i": pa.array(x, pa.int32()), "size": pa.array(size[x]), "n": pa.array(n[x]),
                                          "lo": pa.array([lo[v] for v in x.tolist()], pa.binary()), "hi": pa.array([hi[v] for v in x.tolist()], pa.binary())})

    got = rows.select("key", "size").mapInArrow(run, "i int, size long, n long, lo binary, hi binary")
    out = [(0, 0, 0, 0)] * (len(probes) + 1)
    for r in got.groupBy("i").agg(F.sum("size").alias("size"), F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect():
        out[r["i"]] = (r["size"], r["n"], int.from_bytes(r["lo"], "big"), int.from_bytes(r["hi"], "big"))
    return out


def find_cuts(rows: DataFrame, total: int, shards: int, per_shard: int, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """(key, rows below it) of every cut between shards * per_shard ranges of equal bytes."""
    ranges = shards * per_shard
    cuts: dict[int, tuple[int, int]] = {}
    # lowest key, bytes and rows below it; key above all, bytes and rows below that
    span = {i: (0, 0, 0, TOP, total, None) for i in range(1, ranges)}
    while span:
        probes = set()
        for lo, _, _, hi, _, _ in span.values():
            probes.update({lo + (hi - lo) * j // (PROBES + 1) for j in range(PROBES + 2)} - {0, TOP})
        probes = sorted(probes)
        hist = _histogram(rows, probes)
        below_b, below_n = np.cumsum([0] + [h[0] for h in hist]).tolist(), np.cumsum([0] + [h[1] for h in hist]).tolist()
        for i in list(span):
            target = total * i // ranges
            slack = total / shards * (tolerance if i % per_shard == 0 else 0.1 / per_shard)
            j = int(np.searchsorted(below_b, target, "right")) - 1  # the interval that holds the target
            j = min(j, len(hist) - 1)
            while j and not hist[j][1]:
                j -= 1
            size, n, lo, hi = hist[j]
            edges = [(abs(below_b[j] - target), lo if n else 0, below_n[j]), (abs(below_b[j] + size - target), hi + 1 if n else TOP, below_n[j] + n)]
            off, key, under = min(edges)
            if off <= slack or lo == hi:
                cuts[i] = (key, under)
                del span[i]
            else:
                span[i] = (lo, below_b[j], below_n[j], hi + 1, below_b[j] + size, below_n[j] + n)
    return [cuts[i] for i in range(1, ranges)]


def shard_by_bytes(df: DataFrame, size: str, key: Column, shards: int = 16, tolerance: float = TOLERANCE) -> DataFrame:
    """df with shard (from 0) and slot (gapless from 0 in its shard); columns of those names are replaced."""
    spark = df.sparkSession
    names = [c for c in df.columns if c not in ("shard", "slot")]
    rows = saved(df.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(f"`{size}`").cast("long").alias("size"),
                           F.concat(key, F.unhex(F.lpad(F.hex(F.monotonically_increasing_id()), 16, "0"))).alias("key")), "shards")
    sums = gauge(rows, F.count("*").alias("n"), F.sum("size").alias("size"))
    per_shard = max(1, -(-sums["n"] // (shards * RANGE_ROWS)))
    cuts = find_cuts(rows, sums["size"], shards, per_shard, tolerance) if sums["n"] else []
    under = [0] + [n for _, n in cuts]
    before = [under[i] - under[i - i % per_shard] for i in range(len(under))]  # rows of the shard's earlier ranges
    keys = [k for k, _ in cuts]
    schema = T.StructType(rows.schema.fields + [T.StructField("range", T.IntegerType())])

    def run(batches):
        p = _probe_array(keys)
        for batch in batches:
            k = _keys(batch.column(2)) if batch.num_rows else np.empty(0, f"S{WIDTH}")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.searchsorted(p, k, "right"), pa.int32())], names=schema.names)

    placed = rows.mapInArrow(run, schema)
    w = Window.partitionBy("range").orderBy("key")
    first = F.element_at(F.lit(before).cast("array<bigint>"), F.col("range") + 1)
    return placed.select("row", (F.col("range") / per_shard).cast("int").alias("shard"),
                         (first + F.row_number().over(w) - 1).alias("slot")).select("row.*", "shard", "slot")
