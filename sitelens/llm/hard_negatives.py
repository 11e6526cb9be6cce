"""Hard negatives by exact integer scores of anchors and all rows.

``mine`` gives, for every anchor, its best rows of the same label (positives)
and, for every positive, the best rows of other labels whose score lies in a
window around the positive's score.

Method: vectors are turned into 64-bit integers and cut into tiles of anchors
and candidates.  A tile's scores are one matrix product by Strassen's
recursion: seven products of half the size instead of eight, odd sizes padded
with zeros, only whole-number additions, so scores are exact (whole numbers
modulo 2^64: results are right whenever a score itself fits 64 bits).  Two
passes over the tiles follow.  The first keeps a heap of the best positives per
anchor, the second, once positives are known, a heap per window.  A heap of k
(score, id) pairs merges with another one by taking the best k of both: tiles
merge into their group's heap as they come, groups merge in Spark.

A group is one block of at most about ``ANCHORS`` anchors with one block of
about ``CANDIDATES`` rows; both are dealt by a hash of the row's number, so equal
vectors or ids do not meet in one block.  Every anchor meets every row: the
queries are a stated set, in blocks.  A task holds one group and the products of a tile.

Defined results: rows with a null id, label or vector, or any null or
non-finite component take no part; rows that repeat id, label and vector count
once; rows that share an id are told apart by label and vector, but are never
each other's positives; shorter vectors are padded with zeros; equal scores
rank by the smaller id, then by order of label and vector; fewer rows than asked for give all;
a negative positive score leaves an empty window where low > high; no rows, no result.
Columns of other names are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitelens.llm.common import gauge, parts_for, saved
from sitelens.plans.ranking import with_position

ANCHORS = 1024  # of a block
CANDIDATES = 1 << 15  # of a block
BLOCK_BYTES = 32 << 20  # of a block's vectors
TILE = 4096  # candidates of one product
LEAST = 24  # a product with a side this small is not cut further


# ---- products ----------------------------------------------------------------

def _half(x: np.ndarray) -> np.ndarray:
    """x with even numbers of rows and columns."""
    r, c = x.shape
    return x if r % 2 == 0 and c % 2 == 0 else np.pad(x, ((0, r % 2), (0, c % 2)))


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b of int64 matrices."""
    if min(a.shape[0], a.shape[1], b.shape[1]) <= LEAST:
        return a @ b
    rows, cols = a.shape[0], b.shape[1]
    a, b = _half(a), _half(b)
    m, k, n = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    out = np.empty((2 * m, 2 * n), np.int64)
    top, right, left, low = out[:m, :n], out[:m, n:], out[m:, :n], out[m:, n:]
    # each of the seven products goes to the quarters that need it, then it is let go
    p = strassen(a11 + a22, b11 + b22)
    top[:], low[:] = p, p
    p = strassen(a21 + a22, b11)
    left[:] = p
    low -= p
    p = strassen(a11, b12 - b22)
    right[:] = p
    low += p
    p = strassen(a22, b21 - b11)
    top += p
    left += p
    p = strassen(a11 + a12, b22)
    top -= p
    right += p
    low += strassen(a21 - a11, b11 + b12)
    top += strassen(a12 - a22, b21 + b22)
    return out[:rows, :cols]


# ---- heaps -------------------------------------------------------------------

NONE = np.iinfo(np.int64).min


class Heaps:
    """For each of n keys the best k (score, order) pairs met; a larger score, then a smaller order, is better."""

    def __init__(self, n: int, k: int):
        self.n, self.k = n, k
        self.key, self.score, self.order = (np.empty(0, np.int64) for _ in range(3))

    def push(self, scores: np.ndarray, allowed: np.ndarray, orders: np.ndarray) -> None:
        """One row of scores per key, for the candidates of ``orders``; only allowed ones count."""
        s = np.where(allowed, scores, NONE)
        if s.shape[1] > self.k:  # nothing below the k-th score of a row can matter
            least = np.partition(s, s.shape[1] - self.k, axis=1)[:, s.shape[1] - self.k]
            ties = allowed & (s == least[:, None])
            allowed = allowed & (s > least[:, None])
            allowed |= ties & (np.cumsum(ties, axis=1, dtype=np.int32) <= self.k)  # candidates come in order
        key, at = np.nonzero(allowed)
        self.merge(key, scores[key, at], orders[at])

    def merge(self, key: np.ndarray, score: np.ndarray, order: np.ndarray) -> None:
        key, score, order = (np.concatenate(x) for x in ((self.key, key), (self.score, score), (self.order, order)))
        by = np.lexsort((order, ~score, key))  # ~ turns the order of whole numbers round without overflow
        key, score, order = key[by], score[by], order[by]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.empty(0, np.int64)
        rank = np.arange(len(key)) - np.repeat(first, np.diff(np.append(first, len(key))))
        keep = rank < self.k
        self.key, self.score, self.order = key[keep], score[keep], order[keep]


# ---- Spark -------------------------------------------------------------------

def integer_rows(df: DataFrame, key: str = "vec_id", label: str = "label", vector: str = "embedding", scale: float = 256.0) -> DataFrame:
    """(id, label, v): rows that take part, once each, with floor(scale * x) for every component x."""
    v = F.col(f"`{vector}`")
    got = (df.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{label}`").cast("long").alias("label"), v.cast("array<double>").alias("x"))
           .where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull()))
    fine = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return got.where(fine).select("id", "label", F.transform("x", lambda x: F.floor(F.lit(scale) * x)).alias("v")).distinct()


def _blocks(rows: DataFrame, parts: int, copies: int, own: str, other: str) -> DataFrame:
    """Rows with the number of their block and, once each, of all blocks of the other side."""
    return (rows.withColumn(own, F.pmod(F.xxhash64("n"), F.lit(parts)).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))))


def _matrix(col: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(col), width), np.int64)
    for i, x in enumerate(col):
        out[i, : len(x)] = x
    return out


def _ids(rows: pd.DataFrame, numbers: np.ndarray) -> np.ndarray:
    """Ids of the rows of these numbers; rows are in order."""
    return rows["id"].to_numpy()[np.searchsorted(rows["n"].to_numpy(), numbers)]


def _tiles(left: pd.DataFrame, right: pd.DataFrame, width: int):
    """(scores, candidates) of every tile; candidates are in order."""
    a = _matrix(left["v"], width)
    for i in range(0, len(right), TILE):
        part = right.iloc[i: i + TILE]
        yield strassen(a, np.ascontiguousarray(_matrix(part["v"], width).T)), part


def mine(df: DataFrame, anchors: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, label: Column | None = None,
         key: str = "vec_id", label_col: str = "label", vector: str = "embedding", scale: float = 256.0,
         block_anchors: int = ANCHORS, block_rows: int = CANDIDATES) -> DataFrame:
    """Hard negatives of the rows for which ``anchors`` (a condition on ``id``) holds.

    low, high: a negative's score times 100 lies between low and high times the positive's.
    label: the label to use, from ``id`` and ``label`` (the label itself if not given).
    Columns: anchor_id, positive_id, positive_rank, rank, negative_id, positive_score, negative_score.
    """
    rows = integer_rows(df, key, label_col, vector, scale)
    if label is not None:
        rows = rows.withColumn("label", label)
    # n: number of the row by id, then label and vector; it stands for the order of ties
    rows = saved(with_position(rows, ["id", "label", "v"], "n", spread_ties=False), "negatives")
    sizes = gauge(rows, F.count("*").alias("n"), F.count_if(anchors).alias("a"), F.coalesce(F.max(F.size("v")), F.lit(0)).alias("width"))
    width = max(1, sizes["width"])
    # enough blocks for all cores, none above its bounds in rows and bytes
    spread = -(-sizes["n"] // (2 * df.sparkSession.sparkContext.defaultParallelism))
    block_rows = max(1, min(max(spread, TILE), block_rows, BLOCK_BYTES // (8 * width)))
    n_left, n_right = parts_for(sizes["a"], min(block_anchors, block_rows), 1), parts_for(sizes["n"], block_rows, 1)
    left = _blocks(rows.where(anchors), n_left, n_right, "i", "j")
    right = _blocks(rows.toDF(*rows.columns), n_right, n_left, "j", "i")

    def best_positives(a: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        heaps, c = Heaps(len(a), positives), c.sort_values("n", ignore_index=True)
        labels, ids = a["label"].to_numpy(), a["id"].to_numpy()
        for scores, part in _tiles(a, c, width) if len(a) else ():
            same = (labels[:, None] == part["label"].to_numpy()[None, :]) & (ids[:, None] != part["id"].to_numpy()[None, :])
            heaps.push(scores, same, part["n"].to_numpy())
        return pd.DataFrame({"n": a["n"].to_numpy()[heaps.key], "other": heaps.order, "id": _ids(c, heaps.order), "score": heaps.score})

    def best_negatives(a: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        at, place, goal = [], [], []
        for i, found in enumerate(a["positives"]):
            for x in found:
                at.append(i)
                place.append(x["place"])
                goal.append(int(x["score"]))
        at, out, c = np.array(at, np.int64), Heaps(len(at), negatives), c.sort_values("n", ignore_index=True)
        # low * goal <= 100 * score <= high * goal, as bounds of the score
        least = np.array([-((-low * g) // 100) for g in goal], np.int64)
        most = np.array([(high * g) // 100 for g in goal], np.int64)
        labels = a["label"].to_numpy()
        for scores, part in _tiles(a, c, width) if len(at) else ():
            other = labels[:, None] != part["label"].to_numpy()[None, :]
            order = part["n"].to_numpy()
            for x in range(0, len(at), len(a)):  # as many windows at a time as the tile has anchors
                rows_of = at[x: x + len(a)]
                s = scores[rows_of]
                got = Heaps(len(rows_of), negatives)
                got.push(s, other[rows_of] & (s >= least[x: x + len(a), None]) & (s <= most[x: x + len(a), None]), order)
                out.merge(got.key + x, got.score, got.order)
        return pd.DataFrame({"n": a["n"].to_numpy()[at[out.key]], "place": np.array(place, np.int64)[out.key], "anchor_id": a["id"].to_numpy()[at[out.key]],
                             "other": out.order, "id": _ids(c, out.order), "score": out.score})

    def merged(parts: DataFrame, k: int, rank: str, *by: str) -> DataFrame:
        w = Window.partitionBy(*by).orderBy(F.desc("score"), "other")
        return parts.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)

    pairs = left.groupBy("i", "j").cogroup(right.groupBy("i", "j"))
    found = saved(merged(pairs.applyInPandas(best_positives, "n long, other long, id long, score long"), positives, "place", "n")
                  .select("n", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    per = found.groupBy("n").agg(F.collect_list(F.struct(F.col("place").cast("long").alias("place"), F.col("positive_score").alias("score"))).alias("positives"))
    sought = left.join(per, "n")
    pairs = sought.toDF(*sought.columns).groupBy("i", "j").cogroup(right.groupBy("i", "j"))
    hard = merged(pairs.applyInPandas(best_negatives, "n long, place long, anchor_id long, other long, id long, score long"), negatives, "rank", "n", "place")
    hard = hard.select("n", F.col("place").cast("int").alias("place"), "anchor_id", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return (hard.join(found, ["n", "place"])
            .select("anchor_id", "positive_id", F.col("place").alias("positive_rank"), "rank", "negative_id", "positive_score", "negative_score"))
