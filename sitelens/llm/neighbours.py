"""Approximate nearest neighbours by a hierarchical k-means tree.

Method: a tree of k-means splits (``BRANCH`` children a node) is fitted to a
sample of at most ``SAMPLE`` unit vectors, chosen by a hash of the id; every
vector of the table then descends it and lies in one leaf.  A query visits
leaves best bin first: a priority queue holds the tree's open branches by the
cosine of their centre, the best one is followed down to a leaf, its siblings
are queued.  How many leaves to visit is calibrated: for ``CALIBRATION``
queries the exact neighbours are found by comparing them, in one block, with
every vector, and visits widen until ``RECALL`` of those neighbours lie in the
visited leaves.  Visits also go on until a query has met enough vectors.

A query is sent to each leaf it visits, so the size of the tree bounds the rows
that one query makes: ``SAMPLE`` is small for that.  Beyond it leaves grow with
the table, not their number.

Equal vectors are indexed once with their k + 1 smallest ids, which is all
that a result can show of them, so a vector held by a third of all rows is one
entry.  Leaves are joined to queries in blocks of at most about ``BLOCK_ROWS``
entries and as many queries.

Scores are cosines of the original vectors in double precision; scores that
agree to ``DIGITS`` decimal places tie, as those of vectors with one direction
differ by rounding alone, and ties go to the smaller id.  Vectors that are null, zero, or hold null or non-finite
components take no part, nor do rows without an id; a table without vectors
gives an empty result; vectors must share one length.  Ids that repeat with
the same vector count once.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitelens.llm.common import saved

SAMPLE = 4_000
BRANCH = 8
LEAF = 24  # sample vectors a leaf holds at most, unless they are equal
CALIBRATION = 128
RECALL = 0.97
BLOCK_ROWS = 20_000
QUERY_BLOCK = 512  # queries scored against a block at once
ITERATIONS = 8
DIGITS = 12  # scores that agree to so many decimal places tie


@dataclass
class Node:
    leaf: int = -1
    centres: np.ndarray | None = None
    children: list["Node"] = field(default_factory=list)


def _split(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means with farthest starting points: centres, member of each row."""
    picked = [0]
    near = x @ x[0]
    while len(picked) < min(BRANCH, len(x)):
        picked.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[picked[-1]])
    c = x[picked]
    for _ in range(ITERATIONS):
        at = np.argmax(x @ c.T, axis=1)
        c = np.stack([x[at == i].sum(axis=0) if (at == i).any() else c[i] for i in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-30)
    return c, np.argmax(x @ c.T, axis=1)


class Tree:
    def __init__(self, sample: np.ndarray):
        self.leaves = 0
        self.root = self._grow(sample)

    def _grow(self, x: np.ndarray) -> Node:
        if len(x) > LEAF:
            c, at = _split(x)
            used = np.unique(at)
            if len(used) > 1:
                return Node(centres=c[used], children=[self._grow(x[at == i]) for i in used])
        self.leaves += 1
        return Node(leaf=self.leaves - 1)

    def assign(self, x: np.ndarray) -> np.ndarray:
        """Leaf of every row."""
        out = np.empty(len(x), np.int32)

        def down(node: Node, rows: np.ndarray) -> None:
            if not rows.size:
                return
            if node.centres is None:
                out[rows] = node.leaf
                return
            at = np.argmax(x[rows] @ node.centres.T, axis=1)
            for i, child in enumerate(node.children):
                down(child, rows[at == i])

        down(self.root, np.arange(len(x)))
        return out

    def visit(self, q: np.ndarray):
        """Leaves of one query, best bin first."""
        heap, n = [(-1.0, 0, self.root)], 0
        while heap:
            _, _, node = heapq.heappop(heap)
            while node.centres is not None:
                cos = node.centres @ q
                best = int(np.argmax(cos))
                for i, child in enumerate(node.children):
                    if i != best:
                        n += 1
                        heapq.heappush(heap, (-float(cos[i]), n, child))
                node = node.children[best]
            yield node.leaf

    def leaves_for(self, q: np.ndarray, visits: int, sizes: np.ndarray, least: int) -> list[int]:
        got, met = [], 0
        for leaf in self.visit(q):
            got.append(leaf)
            met += sizes[leaf]
            if len(got) >= visits and met >= least:
                break
        return got


def _matrix(col: pa.Array) -> np.ndarray:
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(col), -1) if len(col) else flat.reshape(0, 0)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True) if len(x) else x


def usable(vector: str) -> Column:
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0)


def _best(ids: np.ndarray, groups: pd.DataFrame, q: np.ndarray, x: np.ndarray, k: int) -> pd.DataFrame:
    """k nearest ids of every query among entries x with id lists groups['ids'], without the query's own id."""
    qn, xn = np.linalg.norm(q, axis=1), np.linalg.norm(x, axis=1)
    lists = groups["ids"].tolist()
    out = []
    for a in range(0, len(q), QUERY_BLOCK):
        cos = (q[a: a + QUERY_BLOCK] @ x.T) / (qn[a: a + QUERY_BLOCK, None] * xn[None, :])
        # an entry may hold only the query's own id, so one more is looked at; equal scores all stay
        cut = np.partition(cos, max(0, cos.shape[1] - k - 1), axis=1)[:, max(0, cos.shape[1] - k - 1)] - 2 * 10.0 ** -DIGITS
        for i in range(len(cos)):
            own = ids[a + i]
            found = [(-round(float(cos[i, j]), DIGITS), v, cos[i, j]) for j in np.flatnonzero(cos[i] >= cut[i]) for v in lists[j] if v != own]
            for _, v, s in sorted(found)[:k]:
                out.append((own, v, s))
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])


def _top(df: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc(F.round("score", DIGITS)), "vec_id")
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def search(df: DataFrame, queries: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest rows found for every row where ``queries`` holds."""
    spark = df.sparkSession
    vectors = saved(df.where(usable(vector) & F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), queries.alias("q")).distinct(), "vectors")
    out = "query_id long, vec_id long, score double"
    n = vectors.count()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    share = min(1.0, SAMPLE / n)
    draw = F.pmod(F.xxhash64("id"), F.lit(1_000_003)) < F.lit(int(share * 1_000_003) + 1)
    picked = vectors.where(draw).select("v").distinct().orderBy("v").limit(2 * SAMPLE).toArrow()  # expected SAMPLE rows
    tree = Tree(_unit(_matrix(picked.column(0).combine_chunks())))
    # the tree (at most SAMPLE vectors) is shipped with the functions that use it

    # entries: one per distinct vector, with its smallest ids
    w = Window.partitionBy("v").orderBy("id")
    entries = (vectors.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k + 1)
               .groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")))  # at most k + 1 ids

    def assign(batches):
        for batch in batches:
            x = _unit(_matrix(batch.column(0)))
            leaf = tree.assign(x) if len(x) else np.empty(0, np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int32())], names=["v", "ids", "leaf"])

    index = saved(entries.mapInArrow(assign, "v array<double>, ids array<long>, leaf int"), "index")
    sizes, met = np.zeros(tree.leaves, np.int64), np.zeros(tree.leaves, np.int64)
    for r in index.groupBy("leaf").agg(F.count("*").alias("n"), F.sum(F.size("ids")).alias("m")).collect():
        sizes[r["leaf"]], met[r["leaf"]] = r["n"], r["m"]
    visits = _calibrate(vectors, index, tree, k)

    # leaves of every query; a large leaf is cut into blocks, and so are the queries that meet it
    blocks = -(-sizes // BLOCK_ROWS)

    def route(batches):
        for batch in batches:
            x = _unit(_matrix(batch.column(1)))
            rows, leaf, block = [], [], []
            for i in range(len(x)):
                for f in tree.leaves_for(x[i], visits, met, k + 1):
                    for b in range(blocks[f]):
                        rows.append(i)
                        leaf.append(f)
                        block.append(b)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), batch.column(1).take(pa.array(rows, pa.int64())),
                                              pa.array(leaf, pa.int32()), pa.array(block, pa.int32())], names=["id", "v", "leaf", "block"])

    routed = saved(vectors.where("q").select("id", "v").mapInArrow(route, "id long, v array<double>, leaf int, block int"), "routed")
    per = routed.groupBy("leaf", "block").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("q_blocks"))
    left = routed.join(per, ["leaf", "block"]).select("leaf", "block", F.pmod(F.xxhash64("id"), F.col("q_blocks")).cast("int").alias("q_block"), "id", "v")
    own = F.element_at(F.lit(blocks.tolist()).cast("array<bigint>"), F.col("leaf") + 1)
    right = (index.withColumn("block", F.pmod(F.xxhash64("v"), own).cast("int")).join(per, ["leaf", "block"])
             .withColumn("q_block", F.explode(F.sequence(F.lit(0), F.col("q_blocks") - 1))).select("leaf", "block", "q_block", "v", "ids"))

    def score(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        return _best(a["id"].to_numpy(), b, np.stack(a["v"].to_numpy()), np.stack(b["v"].to_numpy()), k)

    at = ["leaf", "block", "q_block"]
    found = left.groupBy(*at).cogroup(right.groupBy(*at)).applyInPandas(score, out)
    return _top(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _calibrate(vectors: DataFrame, index: DataFrame, tree: Tree, k: int) -> int:
    """Leaves to visit so that RECALL of the exact neighbours of some queries lie in them."""
    asked = vectors.where("q").orderBy(F.xxhash64("id"), "id").limit(CALIBRATION).select("id", "v").toArrow()
    if not asked.num_rows:
        return 1
    ids, q = asked.column(0).to_numpy(), _matrix(asked.column(1).combine_chunks())

    def exact(batches):
        for batch in batches:
            b = batch.to_pandas()
            if not len(b):
                continue
            got = _best(ids, b, q, _matrix(batch.column(0)), k)
            leaf = {v: f for vs, f in zip(b["ids"].tolist(), b["leaf"].tolist()) for v in vs}
            got["leaf"] = [leaf[v] for v in got["vec_id"]]
            yield pa.RecordBatch.from_pandas(got, preserve_index=False, schema=pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64()), ("leaf", pa.int32())]))

    true = _top(index.mapInArrow(exact, "query_id long, vec_id long, score double, leaf int"), k).select("query_id", "leaf").toPandas()
    place = {int(i): {f: n for n, f in enumerate(tree.visit(u))} for i, u in zip(ids, _unit(q))}
    need = np.sort([place[int(i)][f] + 1 for i, f in zip(true["query_id"], true["leaf"])]) if len(true) else np.array([1])
    return int(need[min(len(need) - 1, int(np.ceil(RECALL * len(need))) - 1)])
