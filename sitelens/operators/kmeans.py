"""K-Means of sparse rows as Spark joins.

Rows are ``(doc_id, term_id, w)`` with whole-number weights, centroids
``(term_id, [(slot, m)])`` with whole-number means; a slot is a start and one of
its clusters.  Everything a comparison rests on is a whole number, so labels do
not depend on the number of partitions, the order of rows or the order of sums.
All starts run together: a round is one join of rows and centroids on the term,
an aggregation per row, and a written table of labels.

The driver holds sizes, norms and costs (one number a slot) and nothing that
grows with rows or terms.  A term held by many rows is dealt over salts by its
number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.ranking import with_position
from ..plans.skew import ROWS_PER_TASK, salt_of, spread_join
from ..session import written

GRID = 1 << 20              # a weight of 1
HASH_DIGITS = 13            # of a digest, 52 bits


def vocabulary(tf: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(term, term_id, df, salts) from ``tf`` (doc_id, term, n): dense ids in term order.

    ``n`` says how many equal documents the row stands for; ``df`` counts them.
    """
    terms = tf.groupBy("term").agg(F.sum("n").alias("df"), F.ceil(F.count("*") / rows_per_task).cast("int").alias("salts"))
    return with_position(terms, ["term"], "term_id", spread_ties=False)


def unit_rows(tf: DataFrame, docs: int) -> DataFrame:
    """(doc_id, term_id, salt, weight, w) from ``tf`` (doc_id, term, tf, n): L2-normalised smoothed TF-IDF.

    ``weight`` is a double, ``w`` the same in whole steps of 1 / GRID.
    """
    vocab = written(vocabulary(tf), "vocabulary")
    idf = F.log((1.0 + docs) / (1.0 + F.col("df"))) + 1.0
    raw = written(spread_join(tf, vocab, ["term"], "doc_id").select("doc_id", "term", "term_id", "salts", (F.col("tf") * idf).alias("raw")), "weights")
    norms = raw.groupBy("doc_id").agg(F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("norm"))
    weight = F.col("raw") / F.col("norm")
    return raw.join(norms, "doc_id").select("doc_id", "term", "term_id", salt_of(F.col("doc_id"), F.col("salts")).alias("salt"), "salts",
                                            weight.alias("weight"), F.round(weight * GRID).cast("long").alias("w"))


def _race(seed: int, start: Column, turn: int, name: Column, chance: Column) -> Column:
    """The smallest of these is a draw by chance: -ln(u) / chance, u from a digest of the name."""
    digits = F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), start.cast("string"), F.lit(str(turn)), name).cast("binary")), 1, HASH_DIGITS)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << (4 * HASH_DIGITS))
    return -F.log(u) / chance


def _products(rows: DataFrame, centroids: DataFrame) -> DataFrame:
    """(doc_id, slot, dot) of every row and every slot that share a term.

    Rows are dealt by doc_id once; all further steps of a row stay in its task.
    """
    spread = centroids.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    hits = rows.join(spread, ["term_id", "salt"]).repartition("doc_id")
    return (hits.select("doc_id", F.col("w"), F.explode("slots").alias("s"))
            .groupBy("doc_id", F.col("s.slot").alias("slot")).agg(F.sum(F.col("w") * F.col("s.m")).alias("dot")))


class KMeans:
    """K-Means of ``docs`` (doc_id, name, n) and ``rows`` (doc_id, term_id, salt, salts, w).

    ``name`` identifies a document in draws and ties, ``n`` is its weight.
    Seeding is k-means++ with draws by digests of (seed, start, turn, name).  A start
    with fewer distinct documents than k has fewer clusters; a cluster that
    loses its last document keeps its centroid.  Ties go to the lower cluster.
    """

    def __init__(self, docs: DataFrame, rows: DataFrame, k: int, starts: int, max_iter: int, seed: int):
        self.rows, self.k, self.starts, self.max_iter, self.seed = rows, k, starts, max_iter, seed
        self.slots = k * starts
        self.lengths = written(rows.groupBy("doc_id").agg(F.sum(F.col("w") * F.col("w")).alias("x2")), "lengths")
        self.base = written(docs.join(self.lengths, "doc_id", "left").select("doc_id", "name", "n", F.coalesce("x2", F.lit(0)).alias("x2")), "documents")

    # -- seeding ---------------------------------------------------------------

    def _drawn(self, table: DataFrame, turn: int) -> list[tuple[int, int]]:
        """(start, doc_id) drawn this turn by d2 (an array, one number a start)."""
        each = table.select("doc_id", "name", "n", F.posexplode("d2").alias("start", "d")).where("d > 0")
        race = F.struct(_race(self.seed, F.col("start"), turn, F.col("name"), F.col("n") * F.col("d").cast("double")).alias("r"), "name", "doc_id")
        got = each.groupBy("start").agg(F.min(race).alias("best")).collect()     # one row a start
        return sorted((r["start"], r["best"]["doc_id"]) for r in got)

    def seeds(self) -> DataFrame:
        """(term_id, salts, slots): the drawn documents as first centroids; their slots are kept in ``self.alive``."""
        table = self.base.withColumn("d2", F.array_repeat(F.lit(1).cast("long"), self.starts))
        chosen: list[tuple[int, int]] = []      # (slot, doc_id), at most k * starts
        for turn in range(self.k):
            new = [(s * self.k + turn, d) for s, d in self._drawn(table, turn)]
            if not new:
                break
            chosen += new
            if turn + 1 < self.k:
                table = written(self._nearer(table, new, first=turn == 0), "distances")
        self.alive = sorted(s for s, _ in chosen)
        return self._centroids_of(chosen)

    def _centroids_of(self, chosen: list[tuple[int, int]]) -> DataFrame:
        pick = self.base.sparkSession.createDataFrame(chosen, "slot int, doc_id long")
        return (self.rows.join(F.broadcast(pick), "doc_id").groupBy("term_id", "salts")
                .agg(F.collect_list(F.struct("slot", F.col("w").alias("m"))).alias("slots")))

    def _nearer(self, table: DataFrame, new: list[tuple[int, int]], first: bool) -> DataFrame:
        """table with d2, the squared distance to the nearest centre of each start, after these new ones."""
        norms = {r["doc_id"]: r["x2"] for r in self.base.where(F.col("doc_id").isin([d for _, d in new])).select("doc_id", "x2").collect()}
        of_start = {s // self.k: norms[d] for s, d in new}
        norm = F.array(*[F.lit(of_start.get(s)).cast("long") for s in range(self.starts)])
        dots = _products(self.rows, self._centroids_of(new)).groupBy("doc_id").agg(
            F.map_from_entries(F.collect_list(F.struct(F.floor(F.col("slot") / self.k).cast("int").alias("start"), "dot"))).alias("dots"))
        far = F.transform(norm, lambda c, s: F.col("x2") + c - 2 * F.coalesce(F.col("dots")[s], F.lit(0).cast("long")))
        old = F.transform("d2", lambda d: F.lit(None).cast("long")) if first else F.col("d2")
        least = F.zip_with(old, far, lambda a, b: F.least(a, b))     # nulls are skipped
        return table.join(dots, "doc_id", "left").select("doc_id", "name", "n", "x2", F.transform(least, lambda d: F.greatest(d, F.lit(0).cast("long"))).alias("d2"))

    # -- rounds ----------------------------------------------------------------

    def _norms(self, centroids: DataFrame) -> list[int | None]:
        """Squared length of every slot's centroid; null for slots without one."""
        got = {r["slot"]: r["v"] for r in centroids.select(F.explode("slots").alias("s")).groupBy(F.col("s.slot").alias("slot"))
               .agg(F.sum(F.col("s.m") * F.col("s.m")).alias("v")).collect()}
        return [got.get(s, 0) if s in set(self.alive) else None for s in range(self.slots)]

    def labelled(self, centroids: DataFrame) -> DataFrame:
        """(doc_id, n, labels, costs): nearest cluster and squared distance, one entry a start."""
        norms = self._norms(centroids)
        # a document shares no term with most clusters: of those the shortest centroid is nearest
        rest = [min(((v, i) for i, v in enumerate(norms[s * self.k: (s + 1) * self.k]) if v is not None), default=(0, 0)) for s in range(self.starts)]
        default = F.array(*[F.struct(F.lit(v).cast("long").alias("score"), F.lit(i).alias("cluster")) for v, i in rest])
        norm = F.array(*[F.lit(v).cast("long") for v in norms])
        start = F.floor(F.col("slot") / self.k).cast("int")
        score = F.struct((F.get(norm, F.col("slot")) - 2 * F.col("dot")).alias("score"), (F.col("slot") % self.k).alias("cluster"))
        best = (_products(self.rows, centroids).select("doc_id", start.alias("start"), score.alias("s"))
                .groupBy("doc_id", "start").agg(F.min("s").alias("s"))
                .groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("start", "s"))).alias("best")))
        got = self.base.join(best, "doc_id", "left").withColumn("s", F.transform(default, lambda d, i: F.least(d, F.coalesce(F.col("best")[i], d))))
        return got.select("doc_id", "n", F.transform("s", lambda x: x["cluster"]).alias("labels"), F.transform("s", lambda x: x["score"] + F.col("x2")).alias("costs"))

    def members(self, labels: DataFrame) -> dict[int, tuple[int, int, int]]:
        """Per slot its size and two sums that stand for who is in it: equal ones mean equal labels."""
        h = F.xxhash64("doc_id", "start", "c")
        return {r["slot"]: (r["n"], r["x"], r["y"]) for r in labels.select("doc_id", "n", F.posexplode("labels").alias("start", "c"))
                .groupBy((F.col("start") * self.k + F.col("c")).alias("slot"))
                .agg(F.sum("n").alias("n"), F.bit_xor(h).alias("x"), F.sum(F.pmod(h, F.lit(1_000_003))).alias("y")).collect()}

    def moved(self, labels: DataFrame, centroids: DataFrame, sizes: dict[int, int]) -> DataFrame:
        """Centroids of labelled documents, rounded to whole numbers."""
        size = F.array(*[F.lit(sizes.get(s)).cast("long") for s in range(self.slots)])
        sums = (self.rows.join(labels, "doc_id").select("term_id", "salts", (F.col("w") * F.col("n")).alias("v"), F.posexplode("labels").alias("start", "c"))
                .groupBy("term_id", "salts", (F.col("start") * self.k + F.col("c")).cast("int").alias("slot")).agg(F.sum("v").alias("v")))
        n = F.get(size, F.col("slot"))
        each = sums.select("term_id", "salts", "slot", "v", n.alias("n")).withColumn("m", F.expr("(2 * v + n) DIV (2 * n)")).where("m > 0")
        lost = [s for s in self.alive if s not in sizes]
        if lost:
            old = centroids.select("term_id", "salts", F.explode("slots").alias("s")).where(F.col("s.slot").isin(lost))
            each = each.select("term_id", "salts", "slot", "m").unionByName(old.select("term_id", "salts", F.col("s.slot").alias("slot"), F.col("s.m").alias("m")))
        return each.groupBy("term_id", "salts").agg(F.collect_list(F.struct("slot", "m")).alias("slots"))

    def fit(self) -> tuple[DataFrame, DataFrame, int]:
        """(labels, centroids, best start): the start of the lowest cost, then the lowest number."""
        centroids = written(self.seeds(), "centroids")
        labels, was = written(self.labelled(centroids), "labels"), None
        for _ in range(self.max_iter):
            now = self.members(labels)
            if now == was:
                break
            was = now
            centroids = written(self.moved(labels, centroids, {s: m[0] for s, m in now.items()}), "centroids")
            labels = written(self.labelled(centroids), "labels")
        costs = labels.agg(*[F.sum(F.col("costs")[s].cast("decimal(38,0)") * F.col("n")).alias(str(s)) for s in range(self.starts)]).first()
        best = min(range(self.starts), key=lambda s: (costs[s] or 0, s)) if self.starts else 0
        return labels, centroids, best
