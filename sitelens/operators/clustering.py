"""Keyword TF-IDF, K-Means clustering and cluster naming.

TF-IDF follows the common smoothed form: lowercase, tokens of two or more word
characters, unigrams and bigrams, ``idf = ln((1 + n) / (1 + df)) + 1``, rows
L2-normalised: a long ``(doc_id, term, weight)`` table built with explode /
group / join.  K-Means (``kmeans``) runs on it as joins, and clusters are named
from their centroids (mean member weight per term), so neither a vocabulary
nor a k x V matrix is ever held by the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.ranking import with_position
from ..plans.skew import join_group_stat, spread_join
from ..session import ensure_checkpoint_dir, written
from .kmeans import KMeans, unit_rows

# Token pattern and model settings of the original clustering.
TOKEN_PATTERN = r"(?U)\b\w\w+\b"
N_INIT = 10
RANDOM_STATE = 42
MAX_ITER = 300
TOP_TERMS = 2
THEME_SEPARATOR = " - "
PREVIEW_SIZE = 4
MIN_CLUSTERS = 2
KEYWORDS_PER_CLUSTER = 3


def clamp_k(requested: int, n: int) -> int:
    """``max(2, min(requested, n // 3))``."""
    return max(MIN_CLUSTERS, min(requested, n // KEYWORDS_PER_CLUSTER))


def terms_of(text: Column) -> Column:
    """Unigrams then bigrams of the lowercased text."""
    toks = F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), 0)
    bigrams = F.transform(F.slice(toks, 2, F.greatest(F.size(toks) - 1, F.lit(0))),
                          lambda t, i: F.concat_ws(" ", toks[i], t))
    return F.concat(toks, bigrams)


def tfidf_long(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "Keyword") -> DataFrame:
    """(doc_id, term, weight) for every non-zero weight."""
    n_docs = docs.count()
    tf = (docs.select(F.col(doc_col).alias("doc_id"), F.explode(terms_of(F.col(text_col))).alias("term"))
          .groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("tf")))
    # per-term document frequency joined back on a salted key (hot terms)
    with_df = join_group_stat(tf, ["term"], [F.count(F.lit(1)).alias("df")], spread_by="doc_id",
                              materialize=True)
    w = F.col("tf") * (F.log((1.0 + n_docs) / (1.0 + F.col("df"))) + 1.0)
    raw = with_df.select("doc_id", "term", w.alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("doc_id")))
    return raw.select("doc_id", "term", (F.col("w") / norm).alias("weight"))


def centroid_terms(weights: DataFrame, assignment: DataFrame) -> DataFrame:
    """(Cluster_ID, term, centroid): mean member weight per term.

    A member counts ``n`` times, if ``assignment`` has such a column.
    """
    n = F.col("n") if "n" in assignment.columns else F.lit(1)
    members = assignment.select("doc_id", "Cluster_ID", n.alias("_m"))
    sizes = members.groupBy("Cluster_ID").agg(F.sum("_m").alias("_n"))
    sums = (weights.join(members, "doc_id")
            .groupBy("Cluster_ID", "term").agg(F.sum(F.col("weight") * F.col("_m")).alias("_s")))
    return (sums.join(sizes, "Cluster_ID")
            .select("Cluster_ID", "term", F.round(F.col("_s") / F.col("_n"), 9).alias("centroid")))


def cluster_names(weights: DataFrame, assignment: DataFrame) -> DataFrame:
    """(Cluster_ID, Tema_Semantico): top-2 centroid terms, joined, uppercased.

    Ties in weight go to the later term in code-point order (what reversing
    an ascending sort over the alphabetical vocabulary gives).
    """
    cent = centroid_terms(weights, assignment).filter(F.col("centroid") > 0)
    w = Window.partitionBy("Cluster_ID").orderBy(F.desc("centroid"), F.desc("term"))
    top = cent.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= TOP_TERMS)
    return (top.groupBy("Cluster_ID")
            .agg(F.sort_array(F.collect_list(F.struct("_r", "term"))).alias("_t"))
            .select("Cluster_ID", F.upper(F.array_join(F.transform("_t", lambda x: x["term"]),
                                                       THEME_SEPARATOR)).alias("Tema_Semantico")))


def theme_preview(clustered: DataFrame, materialize: bool = True) -> DataFrame:
    """Per theme: keyword count, first 4 keywords (sorted), whether there are more.

    Two clusters with the same name merge here, as in the original preview.
    The count and the first-4 are two aggregations over the same rows; with
    ``materialize`` the (theme, keyword) pairs are checkpointed once so the
    clustering upstream is not computed twice.
    """
    clustered = clustered.select("Tema_Semantico", "Keyword")
    if materialize:
        ensure_checkpoint_dir(clustered.sparkSession)
        clustered = clustered.checkpoint()
    w = Window.partitionBy("Tema_Semantico").orderBy("Keyword")
    head = (clustered.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= PREVIEW_SIZE)
            .groupBy("Tema_Semantico")
            .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_r", "Keyword"))),
                                          lambda x: x["Keyword"]), ", ").alias("preview")))
    counts = clustered.groupBy("Tema_Semantico").agg(F.count(F.lit(1)).alias("n_keywords"))
    return (counts.join(head, "Tema_Semantico")
            .select("Tema_Semantico", "n_keywords", "preview",
                    (F.col("n_keywords") > PREVIEW_SIZE).alias("more")))


def cluster_keywords(keywords: DataFrame, k: int = 7, seed: int = RANDOM_STATE,
                     n_init: int = N_INIT, max_iter: int = MAX_ITER) -> DataFrame:
    """Input rows + ``Cluster_ID`` and ``Tema_Semantico``.

    Null keywords are dropped first.  Equal keywords are one document with
    their number as its weight.  Cluster ids are renumbered by each cluster's
    smallest keyword.  ``k`` is clamped to ``max(2, min(k, n // 3))``.  The
    result depends on the keywords, ``k`` and ``seed`` alone.
    """
    if "Keyword" not in keywords.columns:
        raise ValueError("the keyword table needs a 'Keyword' column")
    names = keywords.columns
    kw = written(keywords.na.drop(subset=["Keyword"]).withColumn("_row", F.monotonically_increasing_id()), "keywords")
    n = kw.count()
    k = clamp_k(k, n)
    distinct = kw.groupBy("Keyword").agg(F.count("*").alias("n"))
    docs = written(with_position(distinct, ["Keyword"], "doc_id", spread_ties=False), "keyword-documents")
    tf = (docs.select("doc_id", "n", F.explode(terms_of(F.col("Keyword"))).alias("term"))
          .groupBy("doc_id", "n", "term").agg(F.count("*").alias("tf")))
    rows = written(unit_rows(tf, n), "rows")
    labels, _, best = KMeans(docs.select("doc_id", F.col("Keyword").alias("name"), "n"), rows, k, n_init, max_iter, seed).fit()
    raw = docs.join(labels.select("doc_id", F.col("labels")[best].alias("_c")), "doc_id")
    # k rows (one per cluster): a global window here is bounded by k
    order = (raw.groupBy("_c").agg(F.min("Keyword").alias("_m"))
             .withColumn("Cluster_ID", (F.row_number().over(Window.orderBy("_m")) - 1).cast("int")))
    assignment = written(raw.join(F.broadcast(order.select("_c", "Cluster_ID")), "_c").select("doc_id", "Keyword", "n", "Cluster_ID"), "assignment")
    themes = cluster_names(rows.select("doc_id", "term", "weight"), assignment)
    of = assignment.select("Keyword", "Cluster_ID").join(F.broadcast(themes), "Cluster_ID", "left")     # themes: k rows
    return spread_join(kw, of, ["Keyword"], "_row").select(*names, "Cluster_ID", "Tema_Semantico")
