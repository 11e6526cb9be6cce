from pyspark.sql import functions as F

from sitelens.operators.clustering import (clamp_k, cluster_keywords, cluster_names, theme_preview,
                                           tfidf_long)

WORDS = ["guanti da lavoro", "guanti da lavoro in pelle", "guanti nitrile", "guanti nitrile neri",
         "scarpe antinfortunistiche", "scarpe antinfortunistiche basse", "scarpe da lavoro",
         "scarpe da lavoro estive", "casco cantiere", "casco cantiere bianco", "casco protettivo",
         "occhiali protettivi", "occhiali di sicurezza", "occhiali antiappannamento"]


def test_clamp():
    assert [clamp_k(7, n) for n in (3, 9, 30)] == [2, 3, 7]


def test_tfidf_matches_formula(spark):
    import math
    docs = spark.createDataFrame([(1, "a1 b2"), (2, "a1"), (3, "c3 C3")], "doc_id long, Keyword string")
    w = {(r["doc_id"], r["term"]): r["weight"] for r in tfidf_long(docs).collect()}
    idf = lambda df: math.log(4 / (1 + df)) + 1
    raw = {"a1": idf(2), "b2": idf(1), "a1 b2": idf(1)}
    norm = math.sqrt(sum(v * v for v in raw.values()))
    assert abs(w[(1, "a1")] - raw["a1"] / norm) < 1e-12
    assert abs(w[(2, "a1")] - 1.0) < 1e-12
    assert abs(w[(3, "c3")] - 2 * idf(1) / math.sqrt((2 * idf(1)) ** 2 + idf(1) ** 2)) < 1e-12


def test_cluster_properties(spark):
    df = spark.createDataFrame([(w,) for w in WORDS] + [(None,)], "Keyword string")
    out = cluster_keywords(df, k=4, n_init=3).collect()
    assert len(out) == len(WORDS)                       # null dropped, every row labelled
    ids = {r["Cluster_ID"] for r in out}
    assert ids == set(range(len(ids))) and 2 <= len(ids) <= 4
    assert all(r["Tema_Semantico"] and r["Tema_Semantico"] == r["Tema_Semantico"].upper() for r in out)
    again = cluster_keywords(df, k=4, n_init=3).collect()
    assert sorted((r["Keyword"], r["Cluster_ID"]) for r in out) == \
        sorted((r["Keyword"], r["Cluster_ID"]) for r in again)


def test_names_and_preview(spark):
    docs = spark.createDataFrame([(i, w) for i, w in enumerate(WORDS)], "doc_id long, Keyword string")
    asg = docs.select("doc_id", F.when(F.col("Keyword").startswith("guanti"), 0).otherwise(1).alias("Cluster_ID"))
    names = {r["Cluster_ID"]: r["Tema_Semantico"] for r in cluster_names(tfidf_long(docs), asg).collect()}
    assert names[0].startswith("GUANTI")
    clustered = docs.join(asg, "doc_id").join(cluster_names(tfidf_long(docs), asg), "Cluster_ID")
    prev = {r["Tema_Semantico"]: r for r in theme_preview(clustered).collect()}
    g = prev[names[0]]
    assert (g["n_keywords"], g["more"]) == (4, False)
    assert g["preview"] == "guanti da lavoro, guanti da lavoro in pelle, guanti nitrile, guanti nitrile neri"


def fitted(spark, words, k, n_init, seed=7):
    """(labels per start, cost per start, best start), from the K-Means itself."""
    from sitelens.operators.clustering import terms_of
    from sitelens.operators.kmeans import KMeans, unit_rows
    docs = spark.createDataFrame([(i, w, 1) for i, w in enumerate(words)], "doc_id long, name string, n long")
    tf = (docs.select("doc_id", "n", F.explode(terms_of(F.col("name"))).alias("term")).groupBy("doc_id", "n", "term").agg(F.count("*").alias("tf")))
    rows = unit_rows(tf, len(words)).cache()
    labels, _, best = KMeans(docs, rows, k, n_init, 300, seed).fit()
    got = sorted(labels.collect(), key=lambda r: r.doc_id)
    x = {}
    for r in rows.collect():
        x.setdefault(r.doc_id, {})[r.term_id] = r.w
    return [r.labels for r in got], [r.costs for r in got], best, x


def test_best_of_n_cost_and_order_invariance(spark):
    _, costs, best, _ = fitted(spark, WORDS, 4, 4)
    sums = [sum(c[s] for c in costs) for s in range(4)]
    assert best == min(range(4), key=lambda s: (sums[s], s))
    a = cluster_keywords(spark.createDataFrame([(w,) for w in WORDS], "Keyword string"), k=4, n_init=3).collect()
    shuffled = spark.createDataFrame([(w,) for w in reversed(WORDS)], "Keyword string").repartition(3)
    b = cluster_keywords(shuffled, k=4, n_init=3).collect()
    assert sorted((r["Keyword"], r["Cluster_ID"], r["Tema_Semantico"]) for r in a) == \
        sorted((r["Keyword"], r["Cluster_ID"], r["Tema_Semantico"]) for r in b)


def test_kmeans_ends_at_a_fixed_point(spark):
    """Every label is the nearest of the means of the labels, and every cost the distance to it."""
    words = WORDS + ["!", "? ?"]                # two documents without a term
    labels, costs, _, x = fitted(spark, words, 4, 3)
    for s in range(3):
        members = {}
        for d, lab in enumerate(labels):
            members.setdefault(lab[s], []).append(d)
        assert 1 < len(members) <= 4
        means = {}
        for c, ds in members.items():
            terms = {t for d in ds for t in x.get(d, {})}
            means[c] = {t: (2 * sum(x.get(d, {}).get(t, 0) for d in ds) + len(ds)) // (2 * len(ds)) for t in terms}
        for d in range(len(words)):
            row = x.get(d, {})
            far = {c: sum((row.get(t, 0) - m.get(t, 0)) ** 2 for t in {*row, *m}) for c, m in means.items()}
            assert labels[d][s] == min(far, key=lambda c: (far[c], c)) and costs[d][s] == far[labels[d][s]]


def test_labels_do_not_depend_on_partitions(spark):
    df = spark.createDataFrame([(w,) for w in WORDS + WORDS[:5]], "Keyword string")
    was, out = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in ("4", "61"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            out.append(sorted(tuple(r) for r in cluster_keywords(df, k=4, n_init=2).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    assert out[0] == out[1] and len(out[0]) == len(WORDS) + 5


def test_fewer_distinct_keywords_than_clusters_and_none(spark):
    same = cluster_keywords(spark.createDataFrame([("aa bb",)] * 9, "Keyword string"), k=3, n_init=2).collect()
    assert [tuple(r) for r in same] == [("aa bb", 0, "BB - AA BB")] * 9 or {r.Cluster_ID for r in same} == {0}
    assert cluster_keywords(spark.createDataFrame([], "Keyword string"), n_init=2).count() == 0
    assert cluster_keywords(spark.createDataFrame([("!",), ("?",)], "Keyword string"), n_init=2).count() == 2


def test_preview_of_five_shows_four_and_more(spark):
    rows = [(f"scarpe {w}", "SCARPE - X") for w in ("a1", "b2", "c3", "d4", "e5")] + [("casco z9", "CASCO - Z")]
    df = spark.createDataFrame(rows, "Keyword string, Tema_Semantico string")
    prev = {r["Tema_Semantico"]: r for r in theme_preview(df).collect()}
    s = prev["SCARPE - X"]
    assert (s["n_keywords"], s["more"]) == (5, True)
    assert s["preview"] == "scarpe a1, scarpe b2, scarpe c3, scarpe d4"
    assert (prev["CASCO - Z"]["n_keywords"], prev["CASCO - Z"]["more"]) == (1, False)


def test_keyword_column_required(spark):
    import pytest
    with pytest.raises(ValueError, match="Keyword"):
        cluster_keywords(spark.createDataFrame([("x",)], "kw string"))
