from sitelens.operators.keywords import (expand_keywords, keyword_preview, keyword_probes,
                                         parse_payloads, suggest)


def test_probes(spark):
    seeds = spark.createDataFrame([("scarpe da lavoro",)], "seed string")
    rows = keyword_probes(seeds).collect()
    assert len(rows) == 27
    qs = {r["query"] for r in rows}
    assert "scarpe da lavoro" in qs and "scarpe da lavoro a" in qs and "scarpe da lavoro z" in qs


def test_payloads(spark):
    p = spark.createDataFrame([("s", "q", '["q",["a","b"]]'), ("s", "q", '["q",["b"]]'),
                               ("s", "q", "not json"), ("s", "q", '["q"]'), ("s", "q", '{"1": ["z"]}'),
                               ("s", "q", '["q", 5]'), ("s", "q", '["q", {"k1": 1, "k2": 2}]'),
                               ("s", "q", '["q", "cd"]')],
                              "seed string, query string, payload string")
    got = sorted(r["Keyword"] for r in expand_keywords(parse_payloads(p)).collect())
    assert got == ["a", "b", "c", "d", "k1", "k2"]


def test_suggest_prefix_topn(spark):
    seeds = spark.createDataFrame([("red",)], "seed string")
    corpus = spark.createDataFrame(
        [("red apple", 5), ("red ant", 1), ("redwood", 3), ("blue sky", 9), ("red axe", 5)],
        "keyword string, popularity long")
    s = suggest(keyword_probes(seeds), corpus, top_n=2).collect()
    by = {}
    for r in s:
        by.setdefault(r["query"], []).append((r["rank"], r["suggestion"]))
    assert sorted(by["red"]) == [(1, "red apple"), (2, "red axe")]
    assert sorted(by["red a"]) == [(1, "red apple"), (2, "red axe")]
    assert "red b" not in by
    kws = expand_keywords(suggest(keyword_probes(seeds), corpus, top_n=10))
    assert sorted(r["Keyword"] for r in keyword_preview(kws, 3).collect()) == ["red ant", "red apple", "red axe"]


def test_suggest_all_matches(spark):
    seeds = spark.createDataFrame([("red",)], "seed string")
    corpus = spark.createDataFrame([(f"red w{i}", i) for i in range(25)] + [("blue x", 1)],
                                   "keyword string, popularity long")
    kws = expand_keywords(suggest(keyword_probes(seeds), corpus, top_n=None))
    assert kws.count() == 25


def test_alphabet_plan_equals_probe_plan(spark):
    from sitelens.operators.keywords import suggest_alphabet
    seeds = spark.createDataFrame([("red",), ("redw",), ("scarpe da lavoro",), ("red",)], "seed string")
    words = ["red apple", "red Apple", "redwood", "redwood x", "red  ant", "red a", "red", "red 1x",
             "scarpe da lavoro estive", "scarpe da lavoro", "scarpe da lavoroX", "blue sky", "re"]
    corpus = spark.createDataFrame([(w, len(w) % 3) for w in words], "keyword string, popularity long")

    def rows(df):
        return sorted(tuple(r) for r in df.select("seed", "query", "suggestion", "rank").collect())
    for n in (2, None):
        a = suggest_alphabet(seeds, corpus, top_n=n)
        b = suggest(keyword_probes(seeds.distinct()), corpus, top_n=n)
        assert rows(a) == rows(b)


def test_hot_prefix_salting_is_exact(spark):
    from sitelens.operators.keywords import suggest_alphabet
    seeds = spark.createDataFrame([("red",), ("blue",)], "seed string")
    words = [f"red {chr(97 + i % 26)}{i}" for i in range(300)] + ["blue sky", "blue sea"]
    corpus = spark.createDataFrame([(w, i % 7) for i, w in enumerate(words)], "keyword string, popularity long")

    def rows(df):
        return sorted(tuple(r) for r in df.collect())
    plain = rows(suggest_alphabet(seeds, corpus, top_n=3))
    salted = rows(suggest_alphabet(seeds, corpus, top_n=3, rows_per_task=10))   # "red" is hot
    assert plain == salted and len(plain) > 0
    assert rows(suggest(keyword_probes(seeds), corpus, top_n=3, rows_per_task=10)) == plain
