"""Long-tail keyword expansion.

``keyword_probes``: each seed becomes 27 probe queries (the seed, then the
seed followed by each letter a-z).  ``suggest`` answers probes from a keyword
corpus with a prefix-completion join (re-aiming the remote suggestion
service); ``parse_payloads`` reads captured suggestion responses instead.
``expand_keywords`` is the union of the answers per seed, distinct.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.skew import ROWS_PER_TASK, skew_join

# Probe suffixes (none, then the 26 lowercase letters).
LETTERS = tuple(string.ascii_lowercase)
PREVIEW_N = 30


def keyword_probes(seeds: DataFrame, seed_col: str = "seed") -> DataFrame:
    """(seed, letter, query): the bare seed plus seed + ' ' + letter."""
    suffixes = F.array(F.lit(None).cast("string"), *[F.lit(c) for c in LETTERS])
    return (seeds.select(F.col(seed_col).alias("seed"), F.explode(suffixes).alias("letter"))
            .select("seed", "letter", F.concat_ws(" ", "seed", "letter").alias("query")))


def suggest(probes: DataFrame, corpus: DataFrame, top_n: int | None = None,
            rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Top-``top_n`` corpus keywords (by popularity, then text) starting with each query.

    Every match is returned (rank null) unless the caller asks for the first
    ``top_n`` of a query.

    ``probes``: seed, query.  ``corpus``: keyword, popularity.
    Prefix matching as an exact equi-join: the corpus is keyed by its prefix
    at each distinct query length (a handful: seeds are few, lengths are
    bounded by the longest query), so only true matches are paired.  The
    join is a ``skew_join``: a prefix shared by a large share of the corpus
    is spread over as many tasks as its size needs (the probe rows of that
    prefix are replicated); the per-probe top-n is a ``row_number`` filter
    that Spark plans as a partial WindowGroupLimit before the shuffle.
    """
    q = probes.select("seed", "query").withColumn("qlen", F.length("query"))
    lengths = sorted(r[0] for r in q.select("qlen").distinct().collect() if r[0] is not None)
    if not lengths:
        return q.select("seed", "query", F.lit(None).cast("string").alias("suggestion"),
                        F.lit(None).cast("int").alias("rank")).limit(0)
    keyed = (corpus.select("keyword", "popularity")
             .withColumn("qlen", F.explode(F.array(*[F.lit(n) for n in lengths])))
             .filter(F.col("qlen") <= F.length("keyword"))
             .withColumn("query", F.expr("substring(keyword, 1, qlen)")))
    hits = skew_join(keyed, q, ["qlen", "query"], spread_by="keyword", rows_per_task=rows_per_task)
    if top_n is None:    # every match; no per-probe ranking needed
        return hits.select("seed", "query", F.col("keyword").alias("suggestion"),
                           F.lit(None).cast("int").alias("rank"))
    w = Window.partitionBy("seed", "query").orderBy(F.desc("popularity"), F.asc("keyword"))
    return (hits.withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= top_n)
            .select("seed", "query", F.col("keyword").alias("suggestion"), "rank"))


def suggest_alphabet(seeds: DataFrame, corpus: DataFrame, top_n: int | None = None,
                     rows_per_task: int = ROWS_PER_TASK, seed_col: str = "seed") -> DataFrame:
    """``suggest`` for the alphabet probes of ``keyword_probes``, without
    materialising the probes.

    A keyword that starts with a seed answers the bare-seed probe, and also
    the probe ``seed + " " + c`` when it continues with a space and the
    letter ``c``.  So the corpus is keyed by its prefix at each distinct
    *seed* length (half the keys of the general form), joined to the seeds,
    and each match yields its one or two probes -- exact, with no 27-way
    fan-out of candidates.  Same output as
    ``suggest(keyword_probes(seeds), corpus, top_n)``.
    """
    sd = (seeds.select(F.col(seed_col).alias("seed")).distinct()
          .withColumn("slen", F.length("seed")))
    lengths = sorted(r[0] for r in sd.select("slen").distinct().collect() if r[0] is not None)
    if not lengths:
        return sd.select("seed", F.lit(None).cast("string").alias("query"),
                         F.lit(None).cast("string").alias("suggestion"),
                         F.lit(None).cast("int").alias("rank")).limit(0)
    keyed = (corpus.select("keyword", "popularity")
             .withColumn("slen", F.explode(F.array(*[F.lit(n) for n in lengths])))
             .filter(F.col("slen") <= F.length("keyword"))
             .withColumn("seed", F.expr("substring(keyword, 1, slen)")))
    hits = skew_join(keyed, sd, ["slen", "seed"], spread_by="keyword", rows_per_task=rows_per_task)
    after = F.expr("substring(keyword, slen + 1, 1)")
    letter = F.expr("substring(keyword, slen + 2, 1)")
    lettered = (after == " ") & letter.isin(*LETTERS)
    queries = F.array_compact(F.array(F.col("seed"),
                                      F.when(lettered, F.concat_ws(" ", F.col("seed"), letter))))
    hits = hits.select("seed", F.explode(queries).alias("query"), "keyword", "popularity")
    if top_n is None:
        return hits.select("seed", "query", F.col("keyword").alias("suggestion"),
                           F.lit(None).cast("int").alias("rank"))
    w = Window.partitionBy("seed", "query").orderBy(F.desc("popularity"), F.asc("keyword"))
    return (hits.withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= top_n)
            .select("seed", "query", F.col("keyword").alias("suggestion"), "rank"))


def parse_payloads(payloads: DataFrame) -> DataFrame:
    """(seed, query, suggestion) from captured responses ``[query, [s1, s2, ...], ...]``.

    Element 1 is iterated: a list gives its items, a string its characters,
    an object its keys; anything else (bad JSON, too short, a number) gives
    nothing.
    """
    v = F.try_parse_json(F.col("payload"))
    second = F.try_variant_get(v, "$[1]", "variant")
    kind = F.schema_of_variant(second)
    items = (F.when(kind.startswith("ARRAY"), F.try_variant_get(second, "$", "array<string>"))
             .when(kind == "STRING", F.filter(F.split(F.try_variant_get(second, "$", "string"), "", -1),
                                             lambda ch: ch != ""))
             .when(kind.startswith("OBJECT"),      # iterating a dict yields its keys
                   F.map_keys(F.try_variant_get(second, "$", "map<string,variant>"))))
    return (payloads.select("seed", "query", F.explode(items).alias("suggestion"))
            .filter(F.col("suggestion").isNotNull()))


def expand_keywords(suggestions: DataFrame) -> DataFrame:
    """(seed, Keyword): distinct suggestions per seed."""
    return suggestions.select("seed", F.col("suggestion").alias("Keyword")).distinct()


def keyword_preview(keywords: DataFrame, n: int = PREVIEW_N) -> DataFrame:
    """First ``n`` keywords per seed in code-point order (a top-k report)."""
    w = Window.partitionBy("seed").orderBy("Keyword")
    return (keywords.withColumn("pos", F.row_number().over(w))
            .filter(F.col("pos") <= n))
