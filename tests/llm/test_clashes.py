"""Extra columns whose names an operator uses itself change nothing."""

import pytest
from pyspark.sql import functions as F

from sitelens.llm import bpe, hard_negatives, langid, licences, merkle, neighbours, packing, sharding, simhash, sketches, suffix_dedup, token_files, warc
from sitelens.llm.queries import BYTE_VOCABULARY, WORD_VOCABULARY

TEXTS = ["alpha beta gamma delta epsilon zeta", "Released under the MIT License.", None, "", "one two three four five six seven", "alpha beta gamma delta epsilon zeta"]
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

DOCUMENTS = {
    "sketches": lambda d: sketches.edited_fingerprints(d),
    "bpe": lambda d: bpe.round_trip(d, WORD_VOCABULARY),
    "langid": lambda d: langid.predict(d, langid.train(d)).select("doc_id", "text", "lang_pred", "score", "accepted"),
    "sharding": lambda d: sharding.shard_by_bytes(d.withColumn("size", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1), "size",
                                                  sharding.order_key(F.xxhash64("text"), F.col("doc_id")), shards=2).select("doc_id", "text", "shard"),
    "token_files": lambda d: token_files.count_documents(d, BYTE_VOCABULARY).select("doc_id", "n_tokens"),
    "packing": lambda d: packing.pack(packing.cut_documents(d, BYTE_VOCABULARY)).select("doc_id", "piece", "start", "length", "ids_crc32"),
    "licences": lambda d: licences.scan_files(d, F.concat(F.lit("a/"), F.col("doc_id").cast("string"))),
    "suffix_dedup": lambda d: suffix_dedup.repeat_digests(d),
    "simhash": lambda d: simhash.near_duplicates(d).select("doc_id", "fp", "component_id"),
    "merkle": lambda d: merkle.manifest(d, ["doc_id", "lang", "text"], tampered={"text": F.translate("text", UPPER, UPPER.lower())}, where=F.col("doc_id") % 3 == 0),
}
DOCUMENT_CLASHES = ("row own next at tie hash n g cut bucket closing edited ids decoded pick counts freq whole lang_pred score accepted key size shard slot range name file ordinal value kind path "
                    "piece start length gap sequence_id offset statement licence effective from_dir _row _k _dir doc gram run pos hits removed _doc fp least root node component_id a b "
                    "leaf changed uid id w p bits many total block slots steps subroot").split()
VECTORS = {
    "neighbours": lambda d: neighbours.search(d, F.col("vec_id") % 2 == 0, 2),
    "hard_negatives": lambda d: hard_negatives.mine(d, F.col("id") % 2 == 0),
}
VECTOR_CLASHES = "v q r ids leaf block q_block q_blocks met query_id score rank x n i j place other positives positive_id negative_id anchor_id place_of".split()
PAGES = {"warc": lambda d: warc.archive_pages(d).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "uri")}
PAGE_CLASHES = "v n uri body own http size value file line whole record_id address date kind payload payload_bytes payload_digest type block shared response_id holder refers_to _salt".split()


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def with_clashes(df, names):
    return df.select("*", *[F.lit("clash").alias(n) for n in names if n not in df.columns])


@pytest.mark.parametrize("name", DOCUMENTS)
def test_documents(spark, name):
    df = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(TEXTS)], "doc_id long, text string, lang string, source string")
    assert rows(DOCUMENTS[name](with_clashes(df, DOCUMENT_CLASHES))) == rows(DOCUMENTS[name](df))


@pytest.mark.parametrize("name", VECTORS)
def test_vectors(spark, name):
    df = spark.createDataFrame([(i, [float(i % 5) + 0.5, 1.0, float(-i)], i % 2) for i in range(12)], "vec_id long, embedding array<float>, label int")
    assert rows(VECTORS[name](with_clashes(df, [c for c in VECTOR_CLASHES if name == "neighbours" or c != "id"]))) == rows(VECTORS[name](df))


@pytest.mark.parametrize("name", PAGES)
def test_pages(spark, name):
    df = spark.createDataFrame([(i, f"http://x/{i}", t) for i, t in enumerate(TEXTS)], "page_id long, url string, html string")
    assert rows(PAGES[name](with_clashes(df, PAGE_CLASHES))) == rows(PAGES[name](df))
