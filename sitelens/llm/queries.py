"""Registered queries of the subpackage: one thin query per operator, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.llm import bpe, hard_negatives, langid, licences, merkle, neighbours, packing, sharding, simhash, sketches, suffix_dedup, token_files, warc
from sitelens.llm.common import table

WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.edited_fingerprints(table(spark, sf_dir, "documents"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), WORD_VOCABULARY)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out)
    model = langid.train(docs.where(~F.col("held_out")))
    return langid.predict(docs.select("doc_id", "text", "held_out"), model).select("doc_id", "held_out", "lang_pred", "score", "accepted")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
                                                    F.xxhash64(raw).alias("text_hash"))
    got = sharding.shard_by_bytes(rows, "size", sharding.order_key(F.col("text_hash"), F.col("doc_id")), shards=16)
    return got.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.count_documents(table(spark, sf_dir, "documents"), BYTE_VOCABULARY)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.cut_documents(table(spark, sf_dir, "documents"), BYTE_VOCABULARY))


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_files(table(spark, sf_dir, "documents"), licences.derived_path())


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeat_digests(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return got.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label=label)
    return got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    upper = "".join(map(chr, range(65, 91)))
    return merkle.manifest(table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"],
                           tampered={"text": F.translate("text", upper, upper.lower())}, where=F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0)


REGISTRY = {f.__name__: f for f in (op1_fingerprints, op2_bpe, op3_language_id, op4_sharding, op5_neighbours, op6_token_counts,
                                    op7_packing, op8_licences, op9_suffix_dedup, op10_simhash, op11_warc,
                                    op12_hard_negatives, op13_merkle)}
ORACLE: dict[str, str] = {
    # base32 of a digest: its 160 bits in groups of five
    "op11_warc": """
WITH d AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), bits AS (
  SELECT *, array_to_string([substr('0000000100100011010001010110011110001001101010111100110111101111',
                                    4 * (strpos('0123456789abcdef', substr(hex, i, 1)) - 1) + 1, 4) FOR i IN range(1, 41)], '') AS b FROM d
), digests AS (
  SELECT page_id, payload_bytes,
         array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                                 1 + 16 * CAST(substr(b, 5 * i + 1, 1) AS INT) + 8 * CAST(substr(b, 5 * i + 2, 1) AS INT) + 4 * CAST(substr(b, 5 * i + 3, 1) AS INT)
                                 + 2 * CAST(substr(b, 5 * i + 4, 1) AS INT) + CAST(substr(b, 5 * i + 5, 1) AS INT), 1) FOR i IN range(0, 32)], '') AS payload_digest
  FROM bits
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = max(page_id) OVER w THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> max(page_id) OVER w THEN max(page_id) OVER w END AS refers_to
FROM digests WINDOW w AS (PARTITION BY payload_digest)
""",
    "op12_hard_negatives": """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS other_id, a.label = c.label AS same,
         CAST(list_sum([a.v[i] * c.v[i] FOR i IN range(1, len(a.v) + 1)]) AS BIGINT) AS score
  FROM rows a JOIN rows c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY row_number() OVER w <= 10
""",
    # trees and proofs as two pairs of recursions: groups' trees, then the tree of their roots
    "op13_merkle": """
WITH RECURSIVE rows AS (
  SELECT doc_id, coalesce('+' || lang, '') AS g,
         [CASE WHEN x IS NULL THEN '-' ELSE strlen(x) || ':' || x END
          FOR x IN [CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR)]] AS head, text,
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_text,
         CAST(doc_id AS VARCHAR) AS name
  FROM documents
), crc_table AS (
  SELECT i, list_reduce([CAST(i AS BIGINT)] || [CAST(0 AS BIGINT) FOR j IN range(8)],
                        lambda c, j: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
  FROM range(256) t(i)
), crc_values AS (SELECT list(v ORDER BY i) AS t FROM crc_table),
leaves AS (
  SELECT row_number() OVER () AS rid, doc_id, g,
         sha256(array_to_string(head, '') || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END) AS leaf,
         CASE WHEN xor(4294967295, list_reduce([CAST(4294967295 AS BIGINT)] || [CAST(ascii(x) AS BIGINT) FOR x IN string_split(name, '')],
                       lambda c, x: xor(t[xor(c % 256, x) + 1], c >> 8))) % 3 = 0
              THEN sha256(array_to_string(head, '') || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || lower_text END) END AS changed
  FROM rows, crc_values
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM leaves
), nodes AS (
  SELECT g, 0 AS level, pos, n, leaf AS h FROM placed
  UNION ALL
  SELECT g, level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM nodes WHERE n > 1 GROUP BY g, level, pos // 8, n
), runs AS (
  SELECT g, level, pos // 8 AS run, list(h ORDER BY pos) AS hs FROM nodes WHERE n > 1 GROUP BY g, level, pos // 8
), subroots AS (
  SELECT g, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1
), tops AS (
  SELECT 0 AS level, pos, n, subroot AS h FROM subroots
  UNION ALL
  SELECT level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM tops WHERE n > 1 GROUP BY level, pos // 8, n
), top_runs AS (
  SELECT level, pos // 8 AS run, list(h ORDER BY pos) AS hs FROM tops WHERE n > 1 GROUP BY level, pos // 8
), up AS (
  SELECT rid, g, 0 AS level, pos, coalesce(changed, leaf) AS acc, '' AS proof FROM placed
  UNION ALL
  SELECT rid, up.g, up.level + 1, pos // 8,
         sha256(array_to_string(hs[1:pos % 8], '') || acc || array_to_string(hs[pos % 8 + 2:], '')),
         proof || array_to_string(hs[1:pos % 8], '') || array_to_string(hs[pos % 8 + 2:], '')
  FROM up JOIN runs ON runs.g = up.g AND runs.level = up.level AND runs.run = pos // 8
), reached AS (
  SELECT rid, g, arg_max(acc, level) AS acc, arg_max(proof, level) AS proof FROM up GROUP BY rid, g
), further AS (
  SELECT rid, 0 AS level, pos, acc, proof FROM reached JOIN subroots USING (g)
  UNION ALL
  SELECT rid, further.level + 1, pos // 8,
         sha256(array_to_string(hs[1:pos % 8], '') || acc || array_to_string(hs[pos % 8 + 2:], '')),
         proof || array_to_string(hs[1:pos % 8], '') || array_to_string(hs[pos % 8 + 2:], '')
  FROM further JOIN top_runs ON top_runs.level = further.level AND top_runs.run = pos // 8
), ends AS (SELECT rid, arg_max(acc, level) AS acc, arg_max(proof, level) AS proof FROM further GROUP BY rid)
SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, acc AS folded_root, acc = h AS verified
FROM placed JOIN ends USING (rid) JOIN subroots USING (g) JOIN (SELECT h FROM tops WHERE n = 1) ON true
""",
}
