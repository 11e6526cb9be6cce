"""Corpus pipeline: language ID, SimHash near-dedup, suffix-array dedup, packing.

``run(spark, sf_dir)`` applies STAGES to the documents table; each stage's rows
are written as Parquet and read again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.llm import langid, packing, simhash, suffix_dedup
from sitelens.llm.common import saved
from sitelens.llm.queries import BYTE_VOCABULARY

#: No stage can be said in SQL; tests compare each with a brute-force version.
ORACLE_SQL = None
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is near enough to a learned language; lang is unchanged.

    Trained on all labelled documents; a null text or one without a letter goes.
    """
    return langid.predict(docs.select(*COLUMNS), langid.train(docs)).where("accepted").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of SimHash near duplicates: the smallest doc_id, of rows that share it the smallest digest of the text.

    Rows that share a doc_id but no near text each stay with their own group.
    A row without a doc_id comes after all others of its group, and stays if it
    has none beside it; rows that repeat a kept doc_id and text are kept once.
    """
    rows = docs.select(*COLUMNS, F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("digest"),
                                          F.col("text").isNull().alias("no_text")).alias("who"))
    keep = simhash.near_duplicates(rows, key="who").select(F.col("component_id").alias("who")).distinct()
    return rows.dropDuplicates(["who"]).join(keep, "who", "left_semi").select(*COLUMNS)


def repeat_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the byte strings that a document with a smaller id holds, cut at whole characters.

    Every document stays, if only with an empty text; n_chars counts what is left.
    """
    kept = suffix_dedup.remove_repeats(docs.select(*COLUMNS))
    return kept.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all texts, packed into sequences of 2048 tokens."""
    return packing.pack(packing.cut_documents(docs, BYTE_VOCABULARY))


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("repeat_removal", repeat_removal), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = saved(docs, name)
    return docs
