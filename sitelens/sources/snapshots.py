"""Snapshot table schemas.

Fetching is not data work: the crawler, browser and suggestion service stay
outside.  Operators read what they captured, as tables or file streams.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAGE_SNAPSHOT = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("content_type", T.StringType()),
    T.StructField("html", T.StringType()),
    T.StructField("fetch_error", T.StringType()),
    T.StructField("fetched_at", T.TimestampType()),   # optional; the latest capture of a URL counts
])

SITEMAP_SNAPSHOT = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("xml", T.StringType()),
])

SUGGESTION_PAYLOAD = T.StructType([
    T.StructField("seed", T.StringType()),
    T.StructField("query", T.StringType()),
    T.StructField("payload", T.StringType()),
])

PERF_ENTRY = T.StructType([
    T.StructField("view_id", T.StringType()),
    T.StructField("label", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("seq", T.LongType()),
    T.StructField("entry_type", T.StringType()),
    T.StructField("start_ms", T.DoubleType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("had_recent_input", T.BooleanType()),
    T.StructField("response_start_ms", T.DoubleType()),
    T.StructField("load_ms", T.DoubleType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("fetch_error", T.StringType()),
])


def read_snapshots(spark: SparkSession, path: str, schema: T.StructType,
                   fmt: str = "parquet") -> DataFrame:
    """Batch scan of a snapshot folder with a declared schema (no inference)."""
    return spark.read.format(fmt).schema(schema).load(path)


def stream_snapshots(spark: SparkSession, path: str, schema: T.StructType,
                     fmt: str = "parquet", max_files: int | None = None) -> DataFrame:
    """File-stream scan of arriving snapshots."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def capture_time(df: DataFrame) -> tuple[str, ...]:
    """The capture time column, if the table has one."""
    return ("fetched_at",) if "fetched_at" in df.columns else ()


def latest_per_url(results: DataFrame) -> DataFrame:
    """One result per URL: the latest capture's (ties and captures without a time: the greatest row).

    The capture time itself is kept, if there is one.
    """
    rest = [c for c in results.columns if c not in ("url", "fetched_at")]
    newest = F.max(F.struct(*capture_time(results), *rest)).alias("_r")
    return (results.groupBy("url").agg(newest)
            .select("url", *[F.col("_r")[c].alias(c) for c in results.columns if c != "url"]))
