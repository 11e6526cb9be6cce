"""Shared helpers: tables in the shared checkpoint folder, sizes of inputs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.plans.skew import spread_join
from sitelens.session import ensure_checkpoint_dir

__all__ = ["gauge", "parts_for", "saved", "scratch", "spread_join", "table", "text_bytes"]

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder named by ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str = "table") -> DataFrame:
    """df written to the shared folder and read back: lineage ends here and
    lost executors are replaced by rereading it.  The folder's owner clears it.

    The shuffle files behind the table go with the write, as nothing reads them again.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def parts_for(rows: int, per_part: int, least: int = 1) -> int:
    """Partitions so that each holds about per_part rows."""
    return max(least, -(-rows // per_part))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def gauge(df: DataFrame, *exprs) -> dict:
    """One row of aggregates as a dict."""
    return df.agg(*exprs).first().asDict()


def text_bytes(df: DataFrame, text: str = "text") -> int:
    """Total UTF-8 bytes of a text column."""
    return gauge(df, F.sum(F.octet_length(F.col(text))).alias("n"))["n"] or 0
