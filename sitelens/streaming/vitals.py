"""Streaming page-speed report: one row per page view, written once.

Entries arrive as a stream.  A view's entries are a session of event time: it
ends when none has come for ``gap``, and its report row is appended to the sink
when the watermark has passed that end; entries later than the watermark are dropped.
A view across midnight is one session like any other.  The state holds open
views only.

An open view is written only once later entries move the watermark on.  Where
a stream ends for good (a backfill), ``close_views`` adds an entry far enough
behind the last one, and the next run writes what is left.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.vitals import SETTLE_MS, vitals_aggregates, vitals_format

DEFAULT_WATERMARK = "10 minutes"
VIEW_GAP = "1 day"
VIEW = ("view_id", "label", "url")


def vitals_views(entries: DataFrame, settle_ms: int = SETTLE_MS, watermark: str = DEFAULT_WATERMARK,
                 gap: str = VIEW_GAP) -> DataFrame:
    """Report rows of views, each when its session has ended.  ``gap`` is longer than any pause inside a view.

    Each task sorts its entries to combine them: a backlog of a few large splits is dealt over more tasks beforehand.
    """
    views = (entries.withWatermark("ts", watermark)
             .groupBy(F.session_window("ts", gap), *VIEW)
             .agg(*vitals_aggregates(settle_ms)))
    return vitals_format(views, keep=("view_id",))


def start_vitals_stream(entries: DataFrame, sink: str, checkpoint: str, settle_ms: int = SETTLE_MS,
                        watermark: str = DEFAULT_WATERMARK, gap: str = VIEW_GAP,
                        available_now: bool = True, closing: str | None = None):
    """Append report rows to ``sink`` (parquet).  ``closing``: a folder that ``close_views`` writes to."""
    if closing is not None:
        spark = entries.sparkSession
        spark.createDataFrame([], entries.schema).write.mode("append").parquet(closing)
        entries = entries.unionByName(spark.readStream.schema(entries.schema).parquet(closing))
    writer = (vitals_views(entries, settle_ms, watermark, gap).writeStream.format("parquet").outputMode("append")
              .option("path", sink).option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def close_views(spark: SparkSession, closing: str, schema: T.StructType, last: datetime,
                watermark: str = DEFAULT_WATERMARK, gap: str = VIEW_GAP) -> None:
    """Write an entry so long after ``last`` that the next run ends every view; it stays open itself."""
    end = F.lit(last).cast("timestamp") + F.expr(f"INTERVAL {gap}") + F.expr(f"INTERVAL {watermark}") + F.expr("INTERVAL 1 second")
    row = spark.range(1).select(*[(end if f.name == "ts" else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])
    row.write.mode("append").parquet(closing)
