"""Page-speed report (LCP, CLS, TTFB) from captured browser performance entries.

Per page view: LCP is the start time of the last largest-contentful-paint
entry, CLS the plain sum of layout shifts without recent input, TTFB the
response start of the first navigation entry; only entries observed by the
settle time after load count.  A view without a navigation entry, or with a
capture error, yields an error row.  All aggregates combine map-side
(``max``/``min``/``sum``), so a view with many entries costs no more than one
shuffle row per partition; their results combine further (``merged``), as the
stream needs for a view whose entries lie in two of its windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Entry types, verdicts, thresholds, message for a view
# without navigation timing.
LCP = "largest-contentful-paint"
SHIFT = "layout-shift"
NAVIGATION = "navigation"
ERROR = "error"
GOOD = "✅ BUONO"
NEEDS_WORK = "🔴 DA MIGLIORARE"
LCP_GOOD_MS = 2500
SETTLE_MS = 2000
NO_NAVIGATION = "TypeError: Cannot read properties of undefined (reading 'responseStart')"
REPORT_COLUMNS = ("Tipo", "URL", "TTFB", "LCP", "CLS", "Giudizio", "Errore")


def js_round(x: Column) -> Column:
    """``Math.round``: half rounds up."""
    return F.floor(x + F.lit(0.5))


def seconds_text(ms: Column) -> Column:
    """Integer milliseconds as the shortest decimal seconds text (2500 -> 2.5)."""
    whole = F.floor(ms / 1000).cast("long").cast("string")
    frac = F.regexp_replace(F.lpad((ms % 1000).cast("long").cast("string"), 3, "0"), "0+$", "")
    return F.when(ms % 1000 == 0, whole).otherwise(F.concat(whole, F.lit("."), frac))


def _entry(column: str) -> Column:
    return F.struct("ts", "seq", column)


def vitals_aggregates(settle_ms: int = SETTLE_MS) -> list[Column]:
    seen = F.col("start_ms") <= F.col("load_ms") + F.lit(float(settle_ms))
    is_lcp = (F.col("entry_type") == LCP) & seen
    is_shift = (F.col("entry_type") == SHIFT) & seen & ~F.coalesce(F.col("had_recent_input"), F.lit(False))
    is_nav = F.col("entry_type") == NAVIGATION
    is_err = F.col("entry_type") == ERROR
    return [
        F.max(F.when(is_lcp, _entry("start_ms"))).alias("last_lcp"),
        F.sum(F.when(is_shift, F.col("value"))).alias("cls_sum"),
        F.min(F.when(is_nav, _entry("response_start_ms"))).alias("first_navigation"),
        F.min(F.when(is_err, _entry("fetch_error"))).alias("first_error"),
    ]


def merged(parts: DataFrame, *keys: str) -> DataFrame:
    """``vitals_aggregates`` of disjoint sets of entries -> those of their union, per ``keys``."""
    return parts.groupBy(*keys).agg(
        F.max("last_lcp").alias("last_lcp"), F.sum("cls_sum").alias("cls_sum"),
        F.min("first_navigation").alias("first_navigation"), F.min("first_error").alias("first_error"))


def vitals_format(agg: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Aggregates -> report row (error rows carry only label, URL and Errore)."""
    captured = F.col("first_error.fetch_error")
    error = (F.when(captured.isNotNull(), captured)
             .when(F.col("first_navigation").isNull(), F.lit(NO_NAVIGATION)))
    ok = error.isNull()
    lcp_ms = js_round(F.coalesce(F.col("last_lcp.start_ms"), F.lit(0.0))).cast("long")
    ttfb = js_round(F.col("first_navigation.response_start_ms")).cast("long")
    cls = js_round(F.coalesce(F.col("cls_sum"), F.lit(0.0)) * 1000) / 1000
    null = F.lit(None)
    return agg.select(
        *keep,
        F.col("label").alias("Tipo"),
        F.col("url").alias("URL"),
        F.when(ok, F.concat(ttfb.cast("string"), F.lit("ms"))).alias("TTFB"),
        F.when(ok, F.concat(seconds_text(lcp_ms), F.lit("s"))).alias("LCP"),
        F.when(ok, cls).otherwise(null.cast("double")).alias("CLS"),
        F.when(ok, F.when(lcp_ms <= LCP_GOOD_MS, F.lit(GOOD)).otherwise(F.lit(NEEDS_WORK))).alias("Giudizio"),
        error.alias("Errore"),
        F.when(ok, F.col("last_lcp").isNotNull()).alias("lcp_observed"),
    )


def vitals_report(entries: DataFrame, settle_ms: int = SETTLE_MS) -> DataFrame:
    """One report row per page view (``view_id``)."""
    agg = entries.groupBy("view_id", "label", "url").agg(*vitals_aggregates(settle_ms))
    return vitals_format(agg, keep=("view_id",))


def pages_to_test(spark, mapping: dict[str, str]) -> DataFrame:
    """Inline (label, url) relation from a label -> URL dict."""
    return spark.createDataFrame(list(mapping.items()), "label string, url string")
