"""Inbound-link (backlink) quality: is our link still there, where, how toxic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.html import page_error, with_elements
from ..functions.text import py_strip
from ..plans.bloom import maybe_listed
from ..sources.snapshots import capture_time, latest_per_url

# Result labels, scores and notes of the backlink report.
OFFLINE = "OFFLINE"
REMOVED = "RIMOSSO"
ERROR = "ERRORE"
EXCELLENT = ("⭐️ ECCELLENTE", 10)
POOR = ("🔴 SCARSO", 2)
MEDIUM = ("🟡 MEDIO", 5)
TOXIC = ("💀 TOSSICO", 0)
NOT_AVAILABLE = "N/D"
EMPTY_ANCHOR = "[Immagine/Vuoto]"
NOTE_OFFLINE = "Errore Connessione"
NOTE_REMOVED = "Link non più presente"
NOTE_ACTIVE = "Attivo"
NO_SNAPSHOT = "no snapshot for URL"
# Containers that make a link editorial / marginal, and toxic words.
EDITORIAL_TAGS = ("article", "main", "p")
MARGINAL_TAGS = ("footer", "aside")
TOXIC_WORDS = ("casino", "betting", "crypto", "porn")
URL_MARKER = "http"

RESULT_COLUMNS = ("URL Sorgente", "Tipo Risultato", "Power Score", "Anchor Text", "Note")


def url_column_flags(df: DataFrame) -> DataFrame:
    """One row: for each column, whether any value (as text) contains ``http``."""
    return df.agg(*[F.coalesce(F.bool_or(F.col(f"`{c}`").cast("string").contains(URL_MARKER)),
                               F.lit(False)).alias(c) for c in df.columns])


def url_column(df: DataFrame) -> DataFrame:
    """One row, ``url_column``: the first column (in order) holding a URL."""
    flags = url_column_flags(df)
    pick = F.coalesce(*[F.when(F.col(f"`{c}`"), F.lit(c)) for c in df.columns],
                      F.lit(None).cast("string"))
    return flags.select(pick.alias("url_column"))


def detect_url_column(df: DataFrame) -> str:
    """Driver-side pick of the URL column (one aggregate job)."""
    name = url_column(df).first()["url_column"]
    if name is None:
        raise ValueError("no column holds a URL")
    return name


def _overlap(ancestors: Column, tags) -> Column:
    return F.coalesce(F.arrays_overlap(ancestors, F.array(*[F.lit(t) for t in tags])), F.lit(False))


def link_results(snapshots: DataFrame | None, domain: str, toxic_words=TOXIC_WORDS,
                 parsed: DataFrame | None = None) -> DataFrame:
    """Per source-page snapshot: url, status, fetch_error, whether our link is
    there, its tier (label, score), anchor text.

    Runs where the snapshots lie; the page text used for the toxicity test
    never leaves the stage, and only fetched pages are parsed.  With
    ``parsed`` (from ``audit.parse_snapshots(..., with_text=True)``) the
    shared parse is reused.
    """
    if parsed is None:
        snap = (snapshots.select("url", "status", "html", "fetch_error", *capture_time(snapshots))
                .withColumn("html", F.when(F.col("fetch_error").isNull() & (F.col("status") == 200),
                                           F.col("html"))))
        parsed = with_elements(snap, keep=("a",), ancestors_for=("a",), with_text=True)
    link = F.get(F.filter(F.col("elements"), lambda e: (e["tag"] == "a")
                          & F.coalesce(e["href"].contains(domain), F.lit(False))), 0)
    text = F.lower(F.coalesce(F.col("page_text"), F.lit("")))
    toxic = F.exists(F.array(*[F.lit(w) for w in toxic_words]), lambda w: text.contains(w))
    with_link = parsed.select("url", "status", page_error(), *capture_time(parsed), link.alias("_l"), toxic.alias("_toxic"))
    editorial = _overlap(F.col("_l.ancestors"), EDITORIAL_TAGS)
    marginal = _overlap(F.col("_l.ancestors"), MARGINAL_TAGS)

    def tier(i: int) -> Column:
        return (F.when(F.col("_toxic"), F.lit(TOXIC[i])).when(editorial, F.lit(EXCELLENT[i]))
                .when(marginal, F.lit(POOR[i])).otherwise(F.lit(MEDIUM[i])))

    return with_link.select(
        "url", "status", "fetch_error", *capture_time(with_link),
        F.col("_l").isNotNull().alias("_linked"),
        tier(0).alias("_label"), tier(1).alias("_score"),
        py_strip(F.col("_l.text")).alias("_anchor"),
        F.lit(True).alias("_snap"))


def backlink_audit(sources: DataFrame, snapshots: DataFrame | None, domain: str,
                   url_col: str | None = None, toxic_words=TOXIC_WORDS,
                   parsed: DataFrame | None = None) -> DataFrame:
    """One result row per listed source URL (rows with no URL are dropped).

    ``sources``: any table; the URL column is found when not given.
    ``snapshots``: url, status, html, fetch_error of the source pages.
    ``domain``: our domain, matched as a case-sensitive substring of ``href``.
    Pages outside the list are dropped before the parse, where they lie, by a
    Bloom filter; the small results (``link_results``) are joined to the list.  A null status counts as offline.
    Of several captures of a URL the latest ``fetched_at`` counts.
    """
    col = url_col or detect_url_column(sources)
    listed = sources.select(F.col(f"`{col}`").cast("string").alias("url")).na.drop(subset=["url"])
    if parsed is None:      # only pages that may be listed are parsed
        snapshots = maybe_listed(snapshots, "url", listed)
    res = listed.join(latest_per_url(link_results(snapshots, domain, toxic_words, parsed)), "url", "left")
    error = F.when(F.col("_snap").isNull(), F.lit(NO_SNAPSHOT)).otherwise(F.col("fetch_error"))
    offline = error.isNull() & ~F.col("status").eqNullSafe(200)
    removed = error.isNull() & ~offline & ~F.col("_linked")
    scored = error.isNull() & ~offline & ~removed
    return res.select(
        F.col("url").alias("URL Sorgente"),
        F.when(error.isNotNull(), F.lit(ERROR)).when(offline, F.lit(OFFLINE))
         .when(removed, F.lit(REMOVED)).otherwise(F.col("_label")).alias("Tipo Risultato"),
        F.when(scored, F.col("_score")).otherwise(F.lit(0)).cast("int").alias("Power Score"),
        F.when(scored, F.when(F.col("_anchor") == "", F.lit(EMPTY_ANCHOR)).otherwise(F.col("_anchor")))
         .otherwise(F.lit(NOT_AVAILABLE)).alias("Anchor Text"),
        F.when(error.isNotNull(), error).when(offline, F.lit(NOTE_OFFLINE))
         .when(removed, F.lit(NOTE_REMOVED)).otherwise(F.lit(NOTE_ACTIVE)).alias("Note"),
    )
