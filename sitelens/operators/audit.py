"""Per-page technical audit (title, meta, canonical, robots, headings, images)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.html import with_elements
from ..functions.text import MISSING, py_strip
from ..functions.url import url_class
from ..plans.bloom import maybe_listed
from ..sources.snapshots import capture_time, latest_per_url

# Output columns of the audit table, in order.
AUDIT_COLUMNS = ("URL", "Tipo", "Status", "Robots", "Canonical", "Title", "Lung. Title",
                 "Meta Desc", "H1", "H2 Totali", "Img Totali", "Img senza ALT")
# Fixed value: robots directive assumed when a page declares none.
DEFAULT_ROBOTS = "index, follow"
HTML_TYPE = "text/html"
AUDIT_TAGS = ("title", "meta", "link", "h1", "h2", "img")


def is_html_response(content_type: Column) -> Column:
    """Content type must mention text/html; a missing header is not HTML."""
    return F.coalesce(content_type, F.lit("")).contains(HTML_TYPE)


def auditable(snapshots: DataFrame) -> DataFrame:
    """Fetched without error and HTML.  Filters run before the parse.

    In a filter a null content type drops the row either way, so the plain
    ``contains`` is used: it reaches a parquet scan as a pushed filter.
    """
    return snapshots.filter(F.col("fetch_error").isNull()
                            & F.col("content_type").contains(HTML_TYPE))


def first_element(pred) -> Column:
    return F.get(F.filter(F.col("elements"), pred), 0)


def _has_token(c: Column, token: str) -> Column:
    return F.array_contains(F.split(c, r"\s+"), token)


def element_fields(df: DataFrame) -> DataFrame:
    """Audit fields from ``elements``; null where the page has no such tag.

    Each "first matching element" is computed once (one projection), then
    its fields are read in the next one.
    """
    imgs = F.filter(F.col("elements"), lambda e: e["tag"] == "img")
    firsts = df.select(
        "*",
        first_element(lambda e: e["tag"] == "title").alias("_t"),
        first_element(lambda e: (e["tag"] == "meta") & (e["name"] == "description")).alias("_d"),
        first_element(lambda e: (e["tag"] == "link") & _has_token(e["rel"], "canonical")).alias("_c"),
        first_element(lambda e: (e["tag"] == "meta") & (e["name"] == "robots")).alias("_r"),
        first_element(lambda e: e["tag"] == "h1").alias("_h"),
        F.size(F.filter(F.col("elements"), lambda e: e["tag"] == "h2")).alias("_h2"),
        F.size(imgs).alias("_img"),
        F.size(F.filter(imgs, lambda e: e["alt"].isNull() | (py_strip(e["alt"]) == F.lit(""))))
         .alias("_img_no_alt"),
    ).drop("elements")
    return firsts.select(
        *[c for c in df.columns if c != "elements"],
        py_strip(F.col("_t.string")).alias("_title"),
        py_strip(F.col("_d.content")).alias("_desc"),
        F.col("_c").isNotNull().alias("_canon_tag"),
        F.col("_c.href").alias("_canon"),
        F.col("_r").isNotNull().alias("_robots_tag"),
        F.col("_r.content").alias("_robots"),
        py_strip(F.col("_h.text")).alias("_h1"),
        "_h2", "_img", "_img_no_alt")


def page_audit(snapshots: DataFrame, urls: DataFrame | None = None, strict: bool = False,
               missing: str | None = MISSING, keep: tuple[str, ...] = (),
               parsed: DataFrame | None = None, latest: bool = False) -> DataFrame:
    """Audit table, one row per fetched HTML page whose markup can be parsed.

    ``snapshots``: url, status, content_type, html, fetch_error (+ ``keep``).
    ``urls``: optional list of URLs to audit (one column ``url``); a URL
    without a snapshot yields no row, as a failed fetch does.  Pages that are
    surely not listed are dropped before the parse, where they lie, by a Bloom
    filter; the exact semi-join runs on the audit's short rows.
    ``strict``: drop pages whose canonical link lacks ``href`` or whose robots
    meta lacks ``content`` (the audited tool fails on those pages); otherwise
    they are kept with a null field.
    ``missing``: placeholder for absent title/description/canonical/H1, or
    None for null (fact form).
    ``parsed``: the snapshots already parsed by ``parse_snapshots`` (shared
    by several operators, so each page is parsed once); ``snapshots`` is then
    not read.
    ``latest``: one row per URL, that of its latest capture (``fetched_at``),
    if that one can be audited; otherwise every capture is a row.
    """
    carried = tuple(dict.fromkeys((*keep, *(capture_time(parsed if parsed is not None else snapshots) if latest else ()))))
    if latest:      # a failed capture counts as one, though it gives no row
        every = parsed if parsed is not None else snapshots
        good = F.col("fetch_error").isNull() & F.coalesce(F.col("content_type"), F.lit("")).contains(HTML_TYPE)
    if parsed is not None:
        pages = parsed if latest else auditable(parsed)
        pages = pages.select("url", "status", "elements", *carried, *([good.alias("_good")] if latest else []))
    else:
        snap = every.withColumn("html", F.when(good, F.col("html"))) if latest else auditable(snapshots)
        snap = snap.select("url", "status", "html", *carried, *([good.alias("_good")] if latest else []))
        if urls is not None:
            snap = maybe_listed(snap, "url", urls)
        pages = with_elements(snap, keep=AUDIT_TAGS, ancestors_for=())
    if latest:
        pages = pages.withColumn("_good", F.col("_good") & F.col("elements").isNotNull())
    else:
        pages = pages.where("elements is not null")
    fields = element_fields(pages)
    if urls is not None:
        fields = fields.join(urls.select("url").distinct(), "url", "left_semi")
    if latest:
        fields = latest_per_url(fields).where("_good").drop("_good")
    return audit_rows(fields, strict=strict, missing=missing, keep=keep)


def audit_rows(fields: DataFrame, strict: bool = False, missing: str | None = MISSING,
               keep: tuple[str, ...] = ()) -> DataFrame:
    """``element_fields`` output -> the audit table."""
    if strict:
        fields = fields.filter(~(F.col("_canon_tag") & F.col("_canon").isNull())
                               & ~(F.col("_robots_tag") & F.col("_robots").isNull()))

    def fill(c: Column) -> Column:
        return c if missing is None else F.coalesce(c, F.lit(missing))

    return fields.select(
        F.col("url").alias("URL"),
        url_class(F.col("url")).alias("Tipo"),
        F.col("status").cast("int").alias("Status"),
        F.when(F.col("_robots_tag"), F.col("_robots")).otherwise(F.lit(DEFAULT_ROBOTS)).alias("Robots"),
        F.when(F.col("_canon_tag"), F.col("_canon")).otherwise(fill(F.lit(None).cast("string"))).alias("Canonical"),
        fill(F.col("_title")).alias("Title"),
        F.coalesce(F.length(F.col("_title")), F.lit(0)).cast("int").alias("Lung. Title"),
        fill(F.col("_desc")).alias("Meta Desc"),
        fill(F.col("_h1")).alias("H1"),
        F.col("_h2").cast("int").alias("H2 Totali"),
        F.col("_img").cast("int").alias("Img Totali"),
        F.col("_img_no_alt").cast("int").alias("Img senza ALT"),
        *keep,
    )


def parse_snapshots(snapshots: DataFrame, tags=None, with_text: bool = False,
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """Parse every fetched snapshot once, for several operators.

    Output: url, status, content_type, fetch_error, elements (+ page_text)
    (+ ``fetched_at`` if there, + ``keep``).  Pages with a fetch error are carried unparsed (no
    elements) so the operators can still report them.  Checkpoint or write
    the result when more than one operator reads it.
    """
    from ..functions.html import DEFAULT_TAGS
    carried = tuple(dict.fromkeys((*keep, *capture_time(snapshots))))
    snap = (snapshots.select("url", "status", "content_type", "html", "fetch_error", *carried)
            .withColumn("html", F.when(F.col("fetch_error").isNull(), F.col("html"))))
    return with_elements(snap, keep=tuple(tags or DEFAULT_TAGS), ancestors_for=("a",), with_text=with_text)


def url_classes(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """Page class for every URL (no fetch needed)."""
    return urls.withColumn("Tipo", url_class(F.col(url_col)))
