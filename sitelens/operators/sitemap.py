"""Sitemap expansion: root sitemap(s) -> the distinct set of page URLs.

Every sitemap snapshot is parsed once into an edge table (sitemap -> loc).
A link whose lowercased text contains ``.xml`` is a sub-sitemap; anything else
is a page.  Breadth-first rounds then grow the set of visited sitemaps with a
join and an anti-join; a sitemap that failed (non-200 or never captured) is
visited but contributes no links, and the visited set cuts cycles.  Pages are
the non-sitemap links of all visited sitemaps.  The edge tables and each
round's new sitemaps are checkpointed to the shared checkpoint folder, so the
visited set is a flat union of written pieces and a lost executor only
recomputes the current round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import py_strip
from ..session import ensure_checkpoint_dir

# The sitemap marker and the loc element pattern.
SITEMAP_MARKER = ".xml"
LOC_PATTERN = r"(?is)<loc\b[^>]*>(.*?)</loc\s*>"
CDATA_PATTERN = r"(?s)^<!\[CDATA\[(.*)\]\]>$"
COMMENT_PATTERN = r"(?s)<!--.*?-->"
AMP_REFERENCE = r"(?i)&#(?:0*38|x0*26);"
XML_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&"))


def _character(ref: Column) -> Column:
    """The character of a reference's digits (``65`` or ``x41``); null when there is none."""
    hexed = F.lower(F.substring(ref, 1, 1)) == "x"
    code = F.when(hexed, F.conv(F.substring(ref, 2, 16), 16, 10)).otherwise(ref).try_cast("long")
    valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))


def xml_unescape(c: Column) -> Column:
    """Named and numeric references; an ampersand appears last, so nothing is decoded twice."""
    c = F.regexp_replace(c, AMP_REFERENCE, "&amp;")
    for ent, ch in XML_ENTITIES[:-1]:
        c = F.replace(c, F.lit(ent), F.lit(ch))
    refs = F.array_distinct(F.regexp_extract_all(c, F.lit("&#([0-9]+|[xX][0-9a-fA-F]+);"), 1))
    c = F.when(c.contains("&#"), F.aggregate(refs, c, lambda acc, r: F.replace(
        acc, F.concat(F.lit("&#"), r, F.lit(";")), F.coalesce(_character(r), F.concat(F.lit("&#"), r, F.lit(";")))))).otherwise(c)
    ent, ch = XML_ENTITIES[-1]
    return F.replace(c, F.lit(ent), F.lit(ch))


def extract_locs(xml: Column) -> Column:
    """Array of stripped ``<loc>`` texts, in document order."""
    raw = F.regexp_extract_all(F.regexp_replace(xml, COMMENT_PATTERN, ""), F.lit(LOC_PATTERN), 1)
    return F.transform(raw, lambda x: py_strip(xml_unescape(
        F.regexp_replace(py_strip(x), CDATA_PATTERN, "$1"))))


def is_sitemap_link(loc: Column) -> Column:
    return F.lower(loc).contains(SITEMAP_MARKER)


def sitemap_edges(sitemaps: DataFrame) -> DataFrame:
    """(parent, loc, is_sitemap) for every loc of every sitemap fetched with 200."""
    return (sitemaps.filter(F.col("status") == 200)
            .select(F.col("url").alias("parent"), F.explode(extract_locs(F.col("xml"))).alias("loc"))
            .withColumn("is_sitemap", is_sitemap_link(F.col("loc"))))


def expand_sitemaps(sitemaps: DataFrame, roots: DataFrame) -> DataFrame:
    """Distinct page URLs (column ``url``) reachable from ``roots`` (column ``url``).

    Driver loop, one round per sitemap depth; each round is a distributed
    join + anti-join.  Every round adds sitemaps not seen before, so the loop
    ends when the deepest one is read, cycles included.
    """
    ensure_checkpoint_dir(sitemaps.sparkSession)
    edges = sitemap_edges(sitemaps).checkpoint()
    # rounds scan only sitemap -> sitemap links (a small share of all links)
    sub = edges.filter("is_sitemap").select("parent", F.col("loc").alias("url")).checkpoint()
    visited = roots.select("url").distinct().checkpoint()
    frontier = visited
    while True:
        found = (sub.join(frontier.withColumnRenamed("url", "parent"), "parent", "left_semi")
                 .select("url").distinct())
        new = found.join(visited, "url", "left_anti").checkpoint()
        if new.isEmpty():
            break
        # a flat union of checkpointed pieces: nothing upstream is recomputed
        visited = visited.unionByName(new)
        frontier = new
    pages = (edges.filter(~F.col("is_sitemap"))
             .join(visited.withColumnRenamed("url", "parent"), "parent", "left_semi"))
    return pages.select(F.col("loc").alias("url")).distinct()
