"""Snapshot inputs derived deterministically from the driver tables.

The driver tables hold raw pages, parts, customers and events, but no HTTP
status, content type, robots/description tags, JSON-LD, sitemaps, backlinks or
browser performance entries.  These derivations build those inputs from the
tables' own columns (every row is used; the key only picks a variant), as SQL
expressions that run unchanged in Spark and in the DuckDB oracle, so both sides
audit byte-identical inputs.  ``dialect`` only switches the regex-replace form
(Spark replaces every match; DuckDB needs the ``'g'`` flag).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values for the derived site.
OWN_DOMAIN = "www.mysite.example.it"
SHOP = "https://shop.example.it"
FIRST_CAPTURE = 1_700_000_000   # seconds


def _rx(dialect: str, subject: str, pattern: str, repl: str) -> str:
    flags = ", 'g'" if dialect == "duckdb" else ""
    return f"regexp_replace({subject}, '{pattern}', '{repl}'{flags})"


def page_snapshot_stages(dialect: str = "spark") -> list[list[str]]:
    """pages(page_id, url, html) -> page snapshot columns, as staged projections."""
    head = ("concat("
            "CASE page_id % 5 WHEN 0 THEN concat('<meta name=\"description\" content=\"Pagina ', "
            "CAST(page_id AS STRING), ' del sito\">') "
            "WHEN 1 THEN '<meta name=\"description\" content=\"\">' "
            "WHEN 2 THEN '<meta name=\"description\">' ELSE '' END, "
            "CASE page_id % 7 WHEN 0 THEN '<meta name=\"robots\" content=\"NOINDEX, follow\">' "
            "WHEN 1 THEN '<meta name=\"robots\" content=\"index, follow\">' "
            "WHEN 2 THEN '<meta name=\"robots\">' ELSE '' END, "
            "CASE page_id % 6 WHEN 0 THEN concat('<link rel=\"canonical\" href=\"', url, '\">') "
            "WHEN 1 THEN concat('<link rel=\"alternate canonical\" href=\"/c/', CAST(page_id AS STRING), '\">') "
            "WHEN 2 THEN '<link rel=\"canonical\">' ELSE '' END, '</head>')")
    body = ("concat(repeat('<h2>Sezione</h2>', CAST(page_id % 4 AS INTEGER)), "
            "CASE page_id % 3 WHEN 0 THEN '<img src=\"a.png\"><img alt=\" \" src=\"b.png\"><img alt=\"foto\" src=\"c.png\">' "
            "WHEN 1 THEN '<img alt src=\"d.png\"><img alt=\"x\">' ELSE '' END, '</article>')")
    title = (f"CASE WHEN page_id % 53 = 13 THEN {_rx(dialect, 'html', '<title>[^<]*</title>', '<title> </title>')} "
             f"WHEN page_id % 59 = 17 THEN {_rx(dialect, 'html', '<title>[^<]*</title>', '')} ELSE html END AS html")
    h1 = (f"CASE WHEN page_id % 43 = 2 THEN {_rx(dialect, 'html', '<h1>[^<]*</h1>', '<h1></h1>')} "
          f"WHEN page_id % 47 = 3 THEN {_rx(dialect, 'html', '<h1>[^<]*</h1>', '')} ELSE html END AS html")
    return [
        ["page_id", "url", f"replace(replace(html, '</head>', {head}), '</article>', {body}) AS html"],
        ["page_id", "url", title],
        ["page_id", "url", h1],
        ["page_id", "url",
         "CAST(CASE WHEN page_id % 17 = 3 THEN 404 WHEN page_id % 29 = 5 THEN 500 ELSE 200 END AS INTEGER) AS status",
         "CASE WHEN page_id % 19 = 4 THEN 'application/pdf' WHEN page_id % 37 = 9 THEN NULL "
         "ELSE 'text/html; charset=utf-8' END AS content_type",
         "html",
         "CASE WHEN page_id % 41 = 11 THEN 'ReadTimeout: read timed out' END AS fetch_error"],
    ]


def apply_stages(df: DataFrame, stages: list[list[str]]) -> DataFrame:
    for stage in stages:
        df = df.selectExpr(*stage)
    return df


def stages_sql(stages: list[list[str]], source: str) -> str:
    """The same staged projections as nested DuckDB SELECTs."""
    sql = f"SELECT * FROM {source}"
    for i, stage in enumerate(stages):
        sql = f"SELECT {', '.join(stage)} FROM ({sql}) s{i}"
    return sql


def page_snapshots(pages: DataFrame) -> DataFrame:
    return apply_stages(pages, page_snapshot_stages("spark"))


# JSON-LD variants for product pages, chosen by p_partkey % 10.
_P_NUM = "CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS STRING)"


def _ld(body: str) -> str:
    return f"concat('<script type=\"application/ld+json\">', {body}, '</script>')"


def product_snapshot_exprs(dialect: str = "spark") -> list[str]:
    """part(p_partkey, p_name, p_retailprice) -> product page snapshots."""
    valid = lambda avail: (
        "concat('{\"@context\":\"https://schema.org\",\"@type\":\"Product\",\"name\":\"', p_name, "
        f"'\",\"offers\":{{\"@type\":\"Offer\",\"price\":', {_P_NUM}, "
        f"',\"priceCurrency\":\"EUR\",\"availability\":\"https://schema.org/{avail}\"}}}}')")
    blocks = (
        "CASE p_partkey % 10 "
        f"WHEN 0 THEN {_ld(valid('InStock'))} "
        f"WHEN 1 THEN {_ld(chr(39) + '[{\"@type\":\"BreadcrumbList\"},{\"@type\":[\"Product\"],\"name\":\"' + chr(39) + ', p_name, ' + chr(39) + '\",\"offers\":[{\"price\":\"' + chr(39) + ', ' + _P_NUM + ', ' + chr(39) + '\",\"priceCurrency\":\"USD\",\"availability\":\"https://schema.org/OutOfStock\"},{\"price\":\"1\"}]}]' + chr(39))} "
        f"WHEN 2 THEN {_ld(chr(39) + '{\"@type\":\"ProductGroup\",\"name\":\"' + chr(39) + ', p_name, ' + chr(39) + '\"}' + chr(39))} "
        f"WHEN 3 THEN {_ld(chr(39) + '{\"@type\":\"Product\",\"offers\":[]}' + chr(39))} "
        f"WHEN 4 THEN {_ld(chr(39) + '{\"@type\":\"Product\",\"offers\":null}' + chr(39))} "
        f"WHEN 5 THEN {_ld(chr(39) + '{\"@graph\":[{\"@type\":\"Product\"}]}' + chr(39))} "
        f"WHEN 6 THEN concat({_ld(chr(39) + '{\"@type\":\"Product\",' + chr(39))}, {_ld(valid('OutOfStock'))}) "
        f"WHEN 7 THEN concat({_ld(valid('InStock'))}, "
        f"{_ld(chr(39) + '{\"@type\":\"Product\",\"offers\":{\"price\":3,\"availability\":null}}' + chr(39))}) "
        f"WHEN 8 THEN {_ld(chr(39) + '[{\"@type\":\"Product\",\"offers\":[]},' + chr(39) + ', ' + valid('InStock') + ', ' + chr(39) + ']' + chr(39))} "
        "ELSE '' END")
    return [
        "p_partkey",
        "concat('https://shop.example.it/it/', CAST(p_partkey AS STRING), '-', replace(p_name, ' ', '-'), "
        "CASE WHEN p_partkey % 50 = 49 THEN '.HTML' ELSE '.html' END) AS url",
        "CAST(CASE WHEN p_partkey % 23 = 5 THEN 404 ELSE 200 END AS INTEGER) AS status",
        "'text/html; charset=utf-8' AS content_type",
        f"concat('<!DOCTYPE html><html><head><title>', p_name, '</title>', {blocks}, "
        "'</head><body><h1>', p_name, '</h1></body></html>') AS html",
        "CASE WHEN p_partkey % 31 = 7 THEN 'ConnectionError: connection refused' END AS fetch_error",
    ]


def product_snapshots(part: DataFrame) -> DataFrame:
    return part.selectExpr(*product_snapshot_exprs("spark"))


def backlink_snapshot_stages(dialect: str = "spark") -> list[list[str]]:
    """Page snapshots with one link to our domain placed by page_id % 5.

    0: inside the article, 1: in the footer, 2: image link in an aside,
    3: blank link in a plain div, 4: no link.
    """
    own = f"https://{OWN_DOMAIN}"
    html = (
        "CASE page_id % 5 "
        f"WHEN 0 THEN replace(html, '</article>', concat('<a href=\"{own}/prodotti?ref=', "
        "CAST(page_id AS STRING), '\">Scarpe da lavoro</a></article>')) "
        f"WHEN 1 THEN replace(html, '</footer>', '<a href=\"{own}/\">mysite</a></footer>') "
        f"WHEN 2 THEN replace(html, '<footer>', '<aside><a href=\"http://{OWN_DOMAIN}/x\"><img src=\"logo.png\"></a></aside><footer>') "
        f"WHEN 3 THEN replace(html, '<footer>', '<div class=\"links\"><a href=\"{own}/y\">  </a></div><footer>') "
        "ELSE html END AS html")
    return page_snapshot_stages(dialect) + [["page_id", "url", "status", html, "fetch_error"]]


def backlink_snapshots(pages: DataFrame) -> DataFrame:
    return apply_stages(pages, backlink_snapshot_stages("spark"))


def backlink_export_exprs() -> list[str]:
    """A search-console style export: host, linking page, rank."""
    return [
        "regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS `Sito`",
        "url AS `Pagina di collegamento`",
        "page_id AS `Rank`",
    ]


# -- sitemaps: root -> region groups -> nation chunks -> customer pages ------
SITEMAP_ROOT = f"{SHOP}/sitemap_index.xml"
CHUNK = 500          # links per generated sitemap file (bounded group size)
_URLSET = '<?xml version="1.0" encoding="UTF-8"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'
_INDEX = '<?xml version="1.0" encoding="UTF-8"?><sitemapindex xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'


def _loc(wrapper: str, c) -> F.Column:
    return F.concat(F.lit(f"<{wrapper}><loc>"), c, F.lit(f"</loc></{wrapper}>"))


def sitemap_snapshots(region: DataFrame, nation: DataFrame, customer: DataFrame) -> DataFrame:
    """(url, status, xml) for every generated sitemap file.

    Nation sitemaps hold at most CHUNK customers each; region sitemaps list
    at most CHUNK chunk-groups; one region sitemap links back to the root
    (a cycle); one nation chunk in eleven answers 404.
    """
    cust = customer.select("c_custkey", "c_nationkey").withColumn(
        "chunk", F.floor(F.col("c_custkey") / CHUNK))
    nat_url = F.concat(F.lit(f"{SHOP}/sitemaps/nation_"), F.col("c_nationkey").cast("string"),
                       F.lit("_"), F.col("chunk").cast("string"), F.lit(".xml"))
    nat_maps = (cust.groupBy("c_nationkey", "chunk")
                .agg(F.concat_ws("", F.collect_list(_loc("url", F.concat(
                    F.lit(f"{SHOP}/it/customer/"), F.col("c_custkey").cast("string"))))).alias("body"))
                .select(nat_url.alias("url"),
                        F.when((F.col("c_nationkey") + F.col("chunk")) % 11 == 10, F.lit(404))
                         .otherwise(F.lit(200)).cast("int").alias("status"),
                        F.concat(F.lit(_URLSET), F.col("body"), F.lit("</urlset>")).alias("xml")))
    chunks = (cust.select("c_nationkey", "chunk").distinct()
              .join(nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey"), "c_nationkey")
              .select(F.col("n_regionkey").alias("r"), F.floor(F.col("chunk") / CHUNK).alias("g"),
                      nat_url.alias("loc")))
    reg_url = F.concat(F.lit(f"{SHOP}/sitemaps/region_"), F.col("r").cast("string"), F.lit("_"),
                       F.col("g").cast("string"), F.lit(".xml"))
    extra = (chunks.select("r", "g").distinct()
             .select("r", "g", F.concat(F.lit(f"{SHOP}/it/region/"), F.col("r").cast("string")).alias("loc"))
             .unionByName(chunks.filter((F.col("r") == 0) & (F.col("g") == 0)).select(
                 "r", "g", F.lit(SITEMAP_ROOT).alias("loc")).limit(1)))
    reg_maps = (chunks.unionByName(extra).groupBy("r", "g")
                .agg(F.concat_ws("", F.collect_list(_loc("sitemap", F.col("loc")))).alias("body"))
                .select(reg_url.alias("url"), F.lit(200).alias("status"),
                        F.concat(F.lit(_INDEX), F.col("body"), F.lit("</sitemapindex>")).alias("xml")))
    root_extra = F.concat(
        _loc("sitemap", F.lit(f"\n   {SHOP}/it/  ")),
        _loc("sitemap", F.lit(f"{SHOP}/feed?f=a.xml")),
        _loc("url", F.lit(f"{SHOP}/it/search?q=a&amp;p=2")))
    root = (chunks.select("r", "g").distinct()
            .agg(F.concat_ws("", F.collect_list(_loc("sitemap", reg_url))).alias("body"))
            .select(F.lit(SITEMAP_ROOT).alias("url"), F.lit(200).alias("status"),
                    F.concat(F.lit(_INDEX), F.col("body"), root_extra, F.lit("</sitemapindex>")).alias("xml")))
    cols = ["url", "status", "xml"]
    return nat_maps.select(*cols).unionByName(reg_maps.select(*cols)).unionByName(root.select(*cols))


# -- keywords ---------------------------------------------------------------

def keyword_seeds(part: DataFrame) -> DataFrame:
    """Seeds: the distinct first words of part names."""
    return part.select(F.split(F.col("p_name"), " ", 2).getItem(0).alias("seed")).distinct()


def keyword_corpus(part: DataFrame) -> DataFrame:
    """(keyword, popularity): part names and name + type, counted."""
    names = part.select(F.col("p_name").alias("keyword"))
    typed = part.select(F.concat_ws(" ", "p_name", F.lower("p_type")).alias("keyword"))
    return names.unionByName(typed).groupBy("keyword").agg(F.count(F.lit(1)).alias("popularity"))


def suggestion_payload_exprs() -> list[str]:
    """One captured response per part row; some are malformed by design."""
    return [
        "split(p_name, ' ', 2)[0] AS seed",
        "p_name AS query",
        "CASE WHEN p_partkey % 13 = 0 THEN 'not json' "
        "WHEN p_partkey % 17 = 0 THEN concat('[\"', p_name, '\"]') "
        "WHEN p_partkey % 19 = 0 THEN concat('[\"', p_name, '\",\"ab\"]') "
        "ELSE concat('[\"', p_name, '\",[\"', p_name, ' ', lower(p_type), '\",\"', p_name, ' ', "
        "lower(p_brand), '\"],[],{}]') END AS payload",
    ]


# -- captures ---------------------------------------------------------------

def _capture_time():
    return F.timestamp_seconds(F.col("page_id") + FIRST_CAPTURE)


def timed_page_snapshots(pages: DataFrame) -> DataFrame:
    """Page snapshots with a capture time, a second per page id."""
    return page_snapshots(pages).withColumn("fetched_at", _capture_time())


def captures(pages: DataFrame) -> DataFrame:
    """Page snapshots of which every third was captured a second time, a day later, with another title.

    A title is shared by up to five pages then.  Other columns of ``pages`` stay.
    """
    more = [c for c in pages.columns if c not in ("page_id", "url", "html")]
    first = apply_stages(pages, [[*s, *more] for s in page_snapshot_stages()]).withColumn("fetched_at", _capture_time())
    later = first.where("page_id % 3 = 0").select(
        *[c for c in first.columns if c not in ("html", "fetched_at")],
        F.regexp_replace("html", "<title>[^<]*</title>", F.concat(F.lit("<title>Pagina "), F.floor(F.col("page_id") / 15).cast("string"), F.lit("</title>"))).alias("html"),
        (F.col("fetched_at") + F.expr("INTERVAL 1 day")).alias("fetched_at"))
    return first.unionByName(later)


# -- audit exports ----------------------------------------------------------

def audit_export_exprs() -> list[str]:
    """Audit table -> the columns of an export, with a load time and NA tokens."""
    return [
        "`URL`", "CASE WHEN page_id % 13 = 0 THEN 'NA' ELSE CAST(`Status` AS STRING) END AS `Status`",
        "`Robots`", "`Title`", "`Lung. Title`", "`Meta Desc`",
        "CASE WHEN page_id % 11 = 0 THEN 'N/A' ELSE `H1` END AS `H1`", "`Img senza ALT`",
        "(page_id % 7) * 0.5D AS `Tempo (sec)`",
    ]


# -- browser performance entries from events --------------------------------
# The label -> URL dict of pages under test.
PAGES_TO_TEST = {
    "start": f"{SHOP}/it/",
    "listing": f"{SHOP}/it/scarpe",
    "item": f"{SHOP}/it/scarpe/modello-7.html",
}
CAPTURE_ERROR = "TimeoutError: page.goto: Timeout 60000ms exceeded"


def perf_entry_exprs() -> list[str]:
    """events -> perf entries (without url; joined from PAGES_TO_TEST).

    A (user, day) is one page view: views are LCP entries, clicks layout
    shifts, signups navigation entries, errors above 300 capture errors;
    other errors and purchases become resource / mark entries, which the
    report reads past.  Every event is an entry.
    """
    return [
        "concat(CAST(user_id AS STRING), '-', CAST(CAST(ts AS DATE) AS STRING)) AS view_id",
        "CASE user_id % 3 WHEN 0 THEN 'start' WHEN 1 THEN 'listing' ELSE 'item' END AS label",
        "event_id AS seq",
        "CASE event_type WHEN 'view' THEN 'largest-contentful-paint' WHEN 'click' THEN 'layout-shift' "
        "WHEN 'signup' THEN 'navigation' "
        "WHEN 'error' THEN CASE WHEN value > 300 THEN 'error' ELSE 'resource' END "
        "ELSE 'mark' END AS entry_type",
        "value * 10 AS start_ms",
        "CASE WHEN event_type = 'click' THEN value / 1000 ELSE value END AS value",
        "try_cast(regexp_extract(props, '\"k\": *([0-9]+)', 1) AS INTEGER) % 2 = 1 AS had_recent_input",
        "CASE WHEN event_type = 'signup' THEN value * 3 END AS response_start_ms",
        "CAST(1500 + (user_id % 7) * 300 AS DOUBLE) AS load_ms",
        # the wall-clock time read as UTC: the same instant in any session zone
        "CAST(concat(CAST(ts AS STRING), 'Z') AS TIMESTAMP) AS ts",
        f"CASE WHEN event_type = 'error' AND value > 300 THEN '{CAPTURE_ERROR}' END AS fetch_error",
    ]


def perf_entries(events: DataFrame, targets: DataFrame) -> DataFrame:
    """``targets``: (label, url), a fixed 3-row relation.

    It is sent to the entries: dealt by label, they would all lie in three tasks,
    as a stream's plan is not changed when the relation turns out small.
    """
    return events.selectExpr(*perf_entry_exprs()).join(F.broadcast(targets), "label")
