"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver tables of ``sf_dir`` in full (through the
derivations in ``derive``) and runs one operator family on them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import audit as audit_ops
from ..operators import backlinks as backlink_ops
from ..operators import clustering as cluster_ops
from ..operators import keywords as keyword_ops
from ..operators import rules as rule_ops
from ..operators import sitemap as sitemap_ops
from ..operators import structured as structured_ops
from ..operators import vitals as vitals_ops
from ..session import scratch_path
from ..sinks.csv import write_csv, write_if_not_empty
from ..sources.csv import read_csv
from ..sources.tables import on_all_cores, read_table, stream_table, with_input_position
from ..streaming import page_audit as page_stream
from ..streaming import vitals as vitals_stream
from . import derive, flows
from .ranking import with_position

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def site_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.page_snapshots(on_all_cores(read_table(spark, sf_dir, "pages", "page_id", "url", "html")))


def site_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_ops.page_audit(site_snapshots(spark, sf_dir), keep=("page_id",))


# -- step 1-3: page audit and rule report ---------------------------------

@register("url_class")
def q_url_class(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages", "page_id", "url")
    return audit_ops.url_classes(pages)


@register("page_audit")
def q_page_audit(spark, sf_dir):
    return site_audit(spark, sf_dir)


@register("page_audit_strict")
def q_page_audit_strict(spark, sf_dir):
    return audit_ops.page_audit(site_snapshots(spark, sf_dir), strict=True, keep=("page_id",))


@register("audit_rule_summary")
def q_rule_summary(spark, sf_dir):
    return rule_ops.rule_summary(site_audit(spark, sf_dir).drop("page_id"))


@register("priority_pages")
def q_priority_pages(spark, sf_dir):
    return rule_ops.priority_pages(site_audit(spark, sf_dir))


@register("duplicate_titles")
def q_duplicate_titles(spark, sf_dir):
    dups = rule_ops.duplicate_titles(site_audit(spark, sf_dir), order_col="page_id")
    return dups.select("page_id", "URL", "Title")


@register("audit_rule_report")
def q_rule_report(spark, sf_dir):
    return rule_ops.rule_report(site_audit(spark, sf_dir).drop("page_id"))


@register("report_duplicates")
def q_report_duplicates(spark, sf_dir):
    """The site report's duplicate titles, in input order, where pages were captured twice."""
    pages = derive.captures(on_all_cores(with_input_position(read_table(spark, sf_dir, "pages", "page_id", "url", "html"))))
    dups = flows.site_reports(pages, pages.select("url")).duplicates
    listed = dups.select("URL", "Title", F.monotonically_increasing_id().alias("_order"))     # as the list stands
    return with_position(listed, ["_order"], "place").drop("_order")


def audit_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit as another crawler's export: with load times, and NA tokens in two columns."""
    return site_audit(spark, sf_dir).selectExpr(*derive.audit_export_exprs())


@register("csv_rule_report")
def q_csv_rule_report(spark, sf_dir):
    path = _run_dir(spark, "csv_rule_report")
    write_csv(audit_export(spark, sf_dir), path, bom=True)
    return rule_ops.rule_summary(read_csv(spark, path, multiLine=True))     # headings can hold line breaks


@register("priority_export")
def q_priority_export(spark, sf_dir):
    """The list of pages to fix first, written only if there are any, and read again."""
    path = _run_dir(spark, "priority_export")
    pages = rule_ops.priority_pages(site_audit(spark, sf_dir)).select("page_id", "URL", "Status", "Title", "H1")
    if not write_if_not_empty(pages, path):
        return spark.createDataFrame([], "page_id string, URL string, Status string, Title string, H1 string")
    return read_csv(spark, path, multiLine=True)


# -- step 4: structured data ----------------------------------------------

def shop_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages and product pages together, as one crawl of one site would be."""
    products = derive.product_snapshots(
        on_all_cores(read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_retailprice")))
    cols = ["url", "status", "content_type", "html", "fetch_error"]
    return site_snapshots(spark, sf_dir).select(*cols).unionByName(products.select(*cols))


@register("structured_data")
def q_structured_data(spark, sf_dir):
    snaps = shop_snapshots(spark, sf_dir)
    listed = snaps.select(F.col("url").alias("URL"))
    return structured_ops.structured_data_audit(listed, snaps)


# -- step 5: backlinks ------------------------------------------------------

def backlink_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "pages", "page_id", "url").selectExpr(*derive.backlink_export_exprs())


@register("url_column_detect")
def q_url_column_detect(spark, sf_dir):
    return backlink_ops.url_column(backlink_export(spark, sf_dir))


@register("backlink_audit")
def q_backlink_audit(spark, sf_dir):
    snaps = derive.backlink_snapshots(on_all_cores(read_table(spark, sf_dir, "pages", "page_id", "url", "html")))
    return backlink_ops.backlink_audit(backlink_export(spark, sf_dir), snaps, derive.OWN_DOMAIN)


@register("backlink_audit_gaps")
def q_backlink_audit_gaps(spark, sf_dir):
    """An export that lacks some of its URLs."""
    snaps = derive.backlink_snapshots(on_all_cores(read_table(spark, sf_dir, "pages", "page_id", "url", "html")))
    export = read_table(spark, sf_dir, "pages", "page_id", "url").select(F.when(F.col("page_id") % 9 != 0, F.col("url")).alias("Pagina"))
    return backlink_ops.backlink_audit(export, snaps, derive.OWN_DOMAIN, url_col="Pagina")


# -- step 6: sitemap expansion ---------------------------------------------

def site_sitemaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.sitemap_snapshots(read_table(spark, sf_dir, "region", "r_regionkey"),
                                    read_table(spark, sf_dir, "nation", "n_nationkey", "n_regionkey"),
                                    read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey"))


@register("sitemap_expand")
def q_sitemap_expand(spark, sf_dir):
    roots = spark.range(1).select(F.lit(derive.SITEMAP_ROOT).alias("url"))
    return sitemap_ops.expand_sitemaps(site_sitemaps(spark, sf_dir), roots)


@register("sitemap_edges")
def q_sitemap_edges(spark, sf_dir):
    return sitemap_ops.sitemap_edges(site_sitemaps(spark, sf_dir))


# -- step 7: keywords -------------------------------------------------------

def _part(spark, sf_dir, *cols):
    return read_table(spark, sf_dir, "part", *cols)


@register("keyword_probes")
def q_keyword_probes(spark, sf_dir):
    return keyword_ops.keyword_probes(derive.keyword_seeds(_part(spark, sf_dir, "p_name")))


def _suggestions(spark, sf_dir):
    part = _part(spark, sf_dir, "p_name", "p_type")
    return keyword_ops.suggest_alphabet(derive.keyword_seeds(part), derive.keyword_corpus(part))


@register("keyword_suggest_probes")
def q_keyword_suggest_probes(spark, sf_dir):
    """The general probe-table form of the same suggestions."""
    part = _part(spark, sf_dir, "p_name", "p_type")
    probes = keyword_ops.keyword_probes(derive.keyword_seeds(part))
    return keyword_ops.suggest(probes, derive.keyword_corpus(part))


@register("keyword_suggest")
def q_keyword_suggest(spark, sf_dir):
    return _suggestions(spark, sf_dir)


@register("keyword_suggestions")
@register("keyword_expand")
def q_keyword_expand(spark, sf_dir):
    return keyword_ops.expand_keywords(_suggestions(spark, sf_dir))


@register("keyword_preview")
def q_keyword_preview(spark, sf_dir):
    return keyword_ops.keyword_preview(keyword_ops.expand_keywords(_suggestions(spark, sf_dir)))


@register("keyword_order")
def q_keyword_order(spark, sf_dir):
    return flows.keyword_table(keyword_ops.expand_keywords(_suggestions(spark, sf_dir)), position="position")


@register("keyword_payloads")
def q_keyword_payloads(spark, sf_dir):
    payloads = _part(spark, sf_dir, "p_partkey", "p_name", "p_type", "p_brand").selectExpr(
        *derive.suggestion_payload_exprs())
    return keyword_ops.expand_keywords(keyword_ops.parse_payloads(payloads))


# -- step 8: TF-IDF, clustering, naming --------------------------------------

def _part_docs(spark, sf_dir):
    return _part(spark, sf_dir, "p_partkey", "p_name", "p_size").select(
        F.col("p_partkey").alias("doc_id"), F.col("p_name").alias("Keyword"), "p_size")


def _fixed_assignment(docs):
    """A fixed cluster assignment (p_size % 5) to check naming exactly."""
    return docs.select("doc_id", (F.col("p_size") % 5).cast("int").alias("Cluster_ID"))


@register("keyword_tfidf")
def q_keyword_tfidf(spark, sf_dir):
    w = cluster_ops.tfidf_long(_part_docs(spark, sf_dir))
    return w.select("doc_id", "term", F.round("weight", 6).alias("weight"))


@register("cluster_themes")
def q_cluster_themes(spark, sf_dir):
    docs = _part_docs(spark, sf_dir)
    return cluster_ops.cluster_names(cluster_ops.tfidf_long(docs), _fixed_assignment(docs))


@register("theme_preview")
def q_theme_preview(spark, sf_dir):
    docs = _part_docs(spark, sf_dir)
    asg = _fixed_assignment(docs)
    names = cluster_ops.cluster_names(cluster_ops.tfidf_long(docs), asg)
    clustered = docs.join(asg, "doc_id").join(names, "Cluster_ID", "left")
    return cluster_ops.theme_preview(clustered)


@register("cluster_order")
def q_cluster_order(spark, sf_dir):
    docs = _part_docs(spark, sf_dir)
    asg = _fixed_assignment(docs)
    names = cluster_ops.cluster_names(cluster_ops.tfidf_long(docs), asg)
    clustered = docs.join(asg, "doc_id").join(names, "Cluster_ID", "left").select("Keyword", "Tema_Semantico")
    return flows.clustered_table(clustered, position="position")


@register("keyword_cluster")
def q_keyword_cluster(spark, sf_dir):
    kw = keyword_ops.expand_keywords(_suggestions(spark, sf_dir)).select("Keyword")
    return cluster_ops.cluster_keywords(kw, k=7)


@register("keyword_cluster_clamped")
def q_keyword_cluster_clamped(spark, sf_dir):
    """More clusters asked for than a third of the keywords (the brands, one of them null)."""
    kw = _part(spark, sf_dir, "p_partkey", "p_brand").select(F.when(F.col("p_partkey") % 9 != 0, F.col("p_brand")).alias("Keyword")).distinct()
    return cluster_ops.cluster_keywords(kw, k=20)


# -- step 9: vitals ---------------------------------------------------------

def _entries(spark, events):
    return derive.perf_entries(events, vitals_ops.pages_to_test(spark, derive.PAGES_TO_TEST))


@register("vitals_report")
def q_vitals_report(spark, sf_dir):
    events = read_table(spark, sf_dir, "events")
    return vitals_ops.vitals_report(_entries(spark, events))


# -- step 10: streaming -----------------------------------------------------

def _run_dir(spark, name):
    import uuid
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def _stream_audit(spark, sources, base, **kw):
    """The sink's rows; its schema is given, as a run without pages writes no file to take it from."""
    page_stream.start_page_audit_stream(sources, f"{base}/out", f"{base}/ckpt", keep=("page_id",), **kw).awaitTermination()
    schema = page_stream.audit_stream(sources, keep=("page_id",), **kw).schema
    return spark.read.schema(schema).parquet(f"{base}/out")


@register("stream_page_audit")
def q_stream_page_audit(spark, sf_dir):
    pages = stream_table(spark, sf_dir, "pages", "page_id long, url string, html string")
    return _stream_audit(spark, pages, _run_dir(spark, "stream_page_audit"), prepare=derive.page_snapshots)


@register("stream_page_audit_once")
def q_stream_page_audit_once(spark, sf_dir):
    """Every capture is delivered twice, and audited once."""
    pages = stream_table(spark, sf_dir, "pages", "page_id long, url string, html string")
    again = stream_table(spark, sf_dir, "pages", "page_id long, url string, html string")
    audit = _stream_audit(spark, pages.unionByName(again), _run_dir(spark, "stream_page_audit_once"),
                          prepare=derive.timed_page_snapshots, once_within="3650 days")
    return audit.withColumn("fetched_at", F.unix_timestamp("fetched_at"))


@register("stream_vitals")
def q_stream_vitals(spark, sf_dir):
    base = _run_dir(spark, "stream_vitals")
    table = read_table(spark, sf_dir, "events")
    # dealt over all tasks, as narrow rows, whatever splits the backlog comes in
    events = stream_table(spark, sf_dir, "events", table.schema).repartition("event_id", "user_id", "ts")
    entries = _entries(spark, events)

    def run():
        vitals_stream.start_vitals_stream(entries, f"{base}/out", f"{base}/ckpt", closing=f"{base}/closing").awaitTermination()

    run()
    last = _entries(spark, table).agg(F.max("ts")).first()[0]
    if last is not None:        # the capture has ended: no entry comes to close the last views
        vitals_stream.close_views(spark, f"{base}/closing", entries.schema, last)
        run()
    return spark.read.schema("view_id string, Tipo string, URL string, TTFB string, LCP string, CLS double, Giudizio string, Errore string, lcp_observed boolean").parquet(f"{base}/out")
