"""End-to-end flows over snapshot tables, composed from the operators.

These chain the operators the way the original scripts were chained by hand
through CSV files, but lazily: nothing runs until a result is written.

* ``site_audit_flow``   sitemaps -> page URLs -> audit -> rule report,
                        priority pages, duplicate titles, product data
* ``backlink_flow``     backlink export -> quality report
* ``keyword_flow``      seeds -> probes -> suggestions -> keyword list
                        -> clusters and theme preview
* ``vitals_flow``       label -> URL dict + performance entries -> report
"""

from __future__ import annotations

from dataclasses import dataclass

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
from ..sources.tables import POSITION
from .bloom import maybe_listed
from .ranking import with_position


@dataclass
class SiteAudit:
    urls: DataFrame
    audit: DataFrame
    rules: DataFrame
    priority: DataFrame
    duplicates: DataFrame
    products: DataFrame


def site_audit_flow(spark: SparkSession, sitemaps: DataFrame, pages: DataFrame,
                    roots: list[str], strict: bool = False) -> SiteAudit:
    """``sitemaps``: url, status, xml.  ``pages``: url, status, content_type,
    html, fetch_error.  ``roots``: starting sitemap URLs."""
    root_df = spark.createDataFrame([(r,) for r in roots], "url string")
    urls = sitemap_ops.expand_sitemaps(sitemaps, root_df)
    return site_reports(pages, urls, strict=strict)


def site_reports(pages: DataFrame, urls: DataFrame, strict: bool = False) -> SiteAudit:
    """Audit, rules, priority, duplicates and products for a URL list, with
    one parse per page: the parsed pages (elements only, no HTML) are
    checkpointed once and read by the audit and the product check.

    One audit row per URL, that of its latest capture.  Duplicates follow the
    order of the input, if ``pages`` has a position column
    (``tables.with_input_position``), else that of URLs; either way there are
    as many as the rules count.
    """
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(pages.sparkSession)
    wanted = urls.select("url").distinct()
    place = (POSITION,) if POSITION in pages.columns else ()
    pages = maybe_listed(pages, "url", wanted)          # where they lie; the audit joins the list exactly
    parsed = audit_ops.parse_snapshots(pages, tags=audit_ops.AUDIT_TAGS + ("script",), keep=place).checkpoint()
    placed = audit_ops.page_audit(None, urls=wanted, parsed=parsed, strict=strict, latest=True, keep=place)
    order = place[0] if place else "URL"
    audit = placed.drop(*place)
    return SiteAudit(
        urls=urls,
        audit=audit,
        rules=rule_ops.rule_report(audit),
        priority=rule_ops.priority_pages(audit),
        duplicates=rule_ops.duplicate_titles(placed, order_col=order).orderBy(order).drop(*place),
        products=structured_ops.structured_data_audit(audit, None, parsed=parsed),
    )


def backlink_flow(export: DataFrame, pages: DataFrame, domain: str) -> DataFrame:
    return backlink_ops.backlink_audit(export, pages, domain)


@dataclass
class KeywordThemes:
    keywords: DataFrame
    clustered: DataFrame
    preview: DataFrame


def keyword_flow(seeds: DataFrame, corpus: DataFrame, k: int = 7,
                 top_n: int | None = None) -> KeywordThemes:
    """``seeds``: seed.  ``corpus``: keyword, popularity."""
    suggestions = keyword_ops.suggest_alphabet(seeds, corpus, top_n=top_n)
    keywords = keyword_ops.expand_keywords(suggestions)
    clustered = cluster_ops.cluster_keywords(keywords, k=k)
    return KeywordThemes(keywords=keyword_table(keywords), clustered=clustered_table(clustered),
                         preview=cluster_ops.theme_preview(clustered))


def vitals_flow(spark: SparkSession, entries: DataFrame, pages_to_test: dict[str, str]) -> DataFrame:
    """``entries``: perf entries without url; the label -> URL dict is joined in.

    A page under test without any entry gets an error row (null ``view_id``).
    """
    targets = vitals_ops.pages_to_test(spark, pages_to_test)
    return vitals_ops.vitals_report(entries.drop("url").join(targets, "label", "right"))


def keyword_table(keywords: DataFrame, position: str | None = None) -> DataFrame:
    """Report order: by seed, then keyword (code-point order); ``position`` adds each row's place as a column."""
    return _in_order(keywords, ["seed", "Keyword"], position)


def clustered_table(clustered: DataFrame, position: str | None = None) -> DataFrame:
    """Report order: by theme, then keyword; ``position`` as above."""
    return _in_order(clustered, ["Tema_Semantico", "Keyword"], position)


def _in_order(df: DataFrame, order: list[str], position: str | None) -> DataFrame:
    return with_position(df, order, position).orderBy(position) if position else df.orderBy(*order)
