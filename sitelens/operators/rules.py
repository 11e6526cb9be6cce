"""Rule report over an audit table: counts per rule, priority pages, duplicates.

Works on any audit table with (a subset of) the audit columns -- the one
``page_audit`` builds or one read from another crawler's CSV.  A rule whose
columns are absent is left out, as the original report does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import MISSING, any_of, is_missing
from ..plans.skew import ROWS_PER_TASK, join_group_stat

# Rule thresholds.
TITLE_SHORT_BELOW = 30
TITLE_LONG_ABOVE = 60
SLOW_SECONDS = 2.0
OK_STATUS = 200
NOINDEX = "noindex"
# How the printed report marks each rule.
SEVERITY = {
    "broken_status": "error", "title_missing": "warning", "title_short": "warning", "title_long": "warning",
    "meta_desc_missing": "warning", "h1_missing": "warning", "img_missing_alt": "notice", "slow_page": "notice",
    "noindex": "notice", "duplicate_title": "notice", "priority": "error",
}


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _num(name: str) -> Column:
    return F.expr(f"try_cast(`{name}` AS DOUBLE)")


def broken_status() -> Column:
    """Numeric status other than 200; null or non-numeric counts as broken."""
    return ~_num("Status").eqNullSafe(F.lit(float(OK_STATUS)))


def rule_predicates(cols) -> dict[str, Column]:
    """Row predicates for the rules whose columns exist (plan-time check)."""
    cols = set(cols)
    preds: dict[str, Column] = {}
    if "Status" in cols:
        preds["broken_status"] = broken_status()
    if "Title" in cols:
        preds["title_missing"] = is_missing(_c("Title"))
        if "Lung. Title" in cols:
            n = _num("Lung. Title")
            preds["title_short"] = ((n > 0) & (n < TITLE_SHORT_BELOW)).eqNullSafe(True)
            preds["title_long"] = (n > TITLE_LONG_ABOVE).eqNullSafe(True)
    if "Meta Desc" in cols:
        preds["meta_desc_missing"] = is_missing(_c("Meta Desc"))
    if "H1" in cols:
        preds["h1_missing"] = is_missing(_c("H1"))
    if "Img senza ALT" in cols:
        preds["img_missing_alt"] = (_num("Img senza ALT") > 0).eqNullSafe(True)
    if "Tempo (sec)" in cols:
        preds["slow_page"] = (_num("Tempo (sec)") > SLOW_SECONDS).eqNullSafe(True)
    if "Robots" in cols:
        preds["noindex"] = F.lower(F.coalesce(_c("Robots").cast("string"), F.lit(""))).contains(NOINDEX)
    return preds


def priority_predicate(cols) -> Column:
    """Broken OR title missing OR H1 missing; absent columns add nothing."""
    preds = rule_predicates(cols)
    return any_of(preds[r] for r in ("broken_status", "title_missing", "h1_missing") if r in preds)


def _not_placeholder_title() -> Column:
    return ~_c("Title").eqNullSafe(F.lit(MISSING))


def _rule_counts(audit: DataFrame) -> DataFrame:
    """One row: the number of audited pages, and of those each rule finds, in one pass."""
    preds = rule_predicates(audit.columns)
    aggs = [F.count(F.lit(1)).alias("total")]
    aggs += [F.count_if(p).alias(r) for r, p in preds.items()]
    if "Title" in audit.columns:
        # every occurrence after the first; nulls are equal to each other
        keep = _not_placeholder_title()
        aggs.append((F.count_if(keep) - F.count_distinct(
            F.when(keep, F.struct(_c("Title"))))).alias("duplicate_title"))
    aggs.append(F.count_if(priority_predicate(audit.columns)).alias("priority"))
    return audit.agg(*aggs)


def rule_summary(audit: DataFrame) -> DataFrame:
    """(rule, n_pages) -- one pass over the audit table for all rules."""
    wide = _rule_counts(audit)
    return wide.unpivot([], list(wide.columns), "rule", "n_pages")


def rule_report(audit: DataFrame) -> DataFrame:
    """(rule, severity, n_pages, n_total): the summary with each rule's severity, and the number of pages audited."""
    wide = _rule_counts(audit)
    names = [c for c in wide.columns if c != "total"]
    severity = F.create_map(*[F.lit(x) for r in names for x in (r, SEVERITY[r])])
    return (wide.unpivot(["total"], names, "rule", "n_pages")
            .select("rule", severity[F.col("rule")].alias("severity"), "n_pages", F.col("total").alias("n_total")))


def priority_pages(audit: DataFrame) -> DataFrame:
    """Pages to fix first: all audit columns, priority rows only."""
    return audit.filter(priority_predicate(audit.columns))


def duplicate_titles(audit: DataFrame, order_col: str | None = None,
                     rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Every row whose title already appeared on an earlier row (input order).

    Placeholder titles are not reported; null titles are.  The first row per
    title is found with a partial aggregate and joined back on a key salted
    for hot titles only, so a title shared by a large share of pages is
    spread over as many tasks as its size needs.
    ``order_col``: the rows' order, a value that no two rows share (page id,
    URL of one row per URL, ``tables.with_input_position``); without it the
    order in which Spark reads the audit.  As many rows come back as
    ``rule_summary`` counts.
    The salted rows are checkpointed once (eager), so an audit coming out of
    the HTML stage is not parsed twice.
    """
    df = audit
    if order_col is None:
        order_col = "_row"
        df = df.withColumn(order_col, F.monotonically_increasing_id())
    cand = df.filter(_not_placeholder_title())
    with_first = join_group_stat(cand, ["Title"], [F.min(order_col).alias("_first")],
                                 spread_by=order_col, rows_per_task=rows_per_task,
                                 materialize=True)
    out = with_first.filter(F.col(order_col) > F.col("_first")).drop("_first")
    return out.drop("_row") if order_col == "_row" else out
