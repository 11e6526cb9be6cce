"""Values probed independently on the raw sf0.01 pages."""

from pyspark.sql import functions as F

from sitelens.operators.audit import page_audit
from sitelens.operators.rules import rule_summary
from sitelens.sources.tables import read_table

SF = "/root/testdata/sf0.01"


def test_known_values_on_raw_pages(spark):
    pages = read_table(spark, SF, "pages", "url", "html").select(
        "url", F.lit(200).alias("status"), F.lit("text/html").alias("content_type"), "html",
        F.lit(None).cast("string").alias("fetch_error"))
    audit = page_audit(pages).cache()
    assert audit.count() == 250
    assert audit.select("URL").distinct().count() == 250
    s = {r["rule"]: r["n_pages"] for r in rule_summary(audit).collect()}
    assert (s["title_short"], s["title_long"], s["duplicate_title"]) == (30, 0, 66)
    assert audit.filter(F.col("H1") == "").count() == 0
    assert audit.filter(F.col("Title") == F.col("H1")).count() == 250
    assert audit.filter(F.col("URL").endswith(".html")).count() == 35
    assert audit.agg(F.sum("`Lung. Title`")).first()[0] == 12707
    hosts = audit.select(F.regexp_extract("URL", r"^[a-z]+://([^/?#]+)", 1).alias("h")).distinct()
    assert hosts.count() == 58
    audit.unpersist()


def test_all_links_sit_in_the_nav_list(spark):
    from sitelens.functions.html import with_elements
    pages = read_table(spark, SF, "pages", "url", "html")
    links = (with_elements(pages, keep=("a",), ancestors_for=("a",))
             .select(F.explode("elements").alias("e")))
    assert links.count() == 1413
    paths = {tuple(r[0]) for r in links.select("e.ancestors").distinct().collect()}
    assert paths == {("html", "body", "nav", "ul", "li")}
