import glob
import json
import tempfile

from pyspark.sql import functions as F

from sitelens.__main__ import main
from sitelens.plans import derive
from sitelens.plans.queries import shop_snapshots, site_sitemaps
from sitelens.sources.tables import read_table

SMALL = "/root/testdata/sf0.001"


def written(path):
    return glob.glob(f"{path}/**/part-*.csv", recursive=True)


def test_every_subcommand_writes_its_report(spark):
    d = tempfile.mkdtemp(prefix="sitelens-cli-")
    snaps = shop_snapshots(spark, SMALL)
    snaps.write.parquet(f"{d}/pages")
    site_sitemaps(spark, SMALL).write.parquet(f"{d}/sitemaps")
    pages = read_table(spark, SMALL, "pages", "page_id", "url", "html")
    derive.backlink_snapshots(pages).withColumn("content_type", F.lit("text/html")) \
        .write.parquet(f"{d}/sources")
    pages.select(F.col("url").alias("Pagina"), "page_id").write.option("header", True).csv(f"{d}/export")
    part = read_table(spark, SMALL, "part", "p_partkey", "p_name", "p_type", "p_brand")
    derive.keyword_corpus(part).write.parquet(f"{d}/corpus")
    part.selectExpr(*derive.suggestion_payload_exprs()).write.parquet(f"{d}/payloads")
    events = read_table(spark, SMALL, "events")
    events.selectExpr(*derive.perf_entry_exprs()).write.parquet(f"{d}/entries")
    snaps.select(F.col("url").alias("URL")).write.option("header", True).csv(f"{d}/audit_csv")

    main(["audit", "--sitemaps", f"{d}/sitemaps", "--pages", f"{d}/pages",
          "--root", derive.SITEMAP_ROOT, "--out", f"{d}/o1"])
    assert written(f"{d}/o1/rules") and written(f"{d}/o1/products")
    main(["products", "--audit", f"{d}/audit_csv", "--pages", f"{d}/pages", "--out", f"{d}/o2"])
    assert written(f"{d}/o2/products")
    main(["backlinks", "--export", f"{d}/export", "--pages", f"{d}/sources",
          "--domain", derive.OWN_DOMAIN, "--out", f"{d}/o3"])
    assert written(f"{d}/o3/backlinks")
    main(["keywords", "--seeds", "small,red", "--corpus", f"{d}/corpus", "--out", f"{d}/o4"])
    assert written(f"{d}/o4/keywords")
    main(["keywords", "--seeds", "x", "--payloads", f"{d}/payloads", "--out", f"{d}/o5"])
    assert written(f"{d}/o5/keywords")
    kw = sorted(written(f"{d}/o4/keywords"))
    main(["cluster", "--keywords", f"{d}/o4/keywords", "--k", "3", "--out", f"{d}/o6"]) if kw else None
    assert written(f"{d}/o6/clustered") and written(f"{d}/o6/preview")
    main(["vitals", "--entries", f"{d}/entries", "--pages-to-test", json.dumps(derive.PAGES_TO_TEST),
          "--out", f"{d}/o7"])
    assert written(f"{d}/o7/vitals")
