"""Command line: one subcommand per report, snapshot tables in, CSV out.

    python -m sitelens audit     --sitemaps S --pages P --root URL --out DIR [--strict]
                                 (audit, rules, priority, duplicates, products)
    python -m sitelens report    --audit audit.csv --out DIR
    python -m sitelens products  --audit audit.csv --pages P --out DIR
    python -m sitelens backlinks --export export.csv --pages P --domain D --out DIR
    python -m sitelens keywords  --seeds "a,b" (--corpus C | --payloads Y) --out DIR
    python -m sitelens cluster   --keywords keywords.csv --k 7 --out DIR
    python -m sitelens vitals    --entries E --pages-to-test '{"HOME": "https://..."}' --out DIR

Snapshot tables (S, P, C, Y, E) are parquet folders by default
(``--format`` to change).  CSV inputs may hold line breaks in quotes, which
makes each file one task; ``--one-line-rows`` reads large ones in splits.
Reports are headered CSV folders; rules come as (rule, severity, n_pages,
n_total), duplicate titles in input order; the backlink report carries a byte-order mark; the priority list is written only when it
has rows.  The Spark session comes from the environment (spark-submit) or
a local one.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from .operators import backlinks as backlink_ops
from .operators import clustering as cluster_ops
from .operators import keywords as keyword_ops
from .operators import rules as rule_ops
from .operators import structured as structured_ops
from .plans import flows
from .sinks.csv import write_csv, write_if_not_empty
from .sources.csv import read_csv
from .sources.tables import POSITION, with_input_position


def _session() -> SparkSession:
    # master, sizes and partitions are those of the submit command
    return SparkSession.builder.appName("sitelens").getOrCreate()


def _table(spark, path, fmt):
    return spark.read.format(fmt).load(path)


def _csv(spark, path, a, **kw):
    # titles and headings can hold line breaks; --one-line-rows reads a large export in splits
    return read_csv(spark, path, multiLine=not a.one_line_rows, **kw)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="sitelens")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ("audit", "report", "products", "backlinks", "keywords", "cluster", "vitals"):
        p = sub.add_parser(name)
        p.add_argument("--out", required=True)
        p.add_argument("--format", default="parquet")
        p.add_argument("--one-line-rows", action="store_true")
        if name == "audit":
            p.add_argument("--sitemaps", required=True)
            p.add_argument("--pages", required=True)
            p.add_argument("--root", required=True, action="append")
            p.add_argument("--strict", action="store_true")
        if name in ("report", "products"):
            p.add_argument("--audit", required=True)
        if name in ("products", "backlinks"):
            p.add_argument("--pages", required=True)
        if name == "backlinks":
            p.add_argument("--export", required=True)
            p.add_argument("--domain", required=True)
        if name == "keywords":
            p.add_argument("--seeds", required=True)
            p.add_argument("--corpus")
            p.add_argument("--payloads")
            p.add_argument("--top-n", type=int, default=None)
        if name == "cluster":
            p.add_argument("--keywords", required=True)
            p.add_argument("--k", type=int, default=7)
        if name == "vitals":
            p.add_argument("--entries", required=True)
            p.add_argument("--pages-to-test", required=True)
    a = ap.parse_args(argv)
    spark = _session()
    out = a.out.rstrip("/")

    if a.cmd == "audit":
        r = flows.site_audit_flow(spark, _table(spark, a.sitemaps, a.format),
                                  with_input_position(_table(spark, a.pages, a.format)), a.root, strict=a.strict)
        write_csv(r.audit, f"{out}/audit")
        write_csv(r.rules, f"{out}/rules")
        write_if_not_empty(r.priority, f"{out}/priority")
        write_csv(r.duplicates, f"{out}/duplicate_titles")
        write_csv(r.products, f"{out}/products")     # same parse as the audit
    elif a.cmd == "report":
        placed = _csv(spark, a.audit, a, position=POSITION)
        audit = placed.drop(POSITION)
        write_csv(rule_ops.rule_report(audit), f"{out}/rules")
        write_if_not_empty(rule_ops.priority_pages(audit), f"{out}/priority")
        if "Title" in audit.columns:
            write_csv(rule_ops.duplicate_titles(placed, order_col=POSITION).orderBy(POSITION).drop(POSITION), f"{out}/duplicate_titles")
    elif a.cmd == "products":
        write_csv(structured_ops.structured_data_audit(_csv(spark, a.audit, a),
                                                       _table(spark, a.pages, a.format)),
                  f"{out}/products")
    elif a.cmd == "backlinks":
        write_csv(backlink_ops.backlink_audit(_csv(spark, a.export, a),
                                              _table(spark, a.pages, a.format), a.domain),
                  f"{out}/backlinks", bom=True)
    elif a.cmd == "keywords":
        seeds = spark.createDataFrame([(s.strip(),) for s in a.seeds.split(",") if s.strip()], "seed string")
        if a.payloads:
            sugg = keyword_ops.parse_payloads(_table(spark, a.payloads, a.format))
        else:
            sugg = keyword_ops.suggest_alphabet(seeds, _table(spark, a.corpus, a.format), top_n=a.top_n)
        # one keyword list per seed, as one file per seed would be
        write_csv(flows.keyword_table(keyword_ops.expand_keywords(sugg)), f"{out}/keywords",
                  partition_by=("seed",))
    elif a.cmd == "cluster":
        clustered = cluster_ops.cluster_keywords(_csv(spark, a.keywords, a), k=a.k)
        write_csv(flows.clustered_table(clustered), f"{out}/clustered")
        write_csv(cluster_ops.theme_preview(clustered), f"{out}/preview")
    elif a.cmd == "vitals":
        report = flows.vitals_flow(spark, _table(spark, a.entries, a.format), json.loads(a.pages_to_test))
        write_csv(report, f"{out}/vitals")


if __name__ == "__main__":
    main()
