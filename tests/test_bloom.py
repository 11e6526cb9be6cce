"""Bloom pruning: nothing listed is lost, little else passes, page bytes stay where they lie."""

import re

import pytest
from conftest import snap_df
from pyspark.sql import functions as F

from sitelens.operators.audit import page_audit
from sitelens.operators.backlinks import backlink_audit
from sitelens.operators.structured import structured_data_audit
from sitelens.plans.bloom import block_count, maybe_listed


def test_no_listed_key_is_lost_and_few_others_pass(spark):
    rows = spark.range(20_000).select(F.concat(F.lit("http://s/"), F.col("id")).alias("url"), F.lit("bytes").alias("html"))
    listed = spark.range(0, 20_000, 5).select(F.concat(F.lit("http://s/"), F.col("id")).alias("u"))
    got = maybe_listed(rows, "url", listed, "u")
    assert got.columns == ["url", "html"]
    assert got.join(listed, got["url"] == listed["u"], "left_semi").count() == 4_000
    assert got.count() < 4_000 + 16_000 * 0.02


def test_bounded_filter_lets_more_pass_but_loses_none(spark):
    rows = spark.range(5_000).select(F.col("id").cast("string").alias("url"))
    got = maybe_listed(rows, "url", rows.where("url < '5'"), max_bytes=512)
    assert got.where("url < '5'").count() == rows.where("url < '5'").count()
    assert block_count(10 ** 12) * 512 <= 32 << 20 and block_count(0) == 1


def test_null_keys_and_empty_lists(spark):
    rows = spark.createDataFrame([(None,), ("a",), ("",)], "url string")
    assert [r.url for r in maybe_listed(rows, "url", spark.createDataFrame([(None,), ("a",), ("a",)], "url string")).collect()] == ["a"]
    assert maybe_listed(rows, "url", spark.createDataFrame([], "url string")).count() == 0


@pytest.mark.parametrize("operator", ["page_audit", "backlink_audit", "structured_data"])
def test_no_exchange_carries_html(spark, operator, tmp_path):
    """With no list small enough to broadcast, page bytes still never leave the scan's stage."""
    rows = [(f"http://s/{i}.html", 200, f"<title>t{i}</title><a href='http://own/'>x</a>") for i in range(50)]
    path = str(tmp_path / "snaps")
    snap_df(spark, rows).write.parquet(path)
    snaps, urls = spark.read.parquet(path), spark.createDataFrame([(r[0],) for r in rows[:20]], "url string")
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for k, v in zip(before, ("-1", "false")):
            spark.conf.set(k, v)
        out = {"page_audit": lambda: page_audit(snaps, urls), "backlink_audit": lambda: backlink_audit(urls, snaps, "own", url_col="url"),
               "structured_data": lambda: structured_data_audit(urls.toDF("URL"), snaps)}[operator]()
        assert out.count() == 20
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    lines = plan.splitlines()
    html = next(m.group(0) for line in lines if "MapInArrow" not in line and (m := re.search(r"\bhtml#\d+", line)))
    deep = lambda line: len(re.match(r"[\s:+\-|*]*", line).group(0))
    for i, line in enumerate(lines):
        if re.search(r"\bExchange (hash|range|RoundRobin)", line):  # what it carries is the output of the node below it
            child = next(x for x in lines[i + 1:] if deep(x) > deep(line))
            assert html not in child and "html" not in line, (line, child)
    assert any("BroadcastHashJoin" in line for line in lines)
