from pyspark.sql import functions as F

from sitelens.operators.rules import duplicate_titles
from sitelens.plans.skew import join_group_stat


def hot_audit(spark, n=3000):
    rows = [(i, f"https://s.it/{i}", "Hot title" if i % 3 == 0 else f"title {i % 700}") for i in range(n)]
    return spark.createDataFrame(rows, "page_id long, URL string, Title string")


def test_hot_group_is_spread_and_exact(spark):
    # tiny test data would be coalesced into one task or broadcast: turn both
    # off to see the layout a large input gets
    confs = {"spark.sql.adaptive.coalescePartitions.enabled": "false",
             "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        df = hot_audit(spark)
        # 1000 hot rows, 100 rows per task -> the hot title gets 10 salts
        out = join_group_stat(df, ["Title"], [F.min("page_id").alias("first")], spread_by="page_id",
                              rows_per_task=100)
        hot = out.filter(F.col("Title") == "Hot title")
        assert hot.count() == 1000
        parts = {r[0] for r in hot.select(F.spark_partition_id()).collect()}
        assert len(parts) > 1
        assert {r["first"] for r in hot.select("first").distinct().collect()} == {0}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_duplicates_with_hot_title(spark):
    df = hot_audit(spark)
    got = {r["page_id"] for r in duplicate_titles(df, order_col="page_id", rows_per_task=50).collect()}
    seen, expected = set(), set()
    for i in range(3000):
        t = "Hot title" if i % 3 == 0 else f"title {i % 700}"
        if t in seen:
            expected.add(i)
        seen.add(t)
    assert got == expected
