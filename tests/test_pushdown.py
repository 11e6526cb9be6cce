import contextlib
import io
import tempfile

from pyspark.sql import functions as F

from sitelens.operators.audit import page_audit
from sitelens.operators.structured import structured_data_audit
from sitelens.plans.queries import shop_snapshots

SMALL = "/root/testdata/sf0.001"


def plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_filters_reach_snapshot_scan(spark):
    d = tempfile.mkdtemp(prefix="sitelens-test-")
    shop_snapshots(spark, SMALL).write.parquet(f"{d}/snap")
    snaps = spark.read.parquet(f"{d}/snap")
    text = plan(page_audit(snaps))
    assert "IsNull(fetch_error)" in text and "StringContains(content_type,text/html)" in text
    assert "ReadSchema: struct<url:string,status:int,content_type:string,html:string,fetch_error:string>" in text
    listed = snaps.select(F.col("url").alias("URL"))
    text = plan(structured_data_audit(listed, snaps))
    assert "StringEndsWith(url,.html)" in text
    assert page_audit(snaps).count() > 0
