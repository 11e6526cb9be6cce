import __spark_entry__ as se

SMALL = "/root/testdata/sf0.001"


def rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_stream_audit_equals_batch(spark):
    q = se.queries()
    assert rows(q["stream_page_audit"](spark, SMALL)) == rows(q["page_audit"](spark, SMALL))


def test_stream_vitals_equals_batch(spark):
    q = se.queries()
    assert rows(q["stream_vitals"](spark, SMALL)) == rows(q["vitals_report"](spark, SMALL))


def test_stream_audit_of_redelivered_pages(spark):
    q = se.queries()
    once = q["stream_page_audit_once"](spark, SMALL)
    assert rows(once.drop("fetched_at")) == rows(q["page_audit"](spark, SMALL))


def as_folder(spark, name):
    """A copy of a small table as a folder of several files, as clusters write it."""
    import tempfile
    d = tempfile.mkdtemp(prefix="sitelens-test-")
    spark.read.parquet(f"{SMALL}/{name}.parquet").repartition(3).write.parquet(f"{d}/{name}.parquet")
    return d


def test_stream_audit_of_a_table_in_many_files(spark):
    q = se.queries()
    d = as_folder(spark, "pages")
    want = rows(q["page_audit"](spark, SMALL))
    assert rows(q["stream_page_audit"](spark, d)) == want


def test_stream_audit_once_of_a_table_in_many_files(spark):
    q = se.queries()
    d = as_folder(spark, "pages")
    want = rows(q["page_audit"](spark, SMALL))
    assert rows(q["stream_page_audit_once"](spark, d).drop("fetched_at")) == want


def test_stream_vitals_of_a_table_in_many_files(spark):
    q = se.queries()
    d = as_folder(spark, "events")
    want = rows(q["vitals_report"](spark, SMALL))
    assert rows(q["stream_vitals"](spark, d)) == want


def test_stream_of_a_partitioned_table_has_its_partition_column(spark):
    import tempfile

    from sitelens.sources.tables import stream_table
    d = tempfile.mkdtemp(prefix="sitelens-test-")
    for k in (1, 2):
        spark.createDataFrame([(k * 10,)], "x long").write.parquet(f"{d}/t.parquet/k={k}")
    spark.createDataFrame([(0, 0)], "x long, k int").write.parquet(f"{d}/other.parquet")
    t = stream_table(spark, d, "t", "x long, k int")
    t.writeStream.format("parquet").option("path", f"{d}/out").option("checkpointLocation", f"{d}/ckpt").trigger(availableNow=True).start().awaitTermination()
    assert rows(spark.read.schema("x long, k int").parquet(f"{d}/out")) == [(1, 10), (2, 20)]


def test_stream_audit_of_no_pages(spark):
    import tempfile
    q = se.queries()
    d = tempfile.mkdtemp(prefix="sitelens-test-")
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{d}/pages.parquet")
    for name in ("stream_page_audit", "stream_page_audit_once"):
        assert q[name](spark, d).collect() == []
    assert q["stream_page_audit"](spark, d).schema.names == q["page_audit"](spark, SMALL).schema.names


def test_stream_entries_are_dealt_over_all_tasks(spark, monkeypatch):
    """By their own key, never by the three labels of the pages under test."""
    import contextlib
    import io

    from sitelens.plans import queries
    start, seen = queries.vitals_stream.start_vitals_stream, []

    def watched(entries, *args, **kw):
        seen.append(entries)
        return start(entries, *args, **kw)

    monkeypatch.setattr(queries.vitals_stream, "start_vitals_stream", watched)
    streamed = queries.q_stream_vitals(spark, SMALL)
    assert rows(streamed) == rows(queries.q_vitals_report(spark, SMALL))
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        seen[0].explain()
    assert "hashpartitioning(label" not in text.getvalue() and "SortMergeJoin" not in text.getvalue()
    assert "hashpartitioning(event_id" in text.getvalue()


def test_a_capture_delivered_again_later_gives_one_row(spark):
    import tempfile

    from pyspark.sql import functions as F

    from sitelens.operators.audit import page_audit
    from sitelens.plans.queries import site_snapshots
    from sitelens.sources.snapshots import PAGE_SNAPSHOT
    from sitelens.streaming.page_audit import start_page_audit_stream
    d = tempfile.mkdtemp(prefix="sitelens-test-")
    snaps = site_snapshots(spark, SMALL).withColumn("fetched_at", F.timestamp_seconds(F.col("page_id") + 1_700_000_000)).drop("page_id")
    recaptured = snaps.limit(5).withColumn("fetched_at", F.col("fetched_at") + F.expr("INTERVAL 1 hour"))
    for i, part in enumerate([snaps.where("url < 'https://n'"), snaps, snaps, recaptured]):     # twice again, then new captures
        part.select(*PAGE_SNAPSHOT.names).write.parquet(f"{d}/in/part={i}")
        src = spark.readStream.schema(PAGE_SNAPSHOT).parquet(f"{d}/in/*")
        start_page_audit_stream(src, f"{d}/out", f"{d}/ckpt", once_within="2 days").awaitTermination()
    want = page_audit(snaps.unionByName(recaptured), keep=("fetched_at",))
    assert rows(spark.read.parquet(f"{d}/out")) == rows(want)


def test_incremental_audit_resumes_from_checkpoint(spark):
    import tempfile

    from pyspark.sql import functions as F

    from sitelens.plans.queries import site_snapshots
    from sitelens.sources.snapshots import PAGE_SNAPSHOT
    from sitelens.streaming.page_audit import start_page_audit_stream
    d = tempfile.mkdtemp(prefix="sitelens-test-")
    snaps = site_snapshots(spark, SMALL).drop("page_id").withColumn(
        "fetched_at", F.lit(None).cast("timestamp"))
    first, second = snaps.filter("url < 'https://n'"), snaps.filter("url >= 'https://n'")
    first.write.parquet(f"{d}/in/part=1")
    src = spark.readStream.schema(PAGE_SNAPSHOT).parquet(f"{d}/in/*")
    start_page_audit_stream(src, f"{d}/out", f"{d}/ckpt").awaitTermination()
    n1 = spark.read.parquet(f"{d}/out").count()
    # new snapshots arrive; the restarted stream only processes them
    second.write.parquet(f"{d}/in/part=2")
    src = spark.readStream.schema(PAGE_SNAPSHOT).parquet(f"{d}/in/*")
    start_page_audit_stream(src, f"{d}/out", f"{d}/ckpt").awaitTermination()
    out = spark.read.parquet(f"{d}/out")
    assert n1 > 0 and out.count() > n1
    assert out.count() == out.select("URL").distinct().count()
    assert out.count() == se.queries()["page_audit"](spark, SMALL).count()


def test_stream_writes_each_view_once_also_across_midnight(spark):
    import tempfile

    from pyspark.sql import functions as F

    from sitelens.operators.vitals import vitals_report
    from sitelens.streaming import vitals as vs
    d = tempfile.mkdtemp(prefix="sitelens-test-")
    schema = ("view_id string, seq long, entry_type string, ts string, start_ms double, "
              "response_start_ms double, value double, fetch_error string")
    before, after = "2024-01-01 23:59:59", "2024-01-02 00:00:01"
    entries = spark.createDataFrame([
        ("v", 1, "navigation", before, 0.0, 120.0, None, None),
        ("v", 2, "layout-shift", before, 0.0, None, 0.1, None),
        ("v", 3, "largest-contentful-paint", after, 2800.0, None, None, None),
        ("v", 4, "layout-shift", after, 0.0, None, 0.2, None),
        ("w", 1, "error", before, 0.0, None, None, "first"),
        ("w", 2, "error", after, 0.0, None, None, "second"),
    ], schema).selectExpr("* except (ts)", "cast(ts as timestamp) as ts", "'HOME' as label", "'https://s.it/' as url",
                          "false as had_recent_input", "1000D as load_ms")
    entries.write.parquet(f"{d}/in")
    stored = spark.read.parquet(f"{d}/in")

    def run():
        source = spark.readStream.schema(stored.schema).parquet(f"{d}/in")
        vs.start_vitals_stream(source, f"{d}/out", f"{d}/ckpt", gap="1 hour", closing=f"{d}/closing").awaitTermination()
        return spark.read.schema("view_id string, TTFB string, LCP string, CLS double, Errore string, Tipo string, URL string, Giudizio string, lcp_observed boolean").parquet(f"{d}/out")

    assert run().count() == 0                       # both views are open
    # the next day moves the watermark past them: one row each, x stays open
    later = entries.where("view_id = 'v'").withColumn("view_id", F.lit("x")).withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 day"))
    later.write.mode("append").parquet(f"{d}/in")
    assert rows(run().select("view_id")) == [("v",), ("w",)]
    # an entry of v that comes too late changes nothing
    entries.where("view_id = 'v' AND seq = 4").withColumn("seq", F.lit(9).cast("long")).write.mode("append").parquet(f"{d}/in")
    vs.close_views(spark, f"{d}/closing", stored.schema, later.agg(F.max("ts")).first()[0], gap="1 hour")
    streamed = run()
    batch = vitals_report(entries.unionByName(later))
    cols = sorted(batch.columns)
    assert rows(streamed.select(*cols)) == rows(batch.select(*cols))
    assert rows(run().select(*cols)) == rows(batch.select(*cols))       # nothing is written twice
    out = {r["view_id"]: r for r in streamed.collect()}
    assert (out["v"]["TTFB"], out["v"]["LCP"], out["v"]["CLS"]) == ("120ms", "2.8s", 0.3)
    assert out["w"]["Errore"] == "first" and len(out) == 3
