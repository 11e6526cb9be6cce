from conftest import snap_df

from sitelens.operators.audit import page_audit

HEAD = "<html><head>{}</head><body>{}</body></html>"


def audit(spark, head, body="", strict=False, **kw):
    df = snap_df(spark, [("https://s.it/it/x", 200, HEAD.format(head, body), *kw.get("extra", ()))])
    rows = page_audit(df, strict=strict).collect()
    return rows[0].asDict() if rows else None


def test_title_cases(spark):
    r = audit(spark, "")
    assert (r["Title"], r["Lung. Title"]) == ("Mancante", 0)
    r = audit(spark, "<title> </title>")
    assert (r["Title"], r["Lung. Title"]) == ("", 0)
    r = audit(spark, "<title>a&amp;b</title>")
    assert (r["Title"], r["Lung. Title"]) == ("a&b", 3)


def test_meta_description(spark):
    assert audit(spark, '<meta name="description" content="">')["Meta Desc"] == ""
    assert audit(spark, '<meta name="description">')["Meta Desc"] == "Mancante"
    assert audit(spark, '<meta name="description" content=" hi ">')["Meta Desc"] == "hi"


def test_canonical_and_robots(spark):
    r = audit(spark, '<link rel="canonical">')
    assert r["Canonical"] is None
    assert audit(spark, '<link rel="canonical">', strict=True) is None
    assert audit(spark, '<link rel="alternate canonical" href="/c">')["Canonical"] == "/c"
    assert audit(spark, "")["Canonical"] == "Mancante"
    assert audit(spark, "")["Robots"] == "index, follow"
    assert audit(spark, '<meta name="robots" content="noindex">')["Robots"] == "noindex"


def test_headings_and_images(spark):
    r = audit(spark, "", "<h1></h1><h2>a</h2><h2>b</h2><img><img alt=\" \"><img alt=\"x\">")
    assert r["H1"] == ""
    assert (r["H2 Totali"], r["Img Totali"], r["Img senza ALT"]) == (2, 3, 2)
    assert audit(spark, "", "<h1> <b>Hi</b> </h1>")["H1"] == "Hi"
    assert audit(spark, "")["H1"] == "Mancante"


def test_non_html_and_errors_dropped(spark):
    df = snap_df(spark, [("u1", 200, "<title>x</title>", "image/png"),
                         ("u2", 200, "<title>x</title>", None),
                         ("u3", None, None, None, "timeout"),
                         ("u4", 404, "<title>x</title>")])
    rows = page_audit(df).collect()
    assert [(r["URL"], r["Status"]) for r in rows] == [("u4", 404)]


def test_url_list_join(spark):
    df = snap_df(spark, [("u1", 200, "<title>x</title>"), ("u2", 200, "<title>y</title>")])
    urls = spark.createDataFrame([("u2",), ("u9",)], "url string")
    assert [r["URL"] for r in page_audit(df, urls=urls).collect()] == ["u2"]


def test_title_length_counts_code_points(spark):
    r = audit(spark, "<title>a😀b é</title>")
    assert (r["Title"], r["Lung. Title"]) == ("a😀b é", len("a😀b é"))
