from sitelens.operators.sitemap import expand_sitemaps


def sm(*locs):
    return "<urlset>" + "".join(f"<url><loc>{x}</loc></url>" for x in locs) + "</urlset>"


def test_expand_with_cycle_failure_and_xml_query(spark):
    rows = [
        ("root.xml", 200, sm("a.xml", "b.xml")),
        ("a.xml", 200, sm("root.xml", "  /p1\n")),
        ("b.xml", 200, sm("/p1", "/p2", "c.xml", "/x?f=a.xml", "/q?a=1&amp;b=2")),
        ("c.xml", 404, sm("/never")),
        ("orphan.xml", 200, sm("/orphan")),
    ]
    maps = spark.createDataFrame(rows, "url string, status int, xml string")
    roots = spark.createDataFrame([("root.xml",)], "url string")
    got = sorted(r["url"] for r in expand_sitemaps(maps, roots).collect())
    assert got == ["/p1", "/p2", "/q?a=1&b=2"]


def test_comments_and_numeric_references(spark):
    from sitelens.operators.sitemap import sitemap_edges
    xml = ("<urlset><!-- <loc>/hidden</loc> --><loc>/a?x=1&#38;y=2</loc><loc>/b&#x26;amp;c</loc>"
           "<loc>/caff&#232;&#x1F600;</loc><loc>/d&lt;&#62;</loc><loc>/e&#0;</loc></urlset>")
    maps = spark.createDataFrame([("r.xml", 200, xml)], "url string, status int, xml string")
    got = [r["loc"] for r in sitemap_edges(maps).collect()]
    assert got == ["/a?x=1&y=2", "/b&amp;c", "/caffè\U0001F600", "/d<>", "/e&#0;"]
