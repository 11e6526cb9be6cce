import pytest
from conftest import snap_df

from sitelens.operators.structured import structured_data_audit


def ld(*blocks):
    return "".join(f'<script type="application/ld+json">{b}</script>' for b in blocks)


VALID = ('{"@type":"Product","offers":{"price":9.5,"priceCurrency":"EUR",'
         '"availability":"https://schema.org/InStock"}}')

CASES = [
    (ld(VALID), ("✅ SI", "9.5", "EUR", "🟢 Disponibile")),
    (ld('[{"@type":"Thing"},{"@type":["Product"],"offers":[{"price":"1"},{"price":"2"}]}]'),
     ("✅ SI", "1", "Mancante", "⚠️ Non specificata")),
    (ld('{"@type":"ProductGroup"}'), ("✅ SI", "Mancante", "Mancante", "⚠️ Non specificata")),
    (ld('{"@type":"Product","offers":[]}'), ("✅ SI", "N/D", "N/D", "N/D")),
    (ld('{"@type":"Product","offers":null}'), ("✅ SI", "N/D", "N/D", "N/D")),
    (ld('{"@graph":[{"@type":"Product"}]}'), ("❌ NO", "N/D", "N/D", "N/D")),
    (ld('{"@type":"Product",', VALID), ("✅ SI", "9.5", "EUR", "🟢 Disponibile")),
    (ld(VALID, VALID.replace("9.5", "10").replace("InStock", "OutOfStock")),
     ("✅ SI", "10", "EUR", "🔴 Esaurito")),
    (ld(VALID, '{"@type":"Product","offers":[]}'), ("✅ SI", "9.5", "EUR", "🟢 Disponibile")),
    (ld(VALID, '{"@type":"Product","offers":{"price":3,"availability":null}}'),
     ("✅ SI", "3", "Mancante", "🟢 Disponibile")),
    (ld('[{"@type":"Product","offers":[]},' + VALID + ']'), ("✅ SI", "N/D", "N/D", "N/D")),
    (ld('{"@type":"Product","offers":{"price":12.50}}'), ("✅ SI", "12.5", "Mancante", "⚠️ Non specificata")),
    (ld('{"@type":"Product","offers":{"price":null,"priceCurrency":"EUR"}}'),
     ("✅ SI", None, "EUR", "⚠️ Non specificata")),
    ("<p>no data</p>", ("❌ NO", "N/D", "N/D", "N/D")),
    (ld('{"@type":"Product","offers":{"price":1,"price":2,"priceCurrency":"EUR"}}'),
     ("✅ SI", "2", "EUR", "⚠️ Non specificata")),
    (ld('{"@type":"Product","offers":{"price":12500000.00,"priceCurrency":"VND"}}'),
     ("✅ SI", "12500000.0", "VND", "⚠️ Non specificata")),
    (ld('{"@type":"Product","offers":{"price":9.0}}'), ("✅ SI", "9.0", "Mancante", "⚠️ Non specificata")),
    (ld('{"@type":"Product","offers":{"price":1.5e3}}'), ("✅ SI", "1500.0", "Mancante", "⚠️ Non specificata")),
    (ld('{"@type":"Product","offers":{"price":true}}'), ("✅ SI", "True", "Mancante", "⚠️ Non specificata")),
    (ld('{"@type":"Product","offers":{"price":0.00001}}'), ("✅ SI", "1e-05", "Mancante", "⚠️ Non specificata")),
    (ld('{"@type":"Product","offers":{"price":2.5e16}}'), ("✅ SI", "2.5e+16", "Mancante", "⚠️ Non specificata")),
]


@pytest.mark.parametrize("html,expected", CASES)
def test_product_cases(spark, html, expected):
    snaps = snap_df(spark, [("https://s.it/p.html", 200, f"<html><head>{html}</head></html>")])
    urls = spark.createDataFrame([("https://s.it/p.html",)], "URL string")
    r = structured_data_audit(urls, snaps).first()
    assert (r["Prodotto Trovato"], r["Prezzo"], r["Valuta"], r["Disponibilità"]) == expected
    assert r["Errore"] is None


def test_http_error_missing_snapshot_and_filter(spark):
    snaps = snap_df(spark, [("https://s.it/a.html", 404, ld(VALID)),
                            ("https://s.it/b.html", None, None, None, "boom")])
    urls = spark.createDataFrame([("https://s.it/a.html",), ("https://s.it/b.html",),
                                  ("https://s.it/c.html",), ("https://s.it/d.HTML",), (None,)], "URL string")
    rows = {r["URL"]: r for r in structured_data_audit(urls, snaps).collect()}
    assert set(rows) == {"https://s.it/a.html", "https://s.it/b.html", "https://s.it/c.html"}
    a = rows["https://s.it/a.html"]
    assert (a["Prodotto Trovato"], a["Prezzo"], a["Valuta"], a["Disponibilità"]) == ("❌ NO", "Errore HTTP", None, "N/D")
    b = rows["https://s.it/b.html"]
    assert (b["Prodotto Trovato"], b["Errore"]) == ("Errore", "boom")
    assert rows["https://s.it/c.html"]["Prodotto Trovato"] == "Errore"


def test_url_column_required(spark):
    with pytest.raises(ValueError, match="URL"):
        structured_data_audit(spark.createDataFrame([("x",)], "link string"), None)


def test_latest_capture_of_a_product_page_counts(spark):
    from datetime import datetime
    page = '<script type="application/ld+json">{"@type": "Product", "offers": {"price": "%d", "priceCurrency": "EUR"}}</script>'
    rows = [("http://s/a.html", 200, page % p, None, datetime(2024, 1, d)) for p, d in ((5, 1), (7, 3), (6, 2))]
    snaps = spark.createDataFrame(rows, "url string, status int, html string, fetch_error string, fetched_at timestamp")
    urls = spark.createDataFrame([("http://s/a.html",)], "URL string")
    assert [r["Prezzo"] for r in structured_data_audit(urls, snaps).collect()] == ["7"]


@pytest.mark.parametrize("allowed", ["true", "false"])
def test_repeated_keys_do_not_depend_on_the_session(spark, allowed):
    """The last value counts at every level, as Python's parser has it."""
    key = "spark.sql.variant.allowDuplicateKeys"
    was = spark.conf.get(key, None)
    block = ('[{"@type":"Thing","@type":"Product","offers":{"price":1},"offers":[{"price":2.50,"price":19.90,'
             '"priceCurrency":"EUR","priceCurrency":"è€","availability":"x","availability":"InStock"}]}]')
    df = snap_df(spark, [("https://s/1.html", 200, ld(block, '{"a":1,"a":', '{"a":NaN,"a":2}'))])
    try:
        spark.conf.set(key, allowed)
        r = structured_data_audit(df.select("url"), df, url_col="url").first()
    finally:
        spark.conf.unset(key) if was is None else spark.conf.set(key, was)
    assert (r["Prodotto Trovato"], r["Prezzo"], r["Valuta"], r["Disponibilità"]) == ("✅ SI", "19.9", "è€", "🟢 Disponibile")
