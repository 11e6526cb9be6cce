from conftest import snap_df

from sitelens.operators.backlinks import backlink_audit, detect_url_column, url_column

DOM = "own.example"
A = f'<a href="https://{DOM}/p">link</a>'


def run(spark, pages):
    snaps = snap_df(spark, [(f"http://src/{i}", st, h) for i, (st, h) in enumerate(pages)])
    src = spark.createDataFrame([(f"site{i}", f"http://src/{i}") for i in range(len(pages))],
                                "name string, link string")
    rows = backlink_audit(src, snaps, DOM).collect()
    by = {r["URL Sorgente"]: r for r in rows}
    return [by[f"http://src/{i}"] for i in range(len(pages))]


def test_tiers(spark):
    rows = run(spark, [
        (500, A),
        (200, "<p>nothing</p>"),
        (200, f"<article>{A}</article>"),
        (200, f"<article><p>x</article><footer>{A}</footer>"),
        (200, f"<footer><p>{A}</p></footer>"),
        (200, f'<div><a href="https://{DOM}/"><img src="x"></a></div>'),
        (200, f"<article>{A}</article><p>cryptography</p>"),
        (200, f"<script>casino</script><!-- casino --><main>{A}</main>"),
        (200, f"<footer>{A}</footer><article><a href='https://{DOM}/2'>b</a></article>"),
    ])
    got = [(r["Tipo Risultato"], r["Power Score"], r["Anchor Text"], r["Note"]) for r in rows]
    assert got == [
        ("OFFLINE", 0, "N/D", "Errore Connessione"),
        ("RIMOSSO", 0, "N/D", "Link non più presente"),
        ("⭐️ ECCELLENTE", 10, "link", "Attivo"),
        ("🔴 SCARSO", 2, "link", "Attivo"),
        ("⭐️ ECCELLENTE", 10, "link", "Attivo"),
        ("🟡 MEDIO", 5, "[Immagine/Vuoto]", "Attivo"),
        ("💀 TOSSICO", 0, "link", "Attivo"),
        ("⭐️ ECCELLENTE", 10, "link", "Attivo"),
        ("🔴 SCARSO", 2, "link", "Attivo"),
    ]


def test_url_column_detection(spark):
    df = spark.createDataFrame([("a", None, "http://x"), ("b", "see http://y", None)],
                               "name string, note string, link string")
    assert detect_url_column(df) == "note"
    assert url_column(df.drop("note")).first()[0] == "link"


def test_latest_capture_of_a_url_counts(spark):
    from datetime import datetime

    from sitelens.operators.audit import parse_snapshots
    rows = [("http://src/0", 200, "text/html", f"<article>{A}</article>", None, datetime(2024, 1, 2)),
            ("http://src/0", 200, "text/html", "<p>gone</p>", None, datetime(2024, 1, 3)),
            ("http://src/0", 500, "text/html", None, None, None)]
    snaps = spark.createDataFrame(rows, "url string, status int, content_type string, html string, fetch_error string, fetched_at timestamp")
    src = spark.createDataFrame([("http://src/0",)], "link string")
    for given in ({"snapshots": snaps}, {"snapshots": None, "parsed": parse_snapshots(snaps, with_text=True)}):
        assert [r["Tipo Risultato"] for r in backlink_audit(src, domain=DOM, **given).collect()] == ["RIMOSSO"]
