from datetime import datetime, timedelta

from sitelens.operators.vitals import vitals_report

T0 = datetime(2024, 1, 1)
COLS = ("view_id string, label string, url string, seq long, entry_type string, start_ms double, "
        "value double, had_recent_input boolean, response_start_ms double, load_ms double, "
        "ts timestamp, fetch_error string")


def e(view, seq, typ, start=0.0, value=0.0, recent=False, resp=None, err=None):
    resp = None if resp is None else float(resp)
    return (view, "HOME", "https://s.it/", seq, typ, float(start), float(value), recent, resp, 1000.0,
            T0 + timedelta(milliseconds=seq), err)


def test_vitals_cases(spark):
    rows = [
        e("v1", 1, "navigation", resp=120.5), e("v1", 2, "largest-contentful-paint", 900),
        e("v1", 3, "largest-contentful-paint", 2500.4), e("v1", 4, "layout-shift", 10, 0.1),
        e("v1", 5, "layout-shift", 20, 0.05, recent=True),
        e("v1", 6, "largest-contentful-paint", 3500),   # after load + 2 s: not observed
        e("v2", 1, "navigation", resp=80), e("v2", 2, "largest-contentful-paint", 2500.5),
        e("v3", 1, "navigation", resp=80),
        e("v4", 1, "largest-contentful-paint", 100),
        e("v5", 1, "navigation", resp=80), e("v5", 2, "error", err="Timeout"),
    ]
    df = spark.createDataFrame(rows, COLS)
    out = {r["view_id"]: r for r in vitals_report(df).collect()}
    v1 = out["v1"]
    assert (v1["TTFB"], v1["LCP"], v1["CLS"], v1["Giudizio"]) == ("121ms", "2.5s", 0.1, "✅ BUONO")
    v2 = out["v2"]
    assert (v2["LCP"], v2["Giudizio"]) == ("2.501s", "🔴 DA MIGLIORARE")
    v3 = out["v3"]
    assert (v3["LCP"], v3["Giudizio"], v3["lcp_observed"]) == ("0s", "✅ BUONO", False)
    assert out["v4"]["Errore"].startswith("TypeError") and out["v4"]["LCP"] is None
    assert out["v5"]["Errore"] == "Timeout" and out["v5"]["TTFB"] is None


def test_target_without_entries_has_an_error_row(spark):
    from sitelens.plans.flows import vitals_flow
    df = spark.createDataFrame([e("v1", 1, "navigation", resp=80)], COLS)
    out = {r["Tipo"]: r for r in vitals_flow(spark, df, {"HOME": "https://s.it/", "QUIET": "https://s.it/q"}).collect()}
    assert out["HOME"]["TTFB"] == "80ms" and out["HOME"]["Errore"] is None
    assert out["QUIET"]["URL"] == "https://s.it/q" and out["QUIET"]["Errore"].startswith("TypeError")
