import os
import tempfile

from sitelens.operators.rules import duplicate_titles, priority_pages, rule_summary
from sitelens.sources.csv import read_csv

CSV = """URL,Status,Title,Lung. Title,Meta Desc,H1,Img senza ALT,Robots
u1,200,A,1,d,h,0,"NOINDEX, follow"
u2,abc,A,29,d,h,2,index
u3,,A,30,,N/A,0,
u4,200,Mancante,0,d,h,0,index
u5,404,Mancante,60,d,h,0,index
u6,200,,61,d,h,0,index
u7,200,,0,d,h,0,index
"""


def load(spark, text=CSV):
    d = tempfile.mkdtemp(prefix="sitelens-test-")
    p = os.path.join(d, "audit.csv")
    with open(p, "w", encoding="utf-8") as f:
        f.write(text)
    return read_csv(spark, p)


def summary(df):
    return {r["rule"]: r["n_pages"] for r in rule_summary(df).collect()}


def test_rule_counts(spark):
    s = summary(load(spark))
    assert s["total"] == 7
    assert s["broken_status"] == 3          # abc, null, 404
    assert s["title_short"] == 2            # 1, 29
    assert s["title_long"] == 1             # 61
    assert s["title_missing"] == 4          # 2 x Mancante, 2 x null
    assert s["meta_desc_missing"] == 1
    assert s["h1_missing"] == 1             # N/A read as null
    assert s["img_missing_alt"] == 1
    assert s["noindex"] == 1
    assert s["duplicate_title"] == 3        # two A, one null
    assert s["priority"] == 6               # all but u1


def test_duplicates_rows(spark):
    df = load(spark)
    rows = sorted(r["URL"] for r in duplicate_titles(df).collect())
    assert rows == ["u2", "u3", "u7"]


def test_missing_status_column(spark):
    df = load(spark).drop("Status")
    s = summary(df)
    assert "broken_status" not in s
    assert s["priority"] == 5
    assert sorted(r["URL"] for r in priority_pages(df).collect()) == ["u3", "u4", "u5", "u6", "u7"]
