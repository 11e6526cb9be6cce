import pytest
from pyspark.sql import functions as F

from sitelens.functions.text import is_missing, py_strip
from sitelens.functions.url import product_flag, url_class


@pytest.mark.parametrize("url,expected", [
    ("https://s.it/content/1.html", "Pagina (CMS)"),
    ("https://s.it/it/a.HTML", "Prodotto"),
    ("https://s.it/", "Homepage"),
    ("https://s.it/it/", "Homepage"),
    ("https://s.com/a", "Homepage"),
    ("https://s.com/it/a", "Categoria"),
    ("https://s.com/it/a.html?x=1", "Categoria"),
])
def test_url_class(spark, url, expected):
    df = spark.createDataFrame([(url,)], "u string")
    assert df.select(url_class(F.col("u"))).first()[0] == expected


def test_product_url_case_sensitive(spark):
    df = spark.createDataFrame([("a.html",), ("a.HTML",), (None,)], "u string")
    assert [r[0] for r in df.select(product_flag(F.col("u"))).collect()] == [True, False, False]


def test_strip_and_missing(spark):
    df = spark.createDataFrame([("  x\t",), ("Mancante",), ("  ",), (None,), ("ok",)], "s string")
    out = df.select(py_strip(F.col("s")).alias("s"), is_missing(F.col("s")).alias("m")).collect()
    assert out[0]["s"] == "x"
    assert [r["m"] for r in out] == [False, True, True, True, False]


def test_py_float_text_matches_repr(spark):
    import random

    from sitelens.functions.text import py_float_text
    rng = random.Random(5)
    vals = [12500000.0, 1e16, 1.5e16, 1e-5, 0.0001, 0.001, 900.1, 9.0, 0.0, -2.5e7, 1e22, -0.000123]
    vals += [rng.uniform(0, 1) * 10 ** rng.randint(-8, 20) for _ in range(200)]
    df = spark.createDataFrame([(v,) for v in vals], "d double")
    got = [r[0] for r in df.select(py_float_text(F.col("d"))).collect()]
    assert got == [repr(v) for v in vals]


def test_py_strip_matches_python_strip(spark):
    ws = [chr(c) for c in range(0x10000) if chr(c).isspace() or chr(c) in "\x1c\x1d\x1e\x1f"]
    rows = [(f"{c}a{c}b{c}",) for c in ws] + [("​ x ​",)]   # zero-width space is not stripped
    df = spark.createDataFrame(rows, "s string")
    got = [r[0] for r in df.select(py_strip(F.col("s"))).collect()]
    assert got == [r[0].strip() for r in rows]
