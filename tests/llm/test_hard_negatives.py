"""Strassen products, heaps and mined negatives against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitelens.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, n long, id string, v string, score long"


@pytest.mark.parametrize("shape", [(1, 1, 1), (25, 25, 25), (26, 64, 31), (100, 33, 77), (51, 130, 200), (64, 64, 64), (0, 8, 5)])
def test_strassen_is_exact(shape):
    rng = np.random.default_rng(sum(shape))
    m, k, n = shape
    for top in (10, 1 << 40, 1 << 62):  # the last ones wrap, modulo 2^64, as the plain product does
        a, b = rng.integers(-top, top, (m, k)), rng.integers(-top, top, (k, n))
        assert np.array_equal(hn.strassen(a, b), a @ b)


def test_heaps_merge_in_any_order():
    rng = np.random.default_rng(3)
    scores, orders = rng.integers(-4, 4, (7, 200)), np.arange(200)
    allowed = rng.random((7, 200)) < 0.7
    for cut in ([0, 200], [0, 3, 50, 51, 200]):
        heaps = hn.Heaps(7, 6)
        for a, e in reversed(list(zip(cut, cut[1:]))):
            heaps.push(scores[:, a:e], allowed[:, a:e], orders[a:e])
        for i in range(7):
            want = sorted(((-scores[i, j], j) for j in range(200) if allowed[i, j]))[:6]
            got = [(-s, o) for k, s, o in zip(heaps.key, heaps.score, heaps.order) if k == i]
            assert sorted(got) == want


def brute(rows, anchors, label, positives=5, negatives=10):
    """Rows of (anchor, positive, rank, negative, positive score, negative score)."""
    clean = set()
    for key, vector, lab in rows:
        if key is not None and lab is not None and vector is not None and all(x is not None and np.isfinite(x) for x in vector):
            clean.add((key, lab, tuple(int(np.floor(256 * float(np.float32(x)))) for x in vector)))
    clean = sorted((k, label(k, v), x) for k, v, x in clean)
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a in clean:
        if not anchors(a[0]):
            continue
        near = sorted(((-score(a[2], c[2]), i) for i, c in enumerate(clean) if c[0] != a[0] and c[1] == a[1]))[:positives]
        for s, i in near:
            hard = sorted((-score(a[2], c[2]), j) for j, c in enumerate(clean) if c[1] != a[1] and 30 * -s <= 100 * score(a[2], c[2]) <= 90 * -s)[:negatives]
            out += [(a[0], clean[i][0], r + 1, clean[j][0], -s, -t) for r, (t, j) in enumerate(hard)]
    return sorted(out)


def mined(df, **kw):
    label = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = hn.mine(df, F.col("id") % 100 == 0, label=label, **kw)
    return sorted(map(tuple, got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()))


def lab(k, v):
    return (v + 1) % 10 if k % 7 == 0 else v


@pytest.mark.parametrize("blocks", [{}, {"block_anchors": 2, "block_rows": 40}])
def test_against_brute_force(spark, monkeypatch, blocks):
    if blocks:
        monkeypatch.setattr(hn, "TILE", 16)
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(0.4, 1, 6).astype(np.float32)], int(rng.integers(0, 4))) for i in range(-200, 400)]
    rows += [(i, [0.5, 0.5, 0.5, 0.5, 0.5, 0.5], i % 3) for i in range(1000, 1300)]  # one vector held by a third of all rows
    df = spark.createDataFrame([(*r, 1, "x", "y", 2) for r in rows], SCHEMA).repartition(5)
    assert mined(df, **blocks) == brute(rows, lambda k: k % 100 == 0, lab)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (0, [1.0, 3.0], 1), (0, [1.0, 2.0], 2), (100, [], 1), (200, [-1.0, -1.0], 1), (300, None, 1), (400, [1.0], None),
            (None, [1.0, 1.0], 1), (500, [1.0, None], 1), (600, [nan, 1.0], 1), (700, [1.0, -inf], 1), (1, [2.0, 1.0], 1), (2, [1.0], 1), (3, [0.5, 0.5], 2),
            (4, [0.5, 0.5], 3), (5, [0.1, 0.9], 2), (6, [0.0, 0.0], 2), (8, [1.0, 1.0, 1.0], 4)]
    df = spark.createDataFrame([(*r, 1, "x", "y", 2) for r in rows], SCHEMA)
    assert mined(df) == brute(rows, lambda k: k % 100 == 0, lab)
    assert mined(df.where("vec_id > 900")) == [] and mined(df.where("vec_id = 100")) == []
