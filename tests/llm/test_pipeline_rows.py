"""Pipeline stages on rows without an id, with the same id, repeated rows, odd rows and none."""

import pytest

import corpus_pipeline as p
from sitelens.llm import simhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long, who string, digest long"
A = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"
B = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
C = "red orange yellow green blue indigo violet black white brown grey pink purple teal"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "clash", 1) for i, t in rows], DOCS)


def kept(spark, rows):
    got = p.near_dedup(spark, table(spark, rows), "")
    assert got.columns == p.COLUMNS
    return sorted(((r.doc_id, r.text) for r in got.collect()), key=repr)


def test_near_dedup_keeps_one_document_of_every_group(spark):
    assert kept(spark, [(5, A), (5, B), (9, B)]) == [(5, A), (5, B)]
    assert kept(spark, [(9, A), (5, A), (5, A), (5, A)]) == [(5, A)]
    assert kept(spark, [(None, A), (None, B), (7, B), (None, B)]) == sorted([(None, A), (7, B)], key=repr)
    assert kept(spark, [(None, A), (None, A)]) == [(None, A)]
    assert len(kept(spark, [(1, None), (1, ""), (1, None), (2, "  ")])) == 1        # fingerprint zero, linked like any other


def test_near_dedup_against_brute_force(spark):
    rows = [(i % 7 if i % 5 else None, [A, B, C, "", None][i % 5 if i % 3 else (i // 3) % 5]) for i in range(60)]
    prints = [simhash.simhash((t or "").encode()) for _, t in rows]
    got = kept(spark, rows)
    groups = {}
    for (i, t), f in zip(rows, prints):
        groups.setdefault(next((g for g in groups if (g ^ f).bit_count() <= 2), f), []).append((i, t))
    assert len(got) == len(groups)
    for members in groups.values():
        least = min((i is None, i or 0) for i, _ in members)
        assert sum((i, t) in members and (i is None, i or 0) == least for i, t in got) == 1


ODD = [(None, A), (None, A), (3, None), (4, ""), (4, B), (4, B), (5, "x" * 60_000), (6, (A + " ") * 900), (7, "... 123"), (8, "中文 " * 400), (-9, C)]


@pytest.mark.parametrize("rows", [ODD, []])
def test_every_stage_takes_odd_rows_and_none(spark, rows):
    df = table(spark, rows)
    for name, stage in p.STAGES:
        got = stage(spark, df, "")
        n = got.count()
        if name != "packing":
            assert got.columns == p.COLUMNS and n <= len(rows)
        else:
            assert n >= len(rows)
        if name == "repeat_removal":
            assert n == len(rows)
