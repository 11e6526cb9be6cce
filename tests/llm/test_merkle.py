"""Merkle manifests against a plain recursion."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from sitelens.llm import merkle

DOCS = "doc_id long, text string, lang string, source string, n_chars long, g string, leaf string, pos int, total int"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, lower=False):
    doc_id, text, lang, source, n_chars = row
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text) if lower and text is not None else text
    return H(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in (doc_id, source, lang, n_chars, text)])


def levels(nodes):
    out = [nodes]
    while len(nodes) > 1:
        nodes = [H(*nodes[i: i + 8]) for i in range(0, len(nodes), 8)]
        out.append(nodes)
    return out


def path(tree, i):
    """(siblings left, siblings right) from the bottom."""
    out = []
    for nodes in tree[:-1]:
        a = i - i % 8
        out.append(("".join(nodes[a:i]), "".join(nodes[i + 1: a + 8])))
        i //= 8
    return out


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf_of(r), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in names}
    top = levels([trees[g][-1][0] for g in names])
    out = []
    for n, g in enumerate(names):
        for i, (_, _, leaf, r) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            steps = path(trees[g], i) + path(top, n)
            h = leaf_of(r, lower=True) if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 else leaf
            for a, b in steps:
                h = H(a, h, b)
            out.append((r[0], leaf, trees[g][-1][0], top[-1][0], H(*[a + b for a, b in steps]), h, h == top[-1][0]))
    return out


def manifest(df):
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    got = merkle.manifest(df, FIELDS, tampered={"text": F.translate("text", upper, upper.lower())}, where=F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0)
    return [tuple(r) for r in got.collect()]


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1, 2) for r in rows], DOCS)


def test_many_shapes_of_groups(spark):
    rng = random.Random(5)
    rows = []
    for n, size in enumerate([1, 2, 8, 9, 64, 65, 512, 513, 1100, 3, 7]):
        ids = rng.sample([*range(-3000, 3000), *[rng.randrange(-(1 << 62), 1 << 62) for _ in range(500)]], size)
        rows += [(i, rng.choice(["Text Ä", "plain", "", None]), None if n == 4 else f"l{'ä' * (n % 3)}{n}", "S", n) for i in ids]
    rng.shuffle(rows)
    assert sorted(manifest(table(spark, rows)), key=repr) == sorted(brute(rows), key=repr)


def test_repeated_and_null_ids(spark):
    rows = [(None, f"T{i % 40}", "en", None, i % 3) for i in range(400)] + [(7, f"Text {i}", "en", "s", 1) for i in range(300)]
    rows += [(7, "Same", "en", "s", 1)] * 200 + [(i, "A", "en", "s", 1) for i in range(20)] + [(None, None, None, None, None)] * 3
    rows += [(-(1 << 63) + 1, "first", "en", "s", 1), ((1 << 63) - 1, "LAST", "en", "s", 1)]
    got = manifest(table(spark, rows).repartition(6))
    # which of equal leaves has which proof is open, but not which leaves and proofs there are
    assert sorted(got, key=repr) == sorted(brute(rows), key=repr)


@pytest.mark.parametrize("rows", [[], [(1, "One", "en", "s", 1)], [(1, "One", None, None, None), (2, "Two", "en", "s", 1)]])
def test_few_rows(spark, rows):
    assert sorted(manifest(table(spark, rows)), key=repr) == sorted(brute(rows), key=repr) if rows else manifest(table(spark, rows)) == []


def test_tampering_is_found_only_where_it_changes_a_text(spark):
    rows = [(i, "UPPER" if i % 2 else "lower", "en", "s", 1) for i in range(100)]
    got = {r[0]: r[-1] for r in manifest(table(spark, rows))}
    assert got == {i: not (i % 2 and zlib.crc32(str(i).encode()) % 3 == 0) for i in range(100)}
