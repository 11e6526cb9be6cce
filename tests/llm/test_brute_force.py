"""Language vectors, sketches, neighbours of hot ids, licences, token scans and cuts against plain versions."""

import hashlib
import json

import numpy as np
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from sitelens.llm import bpe, langid, licences, neighbours, sketches, token_files
from sitelens.llm.queries import BYTE_VOCABULARY, WORD_VOCABULARY

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, own string, next string, hash long, row string, words array<string>"


def docs_table(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", 1, "clash", ["clash"]) for r in rows], DOCS)


# ---- language ID --------------------------------------------------------------

def gram_counts(text):
    """Hashed n-grams of one text, byte by byte."""
    raw, out = (text or "").encode(), np.zeros(langid.DIMS)
    b = []
    for i, x in enumerate(raw):
        y = x + 32 if 65 <= x <= 90 else x if 97 <= x <= 122 or x >= 128 else 32
        if i and raw[i - 1] == 0xC3 and 0x80 <= x <= 0x9E:
            y = x | 0x20
        if not (y == 32 and b and b[-1] == 32):
            b.append(y)
    for n in langid.GRAMS:
        for i in range(len(b) - n + 1):
            if n == 1 and b[i] == 32:
                continue
            h = 0
            for j in range(n):
                h = (h + b[i + j] + 1) * int(langid._KEYS[j]) & 0xFFFFFFFF
                h ^= h >> 15
            out[h % langid.DIMS] += 1
    return out


TEXTS = ["The quick Brown fox, THE end", "", None, "ÉTÉ à l'école  ÇA", "... 12", "x", "Straße über Öl", "中文 текст", "a b\n\nc   d"]


def test_language_vectors():
    got = langid.vectors(pa.array(TEXTS, pa.string()))
    for t, g in zip(TEXTS, got):
        assert np.array_equal(g, gram_counts(t)), t


def test_language_model_and_predictions(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang")
    rows = [r for r in docs.collect() if r.lang is not None and r.text is not None]
    model = langid.train(docs)
    counts = np.stack([gram_counts(r.text) for r in rows])
    idf = np.log((1 + len(rows)) / (1 + (counts > 0).sum(axis=0))) + 1
    assert np.allclose(model.idf, idf, rtol=1e-5)
    v = np.maximum(np.log1p(counts) - np.log1p(counts.sum(axis=1, keepdims=True) / langid.DIMS), 0) * idf
    v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
    # every centroid is a unit vector, and the mean direction of texts of its own language
    assert np.allclose(np.linalg.norm(model.centroids, axis=1), 1, atol=1e-4) and sorted(set(model.labels)) == sorted({r.lang for r in rows})
    for c, name in zip(model.centroids, model.labels):
        own = np.array([r.lang == name for r in rows])
        assert (v[own] @ c).mean() > (v[~own] @ c).mean() + 0.1
    cos = v @ model.centroids.T
    got = {(r.doc_id, r.text): r for r in langid.predict(docs, model).collect()}
    for r, s in zip(rows, cos):
        g = got[(r.doc_id, r.text)]
        top = s.max()
        assert g.lang_pred in {n for n, x in zip(model.labels, s) if x > top - 1e-4} or g.lang_pred == "und"
        if g.lang_pred != "und":
            assert abs(g.score - top) < 1e-4
            floor = model.floor[int(langid.length_class(np.array([gram_counts(r.text).sum()]))[0])]
            assert g.accepted == (g.score >= floor) or abs(g.score - floor) < 1e-4


def test_no_language_is_lost(spark):
    """Many languages of few documents, null and repeated ids, and copies: each language is learned."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(None if i % 2 else 5, " ".join(letters[(n * 7 + j) % 26] * 3 + letters[(n + i) % 26] for j in range(12)), f"l{n}") for n in range(90) for i in range(4)]
    rows += [(1, "the same text over and over", "hot")] * 400
    model = langid.train(docs_table(spark, rows), sample=50)
    assert set(model.labels) == {f"l{n}" for n in range(90)} | {"hot"}


# ---- fingerprints -------------------------------------------------------------

def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def plain_sketch(text):
    words = [w for w in regex.split(r"[ \t\n\x0B\f\r]+", text or "") if w]
    h = [xxh64_intdigest(w.encode(), 42) for w in words]

    def chain(xs):
        seed = 42
        for x in xs:
            seed = xxh64_intdigest(x.to_bytes(8, "little"), seed)
        return signed(seed)

    if not h:
        return []
    every = [chain(h[i: i + 5]) for i in range(len(h) - 4)] if len(h) >= 5 else [chain(h)]
    return sorted(set(every))[: sketches.K]


def test_sketches_and_neighbours_exactly(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    rows = sorted((r.doc_id, r.text or "") for r in docs.collect())
    got = {r.doc_id: r for r in sketches.edited_fingerprints(docs).collect()}
    as_text = lambda s: "".join("%016x" % (x % (1 << 64)) for x in s)
    for i, (k, t) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        a, e, b = plain_sketch(t), plain_sketch(edited), plain_sketch(after)

        def near(x, y):
            u = sorted({*x, *y})[: sketches.K]
            return 1.0 if not x and not y else len(set(x) & set(y) & set(u)) / len(u)

        g = got[k]
        assert (g.n_chars, g.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert g.fingerprint == as_text(a) and g.edited_fingerprint == as_text(e)
        assert abs(g.near_edited - near(a, e)) < 1e-12 and abs(g.near_next - near(a, b)) < 1e-12


@pytest.mark.parametrize("hot", [None, 7, -5])
def test_next_rows_of_hot_ids(spark, monkeypatch, hot):
    """Most rows share an id: every row has one next row, in one cycle that ascends by id, and no range is large."""
    monkeypatch.setattr(sketches, "RANGE_ROWS", 64)
    rows = [(hot, f"text {i}", "en") for i in range(1500)] + [(i, f"other {i}", "en") for i in range(-300, 300) if i != hot]
    df = docs_table(spark, rows).repartition(5)
    got = sketches.with_next(df, {"t": F.col("row.text"), "k": F.col("row.doc_id")}).select("own.t", "own.k", F.col("next.t").alias("nt"), F.col("next.k").alias("nk"))
    after = {r.t: (r.k, r.nt, r.nk) for r in got.collect()}
    assert len(after) == len(rows)
    place = lambda k: (k is None, k or 0)
    seen, t, falls = set(), rows[0][1], 0
    while t not in seen:
        seen.add(t)
        k, t, nk = after[t]
        falls += place(nk) < place(k)
    assert len(seen) == len(rows) and falls == 1


# ---- neighbours ---------------------------------------------------------------

def test_collinear_vectors_tie(spark):
    v = np.array([0.3, -0.7, 0.11, 0.5])
    rows = [(50, v.tolist())] + [(i, (v * f).tolist()) for i, f in ((7, 0.1), (3, 7.0), (5, 3.0), (4, 1.0), (6, 11.0))] + [(i, np.roll(v, 1).tolist()) for i in range(100, 110)]
    got = neighbours.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 50, 5).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [3, 4, 5, 6, 7] and all(abs(r.score - 1) < 1e-12 for r in got)


# ---- licences -----------------------------------------------------------------

def plain_words(text):
    return {w.strip(".") for w in regex.split(licences.WORD, text.lower())} - {""}


def plain_units(text):
    paragraphs = [regex.sub(licences.MARGIN, " ", p) for p in regex.split(licences.PARAGRAPH, text)]
    head = regex.search(licences.HEADER.replace(r"\z", r"\Z"), text)
    return [*regex.split(licences.STATEMENT, text), *[s for p in paragraphs for s in regex.split(licences.SENTENCE, p)], *paragraphs, head.group(1) if head else "", text]


def test_licences_of_a_whole_table(spark):
    odd = [(1, "Released under the MIT License.", "en"), (1, "nothing here", "en"), (2, "Licensed under the Apache License, Version 2.0.", "en"),
           (2, "Released under the MIT License.", "en"), (None, "All rights reserved.", "en"), (None, "plain", "en"), (None, None, None), (3, "", "en"),
           (1, "Released under the MIT License.", "en"), (4, "ISC License\n\nand so on", "en")]
    table = spark.read.parquet(f"{SMALL}/documents.parquet").selectExpr("doc_id + 1000 as doc_id", "text", "lang")
    df = docs_table(spark, odd + [tuple(r) for r in table.collect()])
    rows = [(r.doc_id, r.text) for r in df.collect()]
    docs = [plain_words(t or "") for _, t in rows]
    freq = {}
    for d in docs:
        for w in d:
            freq[w] = freq.get(w, 0) + 1
    weigh = {w: np.log((1 + len(rows)) / (1 + n)) + 1 for w, n in freq.items()}
    rare = np.log(1 + len(rows)) + 1
    square = lambda ws: sum(weigh.get(w, rare) ** 2 for w in ws)
    templates = [(n, set(ws), np.sqrt(square(ws))) for n, ws in licences.template_words()]

    def stated(text):
        best = []
        for i, unit in enumerate(plain_units(text or "")):
            ws = plain_words(unit)
            if not ws:
                continue
            dots = sorted((-round(square(ws & t) / norm, 9), n) for n, t, norm in templates)
            score = -dots[0][0] / np.sqrt(square(ws))
            if score >= licences.THRESHOLD:
                best.append((dots[0][1] == licences.RESERVED, -round(score, 6), i, dots[0][1]))
        return min(best)[3] if best else None

    got = sorted((repr(r.doc_id), repr(r.path), repr(r.licence)) for r in licences.scan_files(df, F.concat(F.lit("p/"), F.coalesce("text", F.lit("null")).substr(1, 20))).collect())
    want = sorted((repr(k), repr("p/" + (t if t is not None else "null")[:20]), repr(stated(t))) for k, t in rows)
    assert got == want
    assert sum(w[2] != "None" for w in want) > 10


# ---- tokens -------------------------------------------------------------------

@pytest.mark.parametrize("width,end_id", [(2, 0), (2, 50256), (2, 0x4141), (4, 7), (4, 0x01010101)])
def test_token_scan_in_many_byte_ranges(spark, tmp_path, width, end_id):
    """Files cut into ranges of a few bytes, and bytes that look like separators between tokens."""
    rng, kind, data = np.random.default_rng(width + end_id), f"<u{width}", {}
    near = [end_id, (end_id << 8) & (256**width - 1) | (end_id >> (8 * width - 8)), end_id >> 8, 1, end_id]
    for n in (0, 1, 2, 90):
        data[f"f{n}"] = rng.choice(near, n).astype(kind)
        (tmp_path / f"f{n}").write_bytes(data[f"f{n}"].tobytes())
    was = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in ("40b", "1m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1b")
            got = token_files.scan_token_files(spark, str(tmp_path), end_id, width, block=16).collect()
            for name, ids in data.items():
                want, start = [], 0
                for i in np.flatnonzero(ids == end_id).tolist():
                    want.append((len(want), start, i - start, True))
                    start = i + 1
                if start < len(ids):
                    want.append((len(want), start, len(ids) - start, False))
                assert sorted((r.ordinal, r.start, r.n_tokens, r.terminated) for r in got if r.path.endswith("/" + name)) == want, (size, name)
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("vocabulary", [WORD_VOCABULARY, BYTE_VOCABULARY])
def test_automaton_finds_the_longest_token_everywhere(vocabulary):
    b = bpe.Bpe(vocabulary)
    tokens, made = {}, set(b.ext.tolist())
    with open(vocabulary, encoding="utf-8") as f:
        model = json.load(f)["model"]
    for name, ext in model["vocab"].items():
        syms = b._symbols(name)
        if syms is not None and ext in made:
            tokens[tuple(syms)] = ext
    rng = np.random.default_rng(1)
    text = b"the quick brown foxes' internationalisation of unbelievable aaaaaaaa \xc3\xa9\xc3\xa9 zzzz"
    words = [text[i: i + n] for i, n in zip(rng.integers(0, 40, 60).tolist(), rng.integers(1, 30, 60).tolist())]
    size = np.array([len(w) for w in words])
    syms, begin, size = b._as_symbols(np.frombuffer(b"".join(words) + bytes(24), np.uint8), np.cumsum(size) - size, size)
    got = b._longest(syms, begin, size)
    for w, a, n in zip(words, begin.tolist(), size.tolist()):
        s = syms[a: a + n].tolist()
        assert b._walk(s) == got[a: a + n].tolist()
        for i in range(n):
            want = next(tokens[tuple(s[i:j])] for j in range(n, i, -1) if tuple(s[i:j]) in tokens)
            assert b.ext[got[a + i]] == want, (w, i)


@pytest.mark.parametrize("vocabulary", [WORD_VOCABULARY, BYTE_VOCABULARY])
def test_long_texts_are_cut_without_changing_them(vocabulary, monkeypatch):
    """Texts without a space between letters: Chinese, code, numbers; every cut leaves the ids as they are."""
    from tokenizers import Tokenizer
    monkeypatch.setattr(bpe, "CHUNK_BYTES", 64)
    lib, b = Tokenizer.from_file(vocabulary), bpe.Bpe(vocabulary)
    parts = ["这是一个很长的文本。没有空格，但是有标点！还有更多；内容：是的？", "foo(bar1baz,qux[2]);x=y+z;\tif(a&&b){c--}", "Ab3dE/f+9Gh==", "l'été's d'or;'s 're\n\nnext\nline  two", "日本語、テキスト。です"]
    rng = np.random.default_rng(2)
    texts = ["".join(rng.choice(parts, 40)) for _ in range(20)] + ["字" * 500, "x" * 500, ";" * 500, " " * 300, "\n" * 300, "'s" * 200, "<|endoftext|>a" * 30]
    ids, per = b.encode(pa.array(texts, pa.string()))
    cut = np.concatenate([[0], np.cumsum(per)])
    for t, x, y in zip(texts, cut[:-1], cut[1:]):
        assert ids[x:y].tolist() == lib.encode(t, add_special_tokens=False).ids, t
    raw = np.frombuffer(("这是一个很长的文本。" * 4000).encode(), np.uint8)
    assert bpe._safe_cut(raw, 0, len(raw)) < 200
