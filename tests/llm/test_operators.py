"""Every operator against a brute-force version, and on odd rows."""

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sitelens.llm import bpe, langid, licences, neighbours, packing, sharding, simhash, sketches, suffix_dedup, token_files
from sitelens.llm.queries import BYTE_VOCABULARY, REGISTRY, WORD_VOCABULARY

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, length int, row string, gram long"
PASSAGE = "the quick brown fox jumps over the lazy dog and runs far away into the dark green woods tonight"
ODD = [
    (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu", "en", "a", 1, 5, "x", 7),
    (2, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu", "en", "a", 1, None, None, None),
    (2, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu", "en", "a", 1, 5, "x", 7),
    (3, None, None, None, None, None, None, None), (4, "", "en", "", 0, 1, "", 0), (None, "no id here", "fr", "b", 2, 1, "y", 1),
    (5, "é" * 70 + " " + PASSAGE, "fr", "b", 3, 1, "y", 2), (6, PASSAGE + " ü\n\n 's it's don't!! 12 3", "en", "c", 4, 2, "z", 3),
    (7, "x" * 5000, "en", "c", 5, 1, "z", 4), (8, "中文 текст <|endoftext|> \x01 ﬁ", None, "c", 6, 1, "z", 5),
    (9, " ".join(["word%d" % (i % 700) for i in range(20000)]), "en", "c", 7, 1, "z", 6), (10, "Licensed under CC BY-NC 4.0.", "en", "c", 8, 1, "z", 8),
    (11, "... --- 123", "en", "c", 9, 1, "z", 9), (-3, PASSAGE, "en", "c", 10, 1, "z", 10),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module", params=["odd", "docs"])
def table(request):
    return request.getfixturevalue(request.param)


@pytest.mark.parametrize("name,vocabulary", [("word", WORD_VOCABULARY), ("byte", BYTE_VOCABULARY)])
def test_bpe_equals_library(table, name, vocabulary):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(vocabulary)
    rows = table.select("doc_id", "text")
    got = sorted((repr(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.round_trip(rows, vocabulary).collect())
    want = []
    for r in rows.collect():
        ids = lib.encode(r.text or "", add_special_tokens=False).ids
        plain = lib.decode(ids, skip_special_tokens=False)
        want.append((repr(r.doc_id), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(plain.encode()).hexdigest()))
    assert got == sorted(want)


def test_bpe_parts_of_a_long_text(monkeypatch):
    from tokenizers import Tokenizer
    monkeypatch.setattr(bpe, "CHUNK_BYTES", 64)
    texts = [ODD[8][1], ODD[10][1][:3000], ODD[6][1], ODD[7][1], "a" * 500, None, "tail \n words  here " * 20]
    for path in (WORD_VOCABULARY, BYTE_VOCABULARY):
        lib, own = Tokenizer.from_file(path), bpe.load(path)
        ids, n = own.encode(pa.array(texts))
        want = [lib.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert n.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_bpe_columns_round_trip(odd):
    got = bpe.decode_documents(bpe.encode_documents(odd, BYTE_VOCABULARY), BYTE_VOCABULARY).collect()
    assert all(r.decoded == (r.text or "") for r in got) and len(got) == len(ODD)


def test_sketches(table):
    got = sketches.edited_fingerprints(table.select("doc_id", "text")).collect()
    rows = sorted(((r.doc_id if r.doc_id is not None else 1 << 62, r.text or "") for r in table.collect()))
    assert len(got) == len(rows)

    def shingles(t):
        w = t.split()
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    def like(a, b):
        a, b = shingles(a), shingles(b)
        return len(a & b) / len(a | b) if a | b else 1.0

    edited = {}
    for i, (k, t) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        e = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        edited.setdefault(k, []).append((hashlib.sha256(e.encode()).hexdigest(), like(t, e), like(t, after), len(t), len(shingles(t))))
    for r in got:
        want = edited[r.doc_id if r.doc_id is not None else 1 << 62]
        assert any(r.edited_sha256 == w[0] and abs(r.near_edited - w[1]) < 0.2 and abs(r.near_next - w[2]) < 0.2 and r.n_chars == w[3]
                   and abs(r.n_shingles - w[4]) <= 0.4 * w[4] for w in want)


def test_sketches_merge(spark):
    a, b = "a b c d e f g h", "c d e f g h i j"
    df = spark.createDataFrame([("x", a), ("x", b), ("y", a), ("z", None)], "g string, t string").withColumn("s", sketches.sketch(F.col("t")))
    got = {r.g: list(r.s) for r in sketches.merge_groups(df, "g", "s").collect()}
    one = {r.t: list(r.s) for r in df.where("t is not null").collect()}
    assert got["x"] == sorted(set(one[a]) | set(one[b])) and got["y"] == one[a] and got["z"] == []
    r = df.where("g = 'x'").agg(F.min("s").alias("a"), F.max("s").alias("b")).select(
        sketches.resemblance(F.col("a"), F.col("b")).alias("j"), sketches.containment(F.col("a"), F.col("b")).alias("c")).first()
    assert r.j == pytest.approx(2 / 6) and r.c == pytest.approx(2 / 4)


def test_langid(docs, odd):
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = langid.train(docs.where(~held))
    got = langid.predict(docs.where(held), model).collect()
    assert np.mean([r.lang_pred == r.lang for r in got]) > 0.9 and np.mean([r.accepted for r in got]) > 0.95
    rows = langid.predict(odd, model).collect()
    for r in rows:
        assert 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (r.text is None or not re.search(r"[^\W\d_]", r.text))
        assert not (r.lang_pred == "und" and r.accepted)


def test_langid_rejects_unlearned_languages_and_random_letters(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    rng = np.random.default_rng(4)
    letters = [(i, "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz" + " " * (i % 2 * 5)), n))) for i, n in enumerate([300, 300, 1000, 1000, 5000, 5000, 60000, 60000])]
    noise = spark.createDataFrame(letters, "doc_id long, text string")
    learned = docs.where("lang != 'de'")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = langid.train(learned.where(~held))
    share = lambda df: langid.predict(df, model).agg(F.avg(F.col("accepted").cast("int"))).first()[0]
    assert share(learned.where(held)) > 0.95
    assert share(docs.where("lang = 'de'")) < 0.1
    assert share(noise) == 0


def test_sharding(table):
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    df = table.select("doc_id", "text", size.alias("size"))
    got = sharding.shard_by_bytes(df, "size", sharding.order_key(F.xxhash64("text"), F.col("doc_id")), shards=4).toPandas()
    assert len(got) == table.count()
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    sums = got.groupby("shard")["size"].sum()
    assert sums.max() <= got["size"].sum() / 4 + 2 * got["size"].max()


@pytest.mark.parametrize("same", ["rows", "ids", "texts"])
def test_sharding_law_holds_for_repeated_rows(spark, same):
    """Half of the rows share doc_id and text, or one of them; every slot and shard against a plain sort."""
    i = F.col("id")
    half = i < 2000
    df = spark.range(4000).select(F.when(half & (same != "texts"), 7).otherwise(i).alias("doc_id"),
                                  F.when(half & (same != "ids"), "same text").otherwise(F.concat(F.lit("t"), i.cast("string"))).alias("text"),
                                  (i % 9 + 1).alias("size"), i.alias("shard"), i.alias("slot"))
    key = sharding.order_key(F.xxhash64("text"), F.col("doc_id"))
    got = sharding.shard_by_bytes(df, "size", key, shards=16).toPandas()
    total, sums = got["size"].sum(), got.groupby("shard")["size"].sum()
    assert len(got) == 4000 and sorted(sums.index) == list(range(16))
    assert abs(sums - total / 16).max() <= 0.001 * total / 16 * 2 + 9
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    order = df.select("doc_id", "text", key.alias("k")).distinct().toPandas().set_index(["doc_id", "text"])["k"].map(bytes)
    placed = got.sort_values(["shard", "slot"])
    keys = [order[(r.doc_id, r.text)] for r in placed.itertuples()]
    assert keys == sorted(keys)         # shards and slots follow the order of keys


def test_sharding_hot_group(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 1500, "same").otherwise(F.col("id").cast("string")).alias("text"), F.lit(5).cast("long").alias("size"))
    got = sharding.shard_by_bytes(df, "size", sharding.order_key(F.xxhash64("text"), F.col("doc_id")), shards=8).toPandas()
    sums = got.groupby("shard")["size"].sum()
    assert len(sums) == 8 and sums.max() - sums.min() <= 20


def test_sharding_ranges(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RANGE_ROWS", 100)
    df = spark.range(2000).select(F.col("id").alias("doc_id"), (F.col("id") % 7 + 1).alias("size"))
    got = sharding.shard_by_bytes(df, "size", sharding.order_key(F.xxhash64("doc_id"), F.col("doc_id")), shards=4).toPandas()
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))


def test_neighbours(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    n = len(rows[0][1])
    rows += [(9001, None), (9050, [0.0] * n), (9100, [float("nan")] * n), (9150, [None] * n), (None, rows[0][1])] + [(10000 + i, rows[3][1]) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = neighbours.search(df, F.col("vec_id") % 50 == 0, 5).toPandas()
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    ids, x = np.array([i for i, _ in ok]), np.stack([v for _, v in ok])
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = total = 0
    for at in np.flatnonzero(ids % 50 == 0):
        s = np.round(u @ u[at], 12)
        s[at] = -9
        order = np.lexsort((ids, -s))[:5]
        g = got[got.query_id == ids[at]].sort_values("rank")
        assert g["rank"].tolist() == [1, 2, 3, 4, 5] and ids[at] not in set(g.vec_id)
        assert all(abs(s[list(ids).index(v)] - c) < 1e-9 for v, c in zip(g.vec_id, g.score))
        hit += len(set(ids[order]) & set(g.vec_id))
        total += 5
    assert hit >= 0.9 * total
    few = spark.createDataFrame(rows[:3], df.schema)
    assert neighbours.search(few, F.lit(True), 5).count() == 6
    assert neighbours.search(few.limit(0), F.lit(True), 5).count() == 0


def test_token_files(spark, table, tmp_path):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(BYTE_VOCABULARY)
    got = token_files.count_documents(table, BYTE_VOCABULARY, file_bytes=4096).collect()
    want = sorted((repr(r.doc_id), len(lib.encode(r.text or "", add_special_tokens=False).ids)) for r in table.collect())
    assert sorted((repr(r.doc_id), r.n_tokens) for r in got) == want


def test_token_files_hold_ids_of_ordinary_and_special_tokens(spark):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(BYTE_VOCABULARY)
    end = "<|endoftext|>"
    texts = ["Hello there! New text.", "plain words", "!", end, f"one {end} two ! three{end}", "", f"{end}{end}", "last one! it is"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, f"a! b{end}c")], "doc_id long, text string").coalesce(1)
    for size in (16, token_files.FILE_BYTES):
        got = token_files.count_documents(df, BYTE_VOCABULARY, file_bytes=size).collect()
        want = {r.doc_id: len(lib.encode(r.text, add_special_tokens=False).ids) for r in df.collect()}
        assert len(got) == len(want) and {r.doc_id: r.n_tokens for r in got} == want


def test_token_files_with_other_separators_than_names_fail(spark):
    names = spark.createDataFrame([("0-0", 0, 0, 7), ("0-0", 1, 0, 8)], "file string, ordinal long, own long, doc_id long")
    found = [("0-0", 0, 0, 5), ("0-0", 1, 6, 2), ("0-0", 2, 9, 4)]
    schema = "file string, ordinal long, start long, n_tokens long"
    assert {r.doc_id: r.n_tokens for r in token_files.name_counts(names, spark.createDataFrame(found[:2], schema)).collect()} == {7: 5, 8: 2}
    for wrong in (found, found[:1]):
        with pytest.raises(Exception, match="separators and names differ"):
            token_files.name_counts(names, spark.createDataFrame(wrong, schema)).collect()


@pytest.mark.parametrize("block", [1, 2, 3, 7, 100])
def test_token_scan_blocks(spark, tmp_path, block):
    data = {"a": [0, 5, 6, 0, 0, 7, 8, 9, 0], "b": [1, 2, 3], "c": [], "d": [4, 0, 4, 4]}
    for name, ids in data.items():
        (tmp_path / name).write_bytes(np.array(ids, "<u2").tobytes())
    got = token_files.scan_token_files(spark, str(tmp_path), block=block).collect()
    for name, ids in data.items():
        want, start = [], 0
        for i, t in enumerate(ids):
            if t == 0:
                want.append((len(want), start, i - start, True))
                start = i + 1
        if start < len(ids):
            want.append((len(want), start, len(ids) - start, False))
        assert sorted((r.ordinal, r.start, r.n_tokens, r.terminated) for r in got if r.path.endswith("/" + name)) == want


def test_packing(table):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(BYTE_VOCABULARY)
    got = packing.pack(packing.cut_documents(table, BYTE_VOCABULARY)).toPandas()
    want = []
    for r in table.collect():
        ids = lib.encode(r.text or "", add_special_tokens=False).ids + [0]
        cut = [0] + list(range(len(ids) % 2048 or 2048, len(ids) + 1, 2048))
        want += [(repr(r.doc_id), i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for i, (a, b) in enumerate(zip(cut, cut[1:]))]
    keys = [repr(None) if k is None or k != k else repr(int(k)) for k in got.doc_id]
    assert sorted(zip(keys, got.piece, got.start, got.length, got.ids_crc32)) == sorted(want)
    got = got.sort_values(["sequence_id", "offset"])
    assert (got.offset == got.groupby("sequence_id").length.cumsum() - got.length).all()
    assert got.groupby("sequence_id").length.sum().max() <= 2048
    assert got.sequence_id.nunique() <= -(-got.length.sum() // 2048) * 1.02 + 2


def test_packing_sizes(spark):
    rng = np.random.default_rng(3)
    for sizes in (rng.integers(1, 33, 3000), np.full(500, 20), np.array([32] * 10), np.array([17] * 9 + [15] * 9 + [1] * 40)):
        df = spark.createDataFrame([(int(n), i, "r") for i, n in enumerate(sizes)], "length long, id int, rank string")
        got = packing.pack(df, capacity=32).toPandas().sort_values(["sequence_id", "offset"])
        assert sorted(got.id) == list(range(len(sizes)))
        assert (got.offset == got.groupby("sequence_id").length.cumsum() - got.length).all() and (got.groupby("sequence_id").length.sum() <= 32).all()
        bins, n = [], 0
        for s in sorted(sizes.tolist(), reverse=True):
            fit = [b for b in bins if b >= s]
            if fit:
                bins.remove(min(fit))
                bins.append(min(fit) - s)
            else:
                bins.append(32 - s)
                n += 1
        assert got.sequence_id.nunique() <= n * 1.02 + 1


def test_licences(spark):
    rows = [(1, "code\nReleased under the MIT License.\nmore", "p/LICENSE"), (2, "nothing here", "p/q/a.txt"), (3, "All rights reserved.", "p/q/b.txt"),
            (4, None, "z/c.txt"), (5, "", None), (6, "Licensed under the Apache License, Version 2.0.", "p/q/r/LICENSE.md"), (7, "plain", "p/q/r/s/t/d.txt"),
            (8, "License to kill, under the sea", "p/e.txt"), (9, "x", "top.txt")]
    rows += [(100 + i, f"filler words number {i} of the text", f"f/{i}.txt") for i in range(40)]
    got = {r.doc_id: r for r in licences.scan_files(spark.createDataFrame(rows, "doc_id long, text string, path string"), F.col("path")).collect()}
    assert {k: r.licence for k, r in got.items() if r.licence} == {1: "MIT", 3: "Proprietary", 6: "Apache-2.0"}
    assert [got[k].effective for k in (2, 3, 4, 5, 7, 8, 9)] == ["MIT", "Proprietary", None, None, "Apache-2.0", "MIT", None]
    assert got[7].from_dir == "p/q/r" and len(got) == len(rows)


def test_licences_weigh_common_words_by_all_documents(spark):
    said = "See this file: it is released under the MIT License."
    rows = [(1, said)] + [(i, f"see the file of item{i}, it is here under w{i} for this license mit" if i % 5 == 0 else f"see the file item{i}, it is here w{i}") for i in range(2, 1500)]
    got = {r.doc_id: r for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    docs = {i: {w.strip(".") for w in re.split(licences.WORD, t.lower())} - {""} for i, t in rows}
    weigh = lambda w: np.log((1 + len(docs)) / (1 + sum(w in d for d in docs.values()))) + 1
    cos = max((sum(weigh(w) ** 2 for w in docs[1] & set(ws)) / np.sqrt(sum(weigh(w) ** 2 for w in docs[1]) * sum(weigh(w) ** 2 for w in ws)), n)
              for n, ws in licences.template_words())
    assert cos[1] == "MIT" and cos[0] > 0.6
    assert got[1].licence == "MIT" and got[1].score == pytest.approx(cos[0], abs=2e-6)


def test_licence_texts_and_wrapped_headers(spark):
    import textwrap
    wrap = lambda *paragraphs: "\n\n".join(textwrap.fill(p, 78) for p in paragraphs)
    L = licences
    own = "Copyright (c) 2021, Some Body."
    gpl2 = textwrap.fill(L._gnu("", "2"), 70).replace("\n", "\n * ")
    apache = "\n".join("# " + x if x else "#" for x in wrap("Copyright 2020 The Authors", L._APACHE, L._APACHE_AS_IS).split("\n"))
    bsd3 = wrap(own + " All rights reserved.", L._BSD, "3. " + L._BSD_NAME, L._BSD_AS_IS)
    cases = [("MIT", wrap(own, L._MIT, L._MIT_KEEP, L._AS_IS)), ("ISC", wrap(own, L._ISC, L._ISC_AS_IS)), ("BSD-3-Clause", bsd3),
             ("BSD-2-Clause", wrap(own + " All rights reserved.", L._BSD, L._BSD_AS_IS)), ("GPL-2.0", f"/* prog.c\n *\n * {gpl2}\n */\nint main(void);\n"),
             ("Apache-2.0", f"{apache}\n\nimport os\nprint(os.name)\n"), ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007\n\nPreamble"),
             ("BSD-2-Clause", "/*\n * " + wrap(own, L._BSD, L._BSD_AS_IS).replace("\n", "\n * ") + "\n */\n" + "int x;\nlong y(z);\n" * 40),
             ("Proprietary", own + "\nAll rights reserved."), (None, "The permission of the software notice is a matter of some conditions."),
             (None, "\n" * 30000 + "#\n" * 30000 + "license")]
    rows = [(i, t) for i, (_, t) in enumerate(cases)] + [(100 + i, f"filler words number {i} of the text") for i in range(60)]
    got = {r.doc_id: r.licence for r in L.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got.get(i) for i in range(len(cases))] == [c for c, _ in cases] and not [k for k in got if k >= 100]


def brute_repeats(rows):
    seen, out = set(), {}
    for i, b in sorted(rows):
        covered, own = bytearray(len(b)), set()
        for p in range(len(b) - 49):
            w = b[p:p + 50]
            if w in seen:
                covered[p:p + 50] = b"\1" * 50
            else:
                own.add(w)
        seen |= own
        kept = bytes(x for x, c in zip(b, covered) if not c)
        out[i] = (len(b), sum(covered), len(re.findall(rb"\x01+", bytes(covered))), hashlib.sha256(kept).hexdigest())
    return out


def test_suffix_dedup(table):
    rows = {(r.doc_id if r.doc_id is not None else suffix_dedup.LAST, (r.text or "").encode()) for r in table.collect()}
    want = brute_repeats(rows)
    got = suffix_dedup.repeat_digests(table).collect()
    assert len(got) == table.count()
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id if r.doc_id is not None else suffix_dedup.LAST]


def test_suffix_dedup_edges(spark):
    rng = np.random.default_rng(5)
    base = "".join(rng.choice(list("abcdef "), 3000))
    rows = [(i, "".join(base[a: a + int(rng.integers(30, 140))] + rng.choice(["", "é", "#" * 3]) for a in rng.integers(0, 2800, 12))) for i in range(40)]
    rows += [(50, "a" * 300), (51, "a" * 49), (52, "a" * 50), (53, "ab" * 200), (54, "b" + "ab" * 100)]
    got = suffix_dedup.repeat_digests(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = brute_repeats([(i, t.encode()) for i, t in rows])
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == want


@pytest.mark.parametrize("clash", [None, 7])
def test_suffix_dedup_rows_without_or_with_the_same_id(spark, clash):
    rng = np.random.default_rng(8)
    other = lambda n: "".join(rng.choice(list("abcdefghij "), n))
    rows = [(1, PASSAGE)] + [(clash, t) for t in (other(40) + PASSAGE + other(150), other(300), PASSAGE, other(90) + PASSAGE[:70] + other(20), "", None)]
    shared = other(120)
    rows += [(clash, other(33) + shared), (clash, shared + other(50)), (9, "x" + shared), (clash, rows[1][1]), (clash, rows[1][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    rank = lambda i: suffix_dedup.LAST if i is None else i

    def want(i, t):  # strings of smaller documents only
        b = (t or "").encode()
        seen = {o[p:p + 50] for j, u in rows if rank(j) < rank(i) for o in [(u or "").encode()] for p in range(len(o) - 49)}
        covered = bytearray(len(b))
        for p in range(len(b) - 49):
            if b[p:p + 50] in seen:
                covered[p:p + 50] = b"\1" * 50
        return bytes(x for x, c in zip(b, covered) if not c)

    got = sorted((repr(r.doc_id), r.n_bytes, r.n_removed, r.kept_sha256) for r in suffix_dedup.repeat_digests(df).collect())
    expect = [(repr(i), len((t or "").encode()), len((t or "").encode()) - len(want(i, t)), hashlib.sha256(want(i, t)).hexdigest()) for i, t in rows]
    assert got == sorted(expect)
    kept = sorted((repr(r.doc_id), r.text or "") for r in suffix_dedup.remove_repeats(df).collect())
    assert kept == sorted((repr(i), want(i, t).decode()) for i, t in rows)


def test_suffix_dedup_long_text_in_parts(monkeypatch):
    rng = np.random.default_rng(6)
    raw = rng.integers(97, 123, 9000).astype(np.uint8)
    whole = list(suffix_dedup._pieces(raw, np.array([0, 9000])))
    monkeypatch.setattr(suffix_dedup, "CHUNK", 1000)
    parts = list(suffix_dedup._pieces(raw, np.array([0, 9000])))
    strings = lambda ps: [x for _, s, c, _, _, _ in ps for a, n in zip(s, c) for x in range(a, a + n)]
    assert len(parts) > 3 and strings(parts) == strings(whole) == list(range(9000 - 49))


def test_simhash(table):
    from xxhash import xxh64
    rows = [(r.doc_id, (r.text or "").encode()) for r in table.collect()]
    fp = []
    for _, b in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), b))
        h = [xxh64(b" ".join(w[i:i + 3]), seed=42).intdigest() for i in range(max(1, len(w) - 2))] if w else []
        fp.append(sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in h) > len(h)))
    at = {i: i for i in range(len(rows))}

    def find(x):
        while at[x] != x:
            x = at[x]
        return x

    bits = np.array(fp, np.uint64)
    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(bits ^ bits[i]) <= 2).tolist():
            at[find(max(i, j))] = find(min(i, j))
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[find(i)] = min(k, least.get(find(i), k))
    want = sorted((repr(k), "%016x" % fp[i], repr(least.get(find(i)))) for i, (k, _) in enumerate(rows))
    got = simhash.near_duplicates(table).select("doc_id", simhash.hex_fingerprint().alias("f"), "component_id").collect()
    assert sorted((repr(r.doc_id), r.f, repr(r.component_id)) for r in got) == want


@pytest.mark.parametrize("bits,segments", [(2, 2), (3, 2), (3, 4), (1, 1), (4, 3)])
def test_hamming_links(spark, bits, segments):
    rng = np.random.default_rng(bits)
    base = rng.integers(0, 2**63, 30)
    v = np.unique(np.concatenate([base] + [base ^ np.bitwise_or.reduce(1 << rng.integers(0, 63, (30, n)), axis=1) for n in (1, 2, 3, 4, 5)]))
    df = spark.createDataFrame([(int(x),) for x in v], "fp long")
    got = sorted((r.a, r.b) for r in simhash.link_fingerprints(df, bits, segments).collect())
    assert got == sorted((int(a), int(b)) for a in v for b in v if a < b and int(a ^ b).bit_count() <= bits)


def test_empty_tables(none):
    assert bpe.round_trip(none, WORD_VOCABULARY).count() == 0
    assert sketches.edited_fingerprints(none).count() == 0
    assert langid.predict(none, langid.train(none)).count() == 0
    assert sharding.shard_by_bytes(none.withColumn("size", F.lit(1).cast("long")), "size", sharding.order_key(F.xxhash64("text"), F.col("doc_id"))).count() == 0
    assert token_files.count_documents(none, BYTE_VOCABULARY).count() == 0
    assert packing.pack(packing.cut_documents(none, BYTE_VOCABULARY)).count() == 0
    assert licences.scan_files(none, F.col("source")).count() == 0
    assert suffix_dedup.repeat_digests(none).count() == 0
    assert simhash.near_duplicates(none).count() == 0


def test_clashing_columns_pass_through(odd):
    assert sorted(suffix_dedup.remove_repeats(odd).columns) == sorted(odd.columns)
    df = packing.pack(odd.withColumn("length", F.lit(3).cast("long")))
    assert set(odd.columns) | {"sequence_id", "offset"} == set(df.columns) and df.count() == len(ODD)


def test_registry_names():
    assert [n.split("_")[0] for n in REGISTRY] == [f"op{i}" for i in range(1, 14)]


def test_pipeline(spark, docs):
    import corpus_pipeline as p
    assert [n for n, _ in p.STAGES] == ["language_id", "near_dedup", "repeat_removal", "packing"]
    kept = p.language_id(spark, docs, SMALL)
    assert kept.count() >= 0.95 * docs.count() and kept.columns == docs.columns
    from sitelens.llm.common import saved
    one = saved(p.near_dedup(spark, saved(kept), SMALL))
    comps = simhash.near_duplicates(kept)
    assert sorted(r.doc_id for r in one.collect()) == sorted(r.component_id for r in comps.select("component_id").distinct().collect())
    cut = {r.doc_id: r for r in p.repeat_removal(spark, one, SMALL).collect()}
    want = brute_repeats([(r.doc_id, (r.text or "").encode()) for r in one.collect()])
    for r in one.collect():
        n, gone, runs, _ = want[r.doc_id]
        assert n - gone <= len(cut[r.doc_id].text.encode()) <= n - gone + 6 * runs and cut[r.doc_id].n_chars == len(cut[r.doc_id].text)
    assert p.run(spark, SMALL).count() >= len(cut)
