"""Language identification by nearest centroid.

``train`` learns a small model from labelled documents, ``predict`` applies it
to every text.

Method: a text becomes a normalised TF-IDF vector of hashed byte n-grams
(``GRAMS`` long) of its lower-cased letters, words set apart by one space.
Every language has ``CENTROIDS`` centroids from spherical k-means over its
training vectors.  A text gets the language of the centroid with the largest
cosine; a text whose cosine lies below the ``floor`` of its length class is too
far from all of them and is rejected.  The floor lies between the cosines that
training texts reach in their own language and those they reach without it.

Document frequencies count every training document.  k-means and floors use a
sample: of every language the ``SAMPLE`` / languages distinct texts (at least
``LEAST``) with the smallest hashes, so no language is lost, however many there
are, and copies count once.  One task clusters one language's sample; the
driver holds no vector of a text, only the centroids (``CENTROIDS`` rows of
``DIMS`` numbers a language) and the cosines from which floors are made.

Defined results: a null text or one without a letter is ``und`` with score 0
and rejected; without training documents every text is ``und``; repeated rows
get equal results, and null or repeated ids do not matter, as no id is read;
very long texts are read whole, a part at a time.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitelens.llm.bpe import row_slices
from sitelens.llm.common import saved

DIMS = 8192
GRAMS = (1, 2, 3, 4)
CENTROIDS = 4
SAMPLE = 1600
LEAST = 32  # sampled texts of a language, however many languages there are
ITERATIONS = 12
BEGINNINGS = (16, 64, 256, 1024)  # characters: beginnings of half the sampled texts, which give floors to short texts
UNKNOWN = "und"
ROWS = 512  # texts whose vectors are held at a time
PART = 1 << 19  # bytes of text made into n-grams at a time


def _letters() -> np.ndarray:
    """Byte map: ASCII letters in lower case, bytes of other scripts kept, the rest a space."""
    out = np.full(256, 32, np.uint8)
    for b in range(256):
        ch = chr(b)
        if "a" <= ch <= "z" or b >= 128:
            out[b] = b
        elif "A" <= ch <= "Z":
            out[b] = b + 32
    return out


_MAP = _letters()
_KEYS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)


def vectors(texts: pa.Array) -> np.ndarray:
    """Counts of hashed n-grams per text, one row of DIMS each."""
    col = texts.cast(pa.large_binary()).fill_null(b"")
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset: col.offset + len(col) + 1]
    raw = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] else np.empty(0, np.uint8)
    out = np.zeros((len(col), DIMS), np.float32)
    i = 0
    while i < len(col):
        j = max(i + 1, int(np.searchsorted(off, off[i] + PART, "right")) - 1)
        for a in range(int(off[i]), int(off[j]), PART):
            e = min(int(off[j]), a + PART)
            part = raw[a:e]
            b = _MAP[part]
            two = np.flatnonzero((part[:-1] == 0xC3) & (part[1:] >= 0x80) & (part[1:] <= 0x9E)) + 1
            b[two] |= 0x20  # Latin-1 capitals
            doc = np.repeat(np.arange(i, j), np.diff(np.clip(off[i: j + 1], a, e)))
            # one space between words: a space after a space is dropped
            keep = np.ones(len(b), bool)
            keep[1:] = (b[1:] != 32) | (b[:-1] != 32) | (doc[1:] != doc[:-1])
            b, doc = b[keep].astype(np.uint32), doc[keep]
            h = np.zeros(len(b), np.uint32)
            for n in range(1, max(GRAMS) + 1):
                h = (h[: len(b) - n + 1] + b[n - 1:] + 1) * _KEYS[n - 1]
                h ^= h >> np.uint32(15)
                if n in GRAMS and h.size:
                    same = doc[n - 1:] == doc[: len(doc) - n + 1]
                    if n == 1:
                        same &= b != 32
                    at = doc[: len(doc) - n + 1][same] * DIMS + (h[same] % np.uint32(DIMS)).astype(np.int64) - i * DIMS
                    out[i:j] += np.bincount(at, minlength=(j - i) * DIMS).reshape(-1, DIMS).astype(np.float32)
        i = j
    return out


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit vectors of what lies above an even spread over all buckets, so that long texts do not all look alike."""
    v = np.maximum(np.log1p(counts) - np.log1p(counts.sum(axis=1, keepdims=True) / DIMS), 0) * idf
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


@dataclass
class Model:
    idf: np.ndarray
    centroids: np.ndarray
    labels: list[str]
    floor: np.ndarray  # by length class


def length_class(grams: np.ndarray) -> np.ndarray:
    """Class of a text by its number of n-grams: whole part of the binary logarithm, at most 15."""
    return np.clip(np.log2(np.maximum(grams, 1)).astype(np.int64), 0, 15)


def _kmeans(v: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means from the farthest points; at most k unit centroids."""
    mean = v.mean(axis=0)
    picked = [int(np.argmax(v @ mean))]
    near = v @ v[picked[0]]
    while len(picked) < min(k, len(v)):
        picked.append(int(np.argmin(near)))
        near = np.maximum(near, v @ v[picked[-1]])
    c = v[picked]
    for _ in range(ITERATIONS):
        at = np.argmax(v @ c.T, axis=1)
        c = np.stack([v[at == i].sum(axis=0) if (at == i).any() else c[i] for i in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


def _floor(own: np.ndarray, foreign: np.ndarray) -> float:
    """Halfway between what nearly all texts reach in their own language and what few do in the others, as if its own
    had not been learned; where both overlap, what nearly all reach."""
    low, high = float(np.quantile(own, 0.01)), float(np.quantile(foreign, 0.95))
    return min(low, (low + high) / 2)


def _cutoffs(src: DataFrame, lang: str, per: int) -> dict[str, int]:
    """Per language the per-th smallest distinct text hash (or the largest, if there are fewer)."""
    def run(batches):
        least = {}
        for batch in batches:
            d = batch.to_pandas()
            for k, h in d.groupby("lang")["hash"]:
                least[k] = np.unique(np.concatenate([least.get(k, np.empty(0, np.int64)), h.to_numpy()]))[:per]
        rows = [(k, int(x)) for k, h in least.items() for x in h]
        yield pa.RecordBatch.from_pydict({"lang": pa.array([k for k, _ in rows], pa.string()), "hash": pa.array([x for _, x in rows], pa.int64())})

    least = src.select(F.col(lang).alias("lang"), "hash").mapInArrow(run, "lang string, hash long").distinct()
    for by in (["lang", F.pmod("hash", F.lit(256))], ["lang"]):  # parts of a language first, so that no task sees what all tasks found
        least = least.withColumn("r", F.row_number().over(Window.partitionBy(*by).orderBy("hash"))).where(F.col("r") <= per)
    return {r["lang"]: r["cut"] for r in least.groupBy("lang").agg(F.max("hash").alias("cut")).collect()}


def _batch(rows: DataFrame) -> np.ndarray:
    return np.frombuffer(b"".join(rows), "<f4").reshape(-1, DIMS)


def train(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Model:
    """A model from the rows of df with a language; key is not read.

    The driver receives document frequencies, the centroids and three numbers a sampled text.
    """
    src = df.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(text, lang, F.xxhash64(text).alias("hash"))
    n_langs = src.select(lang).distinct().count()
    per = max(LEAST, sample // max(1, n_langs))
    cut = _cutoffs(src, lang, per)

    def run(batches):
        freq, n, seen = np.zeros(DIMS, np.int64), 0, set()
        for batch in batches:
            langs, hashes = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for a, e in row_slices(batch.column(0), rows=ROWS):
                counts = vectors(batch.column(0).slice(a, e - a))
                freq += (counts > 0).sum(axis=0)
                n += e - a
                pick = []
                for i in range(a, e):
                    if hashes[i] <= cut[langs[i]] and (langs[i], hashes[i]) not in seen:
                        seen.add((langs[i], hashes[i]))
                        pick.append(i)
                if pick:
                    texts = [batch.column(0)[i].as_py() for i in pick]
                    marks = [zlib.crc32(x[:256].encode()) for x in texts]
                    half = [i for i, h in enumerate(marks) if h % 2]
                    begun = vectors(pa.array([texts[i][: BEGINNINGS[(marks[i] >> 1) % len(BEGINNINGS)]] for i in half], pa.string()))
                    at, n_whole = pick + [pick[i] for i in half], len(pick)
                    yield pa.RecordBatch.from_pydict({
                        "lang": pa.array([langs[i] for i in at], pa.string()), "hash": pa.array([hashes[i] for i in at], pa.int64()),
                        "whole": pa.array([i < n_whole for i in range(len(at))]), "n": pa.array([0] * len(at), pa.int64()),
                        "counts": pa.array([np.ascontiguousarray(c, "<f4").tobytes() for c in (*counts[np.array(pick) - a], *begun)], pa.binary()),
                        "freq": pa.nulls(len(at), pa.list_(pa.int64()))})
        yield pa.RecordBatch.from_pydict({"lang": pa.nulls(1, pa.string()), "hash": pa.nulls(1, pa.int64()), "whole": pa.nulls(1, pa.bool_()),
                                          "n": pa.array([n], pa.int64()), "counts": pa.nulls(1, pa.binary()),
                                          "freq": pa.array([freq.tolist()], pa.list_(pa.int64()))})

    # a task gives its sampled vectors, those of beginnings, and one row of document frequencies
    got = saved(src.mapInArrow(run, "lang string, hash long, whole boolean, n long, counts binary, freq array<long>"), "langid")
    n = got.agg(F.sum("n")).first()[0] or 0
    freq = np.zeros(DIMS)
    for r in got.where("freq is not null").select(F.posexplode("freq").alias("i", "f")).groupBy("i").agg(F.sum("f").alias("f")).collect():
        freq[r["i"]] = r["f"]
    idf = (np.log((1 + n) / (1 + freq)) + 1).astype(np.float32)

    def cluster(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("hash")
        counts = _batch(group["counts"])
        counts = counts[counts.sum(axis=1) > 0]
        found = _kmeans(weighted(counts, idf), CENTROIDS).astype("<f4") if len(counts) else ()
        return pd.DataFrame({"lang": [group["lang"].iloc[0]] * len(found), "i": range(len(found)), "centroid": [c.tobytes() for c in found]})

    picked = got.where("counts is not null").dropDuplicates(["lang", "hash", "whole"])
    rows = picked.where("whole").groupBy("lang").applyInPandas(cluster, "lang string, i int, centroid binary").collect()
    rows.sort(key=lambda r: (r["lang"], r["i"]))
    labels = [r["lang"] for r in rows]
    c = _batch([bytes(r["centroid"]) for r in rows])
    return Model(idf, c, labels, _floors(picked, idf, c, labels))


def _floors(picked: DataFrame, idf: np.ndarray, centroids: np.ndarray, labels: list[str]) -> np.ndarray:
    """The floor of every length class, from the cosines of all sampled texts and beginnings."""
    floor = np.zeros(16)
    if not labels:
        return floor

    def run(batches):
        names = np.array(labels, object)
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                part = batch.slice(a, ROWS)
                counts = _batch(part.column(1).to_pylist())
                keep = counts.sum(axis=1) > 0
                counts, of = counts[keep], np.array(part.column(0).to_pylist(), object)[keep]
                cos = weighted(counts, idf) @ centroids.T
                own = of[:, None] == names[None, :]
                yield pa.RecordBatch.from_pydict({"at": pa.array(length_class(counts.sum(axis=1)), pa.int32()),
                                                  "own": pa.array(np.where(own, cos, 0).max(axis=1).astype(np.float64)),
                                                  "foreign": pa.array(np.where(own, 0, cos).max(axis=1).astype(np.float64))})

    got = picked.select("lang", "counts").mapInArrow(run, "at int, own double, foreign double").toPandas()
    for i in range(16):  # a class without many samples takes in the ones below it
        inside = got[got["at"] <= i if (got["at"] == i).sum() < 20 else got["at"] == i]
        floor[i] = _floor(inside["own"].to_numpy(), inside["foreign"].to_numpy()) if len(inside) >= 20 else 0
    return floor


def predict(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """df with lang_pred, score (cosine, 0 to 1) and accepted (columns of those names are replaced)."""
    new = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("accepted", T.BooleanType())]
    names = {f.name for f in new}
    schema = T.StructType([f for f in df.schema.fields if f.name not in names] + new)

    def run(batches):
        import regex
        m = model  # DIMS x CENTROIDS numbers a language, shipped with the function
        letter = regex.compile(r"\p{L}")
        labels = np.array(m.labels + [UNKNOWN], object)
        for batch in batches:
            texts = batch.column(text)
            for a, e in row_slices(texts, rows=ROWS):
                part = batch.slice(a, e - a)
                counts = vectors(part.column(text))
                cos = weighted(counts, m.idf) @ m.centroids.T if len(m.centroids) else np.zeros((e - a, 0))
                best = cos.argmax(axis=1) if cos.shape[1] else np.full(e - a, -1)
                score = np.clip(cos.max(axis=1, initial=0.0).astype(np.float64), 0, 1)
                known = np.array([x is not None and letter.search(x) is not None for x in part.column(text).to_pylist()], bool)
                ok = known & (score >= m.floor[length_class(counts.sum(axis=1))]) if cos.shape[1] else np.zeros(e - a, bool)
                cols = {n: part.column(n) for n in schema.names if n not in names}
                yield pa.RecordBatch.from_pydict(cols | {
                    "lang_pred": pa.array(labels[np.where(known, best, -1)].tolist(), pa.string()),
                    "score": pa.array(np.where(known, score, 0.0)), "accepted": pa.array(ok, pa.bool_())})

    return df.mapInArrow(run, schema)
