"""SimHash near-duplicates by multi-index hashing.

``fingerprints`` gives every text a 64-bit SimHash of its word shingles;
``link_fingerprints`` finds all pairs of distinct fingerprints at most
``bits`` apart; ``near_duplicates`` joins both into components.

Method: a fingerprint is cut into ``segments`` parts, and a table keyed by
(part, value) holds every distinct fingerprint.  Two fingerprints at most d
bits apart differ by at most r = d div m bits in one of the first (d mod m) + 1
parts, or by at most r - 1 in one of the rest; so each looks up the small
Hamming ball of that radius around each of its parts, and every match is
verified on all 64 bits.  Pairs come once: of two parts that match, the first
counts.

Equal fingerprints are one row from the start (a group of copies, however
large, is one fingerprint with its smallest document), so no pairs are made
within it.

Defined results: a null or empty text, or one without words, has fingerprint
zero and is linked like any other; fewer words than a shingle count as one
shingle; rows that repeat a document share its component; a null doc_id takes
part but is never a component_id unless no other document is reachable (then
component_id is null).
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitelens.llm.bpe import row_slices
from sitelens.llm.common import saved
from sitelens.llm.components import components

WORDS = 3
BITS = 2
SEGMENTS = 2
SEED = 42
UPPER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
AT_ONCE = 1 << 16  # shingles whose bits are summed together


def _hashes(raw: bytes, words: int) -> np.ndarray:
    """XXH64 of every shingle of a text's lower-cased words."""
    from xxhash import xxh64_intdigest
    found = raw.translate(UPPER).split()  # ASCII white space, as in [^\x20\x09-\x0D]+
    if not found:
        return np.empty(0, np.uint64)
    line = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(found) - words + 1)
    last = ends[words - 1:] if len(found) >= words else ends[-1:]
    return np.fromiter((xxh64_intdigest(line[a:b], SEED) for a, b in zip(starts[:n].tolist(), last.tolist())), np.uint64, n)


def simhash(raw: bytes, words: int = WORDS) -> int:
    """Fingerprint of one text: a bit is 1 if set in over half the hashes."""
    h = _hashes(raw, words)
    if not h.size:
        return 0
    total = np.zeros(64, np.int64)
    for a in range(0, len(h), AT_ONCE):
        part = np.ascontiguousarray(h[a: a + AT_ONCE], ">u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(total * 2 > len(h)).tobytes(), "big")


def fingerprints(df: DataFrame, words: int = WORDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp): fp holds the 64 bits as a signed long."""
    schema = T.StructType([df.schema[key], T.StructField("fp", T.LongType())])

    def run(batches):
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).cast(pa.binary())
            for a, e in row_slices(texts):
                fp = np.array([simhash(x or b"", words) for x in texts.slice(a, e - a).to_pylist()], np.uint64)
                yield pa.RecordBatch.from_pydict({key: keys.slice(a, e - a), "fp": pa.array(fp.view(np.int64))})

    return df.select(key, text).mapInArrow(run, schema)


def _parts(segments: int) -> list[tuple[int, int]]:
    """(shift, width) of each part of 64 bits."""
    cut = [64 * i // segments for i in range(segments + 1)]
    return [(a, b - a) for a, b in zip(cut, cut[1:])]


def link_fingerprints(fps: DataFrame, bits: int = BITS, segments: int = SEGMENTS) -> DataFrame:
    """Pairs (a, b), a < b, of the distinct values in column fp at most ``bits`` apart."""
    radius = [bits // segments - (i > bits % segments) for i in range(segments)]
    parts = _parts(segments)

    def value(col, i):
        return F.shiftrightunsigned(col, parts[i][0]).bitwiseAND(F.lit((1 << parts[i][1]) - 1 if parts[i][1] < 64 else -1))

    ball, cell = [], []
    for i, r in enumerate(radius):
        if r < 0:
            continue
        flips = [sum(1 << x for x in c) for k in range(r + 1) for c in combinations(range(parts[i][1]), k)]
        own = value(F.col("fp"), i)
        ball += [F.struct(F.lit(i).alias("part"), own.bitwiseXOR(F.lit(m if m < 1 << 63 else m - (1 << 64)).cast("long")).alias("value")) for m in flips]
        cell.append(F.struct(F.lit(i).alias("part"), value(F.col("fp"), i).alias("value")))
    probe = fps.select(F.col("fp").alias("a"), F.explode(F.array(*ball)).alias("p")).select("a", "p.part", "p.value")
    table = fps.select(F.col("fp").alias("b"), F.explode(F.array(*cell)).alias("c")).select("b", F.col("c.part").alias("part"), F.col("c.value").alias("value"))
    diff = F.col("a").bitwiseXOR(F.col("b"))
    first = F.lit(True)  # no earlier part finds the pair
    for i, r in enumerate(radius):
        if r >= 0:
            first &= ~((F.col("part") > i) & (F.bit_count(value(diff, i)) <= r))
    return probe.join(table, ["part", "value"]).where((F.col("a") < F.col("b")) & (F.bit_count(diff) <= bits) & first).select("a", "b")


def near_duplicates(df: DataFrame, words: int = WORDS, bits: int = BITS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp, component_id) per row of df: component_id is the smallest key reachable by links."""
    each = saved(fingerprints(df, words, key, text), "fingerprints")
    nodes = saved(each.groupBy("fp").agg(F.min(key).alias("least")), "nodes")
    roots = components(link_fingerprints(nodes.select("fp"), bits), "a", "b")
    of = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = of.groupBy("root").agg(F.min("least").alias("component_id"))
    return each.join(of.join(least, "root").select("fp", "component_id"), "fp").select(key, "fp", "component_id")


def hex_fingerprint(col="fp"):
    return F.lower(F.lpad(F.hex(F.col(col)), 16, "0"))
