"""Token counts of flat, unindexed token files by a separator scan.

A token file is a plain run of little-endian ids of fixed width in which an
end-of-document id follows every document; nothing says where documents
start.  ``write_token_files`` makes such files from texts, ``scan_token_files``
counts them.

Method: byte ranges of a file are read by different tasks, in blocks of about
``BLOCK`` tokens; a vectorised compare finds where a block holds the separator's
bytes.  Prefix scans over the blocks of a file stitch the borders: the
running number of bytes says which of these places begin a token, the running number of separators gives the number of a block's first document, the last
separator before the block gives where that document began.  A document's
length is the distance between its two separators, wherever blocks end.

``count_documents`` ends documents with the vocabulary's end-of-text id, which
no ordinary text gives.  A text that holds the name of that special token holds
the id itself; its name says how often, so that its parts are put together.

Defined results: an empty document (null or empty text) has 0 tokens; ids
after the last separator form a last, unterminated document; an empty file has
none; bytes after the last whole token are no token.  A file whose separators are
not those its names tell of is an error.  Files may be of any size: a task holds
a block, or one document if that is longer.  Only where the separator's bytes
overlap with themselves (id 0, for one) is a file read whole by one task (2 GB at most).
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitelens.llm.bpe import load, row_slices
from sitelens.llm.common import saved, scratch

BLOCK = 1 << 18
FILE_BYTES = 8 << 20
WIDTH = 2  # bytes an id
SEPARATOR = 0  # the end-of-document id of files that name no other
END = "<|endoftext|>"
HEX = "0123456789ABCDEF."


def end_of_text(vocabulary: str) -> int:
    """The id of the vocabulary's end-of-text token, or of its only special token."""
    with open(vocabulary, encoding="utf-8") as f:
        special = {t["content"]: t["id"] for t in json.load(f).get("added_tokens", [])}
    if END not in special and len(special) != 1:
        raise ValueError(f"{vocabulary} names no end-of-text token; give end_id")
    return special.get(END, next(iter(special.values())))


def _separator(end_id: int, width: int) -> str:
    """The id's bytes, as the line separator of Spark's text writer takes them."""
    return end_id.to_bytes(width, "little").decode("latin-1")


def _symbols(end_id: int, width: int) -> str:
    """The letters of names, none of them a byte of the separator's first."""
    return HEX if end_id & 255 not in HEX.encode() else "GHIJKLMNOPQRSTUVW"


def write_token_files(df: DataFrame, vocabulary: str, out: str, key: str = "doc_id", text: str = "text",
                      end_id: int | None = None, width: int = WIDTH, file_bytes: int = FILE_BYTES) -> None:
    """Encode every text and write flat files below ``out``/kind=tokens, and who is in them below ``out``/kind=names.

    The text writer puts a separator after every row as it is, so a row's ids
    and the end id as the separator make the flat file, on any file system
    that Spark writes to.  Each task writes its own rows, in any order and
    without an exchange; a new file begins when one has ``file_bytes``.  A
    document's name (how many separators are before it in the file, its key, and
    how many it holds itself) leaves in the same task and job as its ids, so a
    repeated task replaces both.  end_id: the vocabulary's end-of-text id, if not given.
    """
    end_id = end_of_text(vocabulary) if end_id is None else end_id
    kind = "<u2" if width == 2 else "<u4"

    def run(batches):
        bpe = load(vocabulary)
        if bpe.off.size - 1 > 1 << (8 * width):
            raise ValueError(f"ids do not fit {width} bytes")
        file, ordinal, held = 0, 0, 0
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for a, e in row_slices(texts):
                got, per = bpe.encode(texts.slice(a, e - a))
                raw = got.astype(kind).tobytes()
                cut = np.concatenate([[0], np.cumsum(per)]) * width
                own = np.diff(np.concatenate([[0], np.cumsum(got == end_id)])[cut // width])
                files, ordinals = [], []
                for size, inner in zip((per * width).tolist(), own.tolist()):
                    if held >= file_bytes:
                        file, ordinal, held = file + 1, 0, 0
                    files.append(file)
                    ordinals.append(ordinal)
                    ordinal, held = ordinal + 1 + inner, held + size + width
                yield pa.RecordBatch.from_pydict({
                    "name": keys.slice(a, e - a), "file": pa.array(files, pa.int32()), "ordinal": pa.array(ordinals, pa.int64()), "own": pa.array(own, pa.int64()),
                    "ids": pa.array([raw[x:y] for x, y in zip(cut[:-1], cut[1:])], pa.binary())})

    ids = df.select(F.col(key).cast("string").alias("name"), text).mapInArrow(run, "name string, file int, ordinal long, own long, ids binary")
    # ordinal.own.key; a null key has no third part, and no own separator is an empty second one
    own = F.when(F.col("own") > 0, F.hex(F.col("own").cast("string").cast("binary"))).otherwise(F.lit(""))
    name = F.translate(F.concat_ws(".", F.hex(F.col("ordinal").cast("string").cast("binary")), own, F.hex(F.col("name").cast("binary"))), HEX, _symbols(end_id, width))
    rows = ids.select("file", "ordinal", F.explode(F.array(
        F.struct(F.lit("tokens").alias("kind"), F.col("ids").alias("value")),
        F.struct(F.lit("names").alias("kind"), name.cast("binary").alias("value")))).alias("r"))
    (rows.select("r.kind", "file", "ordinal", "r.value").sortWithinPartitions("kind", "file", "ordinal")
     .select("kind", "file", F.col("value").cast("string").alias("value"))
     .write.partitionBy("kind", "file").option("lineSep", _separator(end_id, width)).option("encoding", "ISO-8859-1").text(out))


def _unit(path: str):
    """The file a row was read from: number of its task and of the file in it."""
    return F.concat_ws("-", F.regexp_extract(path, r"/part-(\d+)", 1), F.regexp_extract(path, r"/file=(\d+)/", 1))


def read_names(spark: SparkSession, out: str, key_type: T.DataType, key: str = "doc_id", end_id: int = SEPARATOR, width: int = WIDTH) -> DataFrame:
    """(file, ordinal, own, key) of every document that ``write_token_files`` wrote: separators before it and in it."""
    lines = (spark.read.option("lineSep", _separator(end_id, width)).option("encoding", "ISO-8859-1").text(f"{out}/kind=names")
             .select(F.split(F.translate("value", _symbols(end_id, width), HEX), r"\.").alias("n"), F.col("_metadata.file_path").alias("path")))

    def text_of(i):
        return F.unhex(F.get("n", F.lit(i))).cast("string")

    own = F.when(F.get("n", F.lit(1)) == "", F.lit(0)).otherwise(text_of(1).cast("long"))
    return lines.select(_unit("path").alias("file"), text_of(0).cast("long").alias("ordinal"), own.alias("own"), text_of(2).cast(key_type).alias(key))


def _find(raw: np.ndarray, pattern: bytes) -> np.ndarray:
    """Every place of raw where the pattern begins, overlaps too."""
    n = len(raw) - len(pattern) + 1
    if n <= 0:
        return np.empty(0, np.int64)
    hit = raw[:n] == pattern[0]
    for i in range(1, len(pattern)):
        hit &= raw[i: n + i] == pattern[i]
    return np.flatnonzero(hit)


BLOCKS = "path string, split long, seq long, size long, file_size long, hits array<long>"


def _block(at: tuple, seq: int, size: int, hits: np.ndarray) -> pa.RecordBatch:
    path, split, file_size = at
    return pa.RecordBatch.from_pydict({"path": pa.array([path], pa.string()), "split": pa.array([split], pa.int64()), "seq": pa.array([seq], pa.int64()), "size": pa.array([size], pa.int64()),
                                       "file_size": pa.array([file_size], pa.int64()), "hits": pa.array([hits], pa.list_(pa.int64()))})


def _range_blocks(spark: SparkSession, path: str, pattern: bytes, block: int) -> DataFrame:
    """(path, split, seq, size, file_size, hits) of every block of all files below path.

    Spark's text source reads byte ranges of a file in different tasks and ends
    lines at the separator's bytes; a task joins its lines with those bytes again and so
    has its part of the file as it is, in blocks of at least ``block`` bytes that end with the
    separator's bytes.  hits: places of those bytes from the block's start, whether or not a token begins there.
    """
    lines = (spark.read.option("lineSep", pattern.decode("latin-1")).option("encoding", "ISO-8859-1").option("recursiveFileLookup", "true").text(path)
             .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split"), F.col("_metadata.file_size").alias("file_size"),
                     F.col("value").cast("binary").alias("line")))

    def run(batches):
        at, seq, held, size = None, 0, [], 0

        def cut():
            raw = b"".join(held)
            return _block(at, seq, len(raw), _find(np.frombuffer(raw, np.uint8), pattern))

        for batch in batches:
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
            values = batch.column(3).to_pylist()
            i = 0
            while i < len(keys):
                if keys[i] != at:
                    if held:
                        yield cut()
                    at, seq, held, size = keys[i], 0, [], 0
                j = i
                while j < len(keys) and keys[j] == at and size < block:
                    held += (values[j], pattern)
                    size += len(values[j]) + len(pattern)
                    j += 1
                if size >= block:
                    yield cut()
                    seq, held, size = seq + 1, [], 0
                i = j
        if held:
            yield cut()

    return lines.mapInArrow(run, BLOCKS)


def _whole_blocks(spark: SparkSession, path: str, pattern: bytes, block: int) -> DataFrame:
    """The same of files read whole, for separators whose bytes overlap with themselves (such as id 0):
    where ranges of a file meet in a run of such bytes, lines do not say how many there are."""
    width = len(pattern)

    def run(batches):
        for batch in batches:
            for name, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = np.frombuffer(raw.as_buffer(), np.uint8)
                ids = data[: len(data) // width * width].view(f"<u{width}")
                for seq, a in enumerate(range(0, len(ids), block)):
                    part = ids[a: a + block]
                    yield _block((name, 0, len(data)), seq, len(part) * width, np.flatnonzero(part == int.from_bytes(pattern, "little")) * width)

    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content").mapInArrow(run, BLOCKS)


def scan_token_files(spark: SparkSession, path: str, end_id: int = SEPARATOR, width: int = WIDTH, block: int = BLOCK) -> DataFrame:
    """Columns path, ordinal (from 0), start (token place), n_tokens, terminated."""
    pattern = end_id.to_bytes(width, "little")
    overlaps = any(pattern[:i] == pattern[-i:] for i in range(1, width))
    at = ["path", "split", "seq"]
    blocks = saved(_whole_blocks(spark, path, pattern, block) if overlaps else _range_blocks(spark, path, pattern, block * width), "blocks")
    order = Window.partitionBy("path").orderBy("split", "seq")
    before = order.rowsBetween(Window.unboundedPreceding, -1)

    # first scan: bytes before a block say which of its hits are at a token's start
    places = blocks.select(*at, F.coalesce(F.sum("size").over(before), F.lit(0)).alias("off"))
    byte = F.transform("hits", lambda h: h + F.col("off"))
    ends = F.transform(F.filter(byte, lambda x: (x % width == 0) & (x + width <= F.col("file_size"))), lambda x: F.floor(x / width))
    found = saved(blocks.join(places, at).select(*at, F.floor(F.col("file_size") / width).alias("tokens"), ends.alias("ends")), "separators")

    # second scan: separators before a block, and the last of them
    last = F.when(F.size("ends") > 0, F.element_at("ends", -1))
    scan = found.select(*at, F.size("ends").alias("n"), last.alias("last")).select(
        *at, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), F.coalesce(F.last("last", ignorenulls=True).over(before), F.lit(-1)).alias("carry"),
        F.lead("seq").over(order).isNull().alias("final"))
    each = found.join(scan, at)
    # the last block ends an open document, if its last token is no separator
    open_end = F.col("final") & (F.coalesce(last, F.col("carry")) < F.col("tokens") - 1)
    ends = F.transform("ends", lambda e: F.struct(e.alias("end"), F.lit(True).alias("terminated")))
    ends = F.when(open_end, F.concat(ends, F.array(F.struct(F.col("tokens").alias("end"), F.lit(False).alias("terminated"))))).otherwise(ends)
    each = each.select("path", "before", "carry", ends.alias("e"))
    begin = F.transform("e", lambda x, i: F.when(i == 0, F.col("carry")).otherwise(F.col("e")[F.greatest(i - 1, F.lit(0))]["end"]) + 1)
    return (each.select("path", "before", F.arrays_zip(F.col("e"), begin.alias("b")).alias("z"))
            .select("path", "before", F.posexplode("z").alias("i", "d"))
            .select("path", (F.col("before") + F.col("i")).alias("ordinal"), F.col("d.b").alias("start"),
                    (F.col("d.e.end") - F.col("d.b")).alias("n_tokens"), F.col("d.e.terminated").alias("terminated")))


def count_documents(df: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", end_id: int | None = None,
                    width: int = WIDTH, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write texts as flat token files, scan them, and name each counted document.

    Columns: key, file, ordinal (separators before it), start, n_tokens; one row
    per row of df, also for null and repeated keys.  Which file holds a document
    depends on how Spark splits df; its count does not.
    """
    spark = df.sparkSession
    out = scratch(spark, "tokens")
    end_id = end_of_text(vocabulary) if end_id is None else end_id
    write_token_files(df, vocabulary, out, key, text, end_id, width, file_bytes)
    if df.isEmpty():  # no row, no file
        return spark.createDataFrame([], T.StructType([df.schema[key]])).selectExpr(
            f"`{key}`", "'' AS file", "0L AS ordinal", "0L AS start", "0L AS n_tokens")
    found = scan_token_files(spark, f"{out}/kind=tokens", end_id, width).withColumn("file", _unit("path"))
    return name_counts(read_names(spark, out, df.schema[key].dataType, key, end_id, width), found, key)


def name_counts(names: DataFrame, found: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, file, ordinal, start, n_tokens of every name; an error if a file's separators are not those of its names."""
    parts = names.select("file", F.col("ordinal").alias("_doc"), key, F.explode(F.sequence("ordinal", F.col("ordinal") + F.col("own"))).alias("ordinal"))
    both = parts.join(found.select("file", "ordinal", "start", "n_tokens"), ["file", "ordinal"], "full")
    wrong = F.raise_error(F.concat(F.lit("token file "), F.col("file"), F.lit(": separators and names differ at number "), F.col("ordinal").cast("string")))
    checked = both.withColumn("n_tokens", F.when(F.col("_doc").isNull() | F.col("n_tokens").isNull(), wrong.cast("long")).otherwise(F.col("n_tokens")))
    # the parts of one document, with the separators between them
    return (checked.groupBy("file", "_doc", key).agg(F.min("start").alias("start"), (F.sum("n_tokens") + F.count("*") - 1).alias("n_tokens"))
            .select(key, "file", F.col("_doc").alias("ordinal"), "start", "n_tokens"))
