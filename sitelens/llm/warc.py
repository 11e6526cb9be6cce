"""Web archives: legacy ARC files converted to WARC, and read back.

``write_arc`` makes ARC files of pages, ``convert`` turns ARC files into WARC
files, ``read_warc`` reads those; ``archive_pages`` does all three.

Method: an ARC file begins with a version block whose second line names the
version; that decides how the header line of each record is cut (version 1: URL,
address, date, type, length; version 2: also result code, checksum, location,
offset and file name).  The declared length alone says where a record ends,
whatever its bytes look like.  Each ARC record then gets what WARC asks for and ARC
lacks: a record id (from file, place and contents, so a repeated task makes
the same), an ISO date, a type (``response`` for an HTTP answer, ``resource``
for anything else), digests of block and payload, and ``revisit`` in place of
a payload that another record holds.

Of records with equal payloads of at least ``at_least`` bytes the one with the
largest page id (then the largest record id) is the response.  The choice is
made on digests and ids alone.  A Bloom filter of the payloads that several records
hold lets all other records be written where they are read; the rest are joined
to their response by digest and salt, so a payload held by a third of all records is spread over tasks.

Files are written and read with Spark's text source, as each format ends its
records with fixed bytes (ARC: a line feed, WARC: two line ends), so any file
system will do; gzip files are unpacked as a stream.  A task holds one batch of lines and
one record.  One gzip file is one task; an uncompressed file is read whole with
binaryFile (2 GB at most).

Defined results: a null text is an empty payload; a null page id is left out
of the record and comes back null, and loses against any id; rows that repeat are archived
each; a null URL is ``-``; spaces in a URL are escaped; no rows make no records; a
record cut off by the end of its file is kept with ``truncated`` set; a header
line that its version does not allow is an error.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitelens.llm.common import saved, scratch, spread_join
from sitelens.plans.bloom import with_maybe

# Formats, names and profile of the archive standards.
ARC_FIELDS = {1: 5, 2: 10}
ARC_COLUMNS = {1: "URL IP-address Archive-date Content-type Archive-length",
               2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}
WARC_VERSION = "WARC/1.0"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
ARC_END, WARC_END, LINE_END = "\n", "\r\n\r\n", "\r\n"
PAGE_ID = "X-Page-Id"
PAYLOAD_LENGTH = "WARC-Payload-Length"  # of a revisit, whose HTTP headers may not say it

DEFAULT_DATE = "19970101000000"
GZIP = {"compression": "gzip", "zlib.compress.level": "THREE"}  # half the work of the usual level, a few per cent more bytes
BATCH_BYTES = 4 << 20  # bytes of records that leave a task at a time

RECORD = "record_id string, uri string, address string, date string, kind string, page_id string, http binary, payload binary, payload_bytes long, payload_digest string, block_digest string, truncated boolean"


def base32_sha1(raw: bytes) -> str:
    return base64.b32encode(hashlib.sha1(raw).digest()).decode()


def _join(*parts) -> Column:
    """Bytes of all parts, one after the other."""
    return F.concat(*[p.cast("binary") if isinstance(p, Column) else F.lit(p).cast("binary") for p in parts])


# ---- reading: chunks of files as streams ----------------------------------------

class Stream:
    """Lines and runs of bytes of one file, given in chunks."""

    def __init__(self, chunks: Iterator[bytes]):
        self.chunks, self.held, self.at, self.place, self.done = chunks, b"", 0, 0, False

    def _more(self) -> bool:
        part = next(self.chunks, None)
        if part is None:
            self.done = True
            return False
        self.held, self.at = self.held[self.at:] + part, 0
        return True

    def line(self) -> bytes | None:
        """The next line without its end, or None at the end of the file."""
        seen = 0
        while (end := self.held.find(b"\n", self.at + seen)) < 0:
            seen = len(self.held) - self.at
            if not self._more():
                if not seen:
                    return None
                end = len(self.held)
                break
        out = self.held[self.at: end]
        self.place += min(end + 1, len(self.held)) - self.at
        self.at = min(end + 1, len(self.held))
        return out

    def take(self, n: int) -> bytes:
        """The next n bytes, or what is left."""
        parts, left = [], n
        while left:
            part = self.held[self.at: self.at + left]
            parts.append(part)
            self.at += len(part)
            left -= len(part)
            if left and not self._more():
                break
        out = b"".join(parts)
        self.place += len(out)
        return out


def _files(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, Iterator[bytes]]]:
    """(file name, chunks) of every file whose lines the batches (file, line) hold one after the other."""
    pending: list = [None]  # a chunk that belongs to the next file
    source = _chunks(batches)

    def rest(file: str, first: bytes) -> Iterator[bytes]:
        yield first
        for name, raw in source:
            if name != file:
                pending[0] = (name, raw)
                return
            yield raw

    while True:
        got = pending[0] or next(source, None)
        pending[0] = None
        if got is None:
            return
        stream = rest(*got)
        yield got[0], stream
        for _ in stream:  # what the reader left
            pass


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    for batch in batches:
        if not batch.num_rows:
            continue
        names, lines, whole = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)[0].as_py()
        a = 0
        for e in range(1, len(names) + 1):
            if e == len(names) or names[e] != names[a]:
                yield names[a], b"\n".join(lines[a:e]) + (b"" if whole else b"\n")
                a = e


def _lines(spark: SparkSession, path: str) -> list[DataFrame]:
    """(file, line, whole) of gzip files, as a stream of lines, and of other files, whole."""
    by = {"recursiveFileLookup": "true"}
    packed = spark.read.options(**by, pathGlobFilter="*.gz").option("lineSep", "\n").text(path)
    plain = spark.read.format("binaryFile").options(**by, pathGlobFilter="*[!z]").load(path)
    return [packed.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("line"), F.lit(False).alias("whole")),
            plain.select(F.col("path").alias("file"), F.col("content").alias("line"), F.lit(True).alias("whole"))]


# ---- ARC -------------------------------------------------------------------------

def write_arc(pages: DataFrame, out: str, key: str = "page_id", url: str = "url", html: str = "html", version: int | None = None) -> None:
    """One ARC record per row, one gzip file per task; version None: odd tasks write version 2.

    A record's block is the HTTP answer: status line, headers (the key is one of them), body.
    """
    versions = F.lit(version) if version else F.spark_partition_id() % 2 + 1
    body = F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).cast("binary")
    uri = F.coalesce(F.regexp_replace(F.col(f"`{url}`").cast("string"), r"\s", "%20"), F.lit("-"))
    own = F.coalesce(F.concat(F.lit(f"{PAGE_ID}: "), F.col(f"`{key}`").cast("string"), F.lit(LINE_END)), F.lit(""))
    rows = pages.select(versions.alias("v"), F.monotonically_increasing_id().alias("n"), F.when(uri == "", "-").otherwise(uri).alias("uri"), body.alias("body"), own.alias("own"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{LINE_END}Content-Type: text/html; charset=utf-8{LINE_END}Content-Length: "), F.octet_length("body").cast("string"), F.lit(LINE_END),
                    F.col("own"), F.lit(LINE_END))
    rows = rows.withColumn("http", http).withColumn("size", (F.octet_length("http") + F.octet_length("body")).cast("string"))
    head = F.concat_ws(" ", "uri", F.lit("0.0.0.0"), F.lit(DEFAULT_DATE), F.lit("text/html"),
                       F.when(F.col("v") == 2, F.lit("200 - - 0 -")), "size")
    names = F.when(F.col("v") == 2, F.lit(ARC_COLUMNS[2])).otherwise(F.lit(ARC_COLUMNS[1]))
    block = F.concat(F.col("v").cast("string"), F.lit(" 0 sitelens\n"), names, F.lit("\n"))
    first = F.concat(F.concat_ws(" ", F.lit("filedesc://pages.arc 0.0.0.0"), F.lit(DEFAULT_DATE), F.lit("text/plain"),
                                 F.when(F.col("v") == 2, F.lit("200 - - 0 -")), F.octet_length(block).cast("string")), F.lit("\n"), block, F.lit("\n"))
    first = F.when(F.col("n").bitwiseAND(F.lit((1 << 33) - 1)) == 0, first).otherwise(F.lit(""))  # the first row of a task
    (rows.select(_join(first, head, "\n", F.col("http"), F.col("body")).cast("string").alias("value"))
     .write.options(**GZIP).option("lineSep", ARC_END).text(out))


def arc_records(name: str, chunks: Iterator[bytes], payload: bool = True) -> Iterator[dict]:
    """The records of one ARC file, in order, as dicts of RECORD's columns."""
    s, fields = Stream(chunks), 0
    while (head := s.line()) is not None:
        if not head.strip():  # between records
            continue
        at = s.place
        part = head.rstrip(b"\r").split(b" ") if not fields else head.rstrip(b"\r").rsplit(b" ", fields - 1)
        if not fields and not head.startswith(b"filedesc://"):
            raise ValueError(f"{name}: no ARC version block")
        if len(part) not in ((fields,) if fields else ARC_FIELDS.values()) or not part[-1].isdigit():
            raise ValueError(f"{name}: no ARC header line before byte {at}: {head[:200]!r}")
        size = int(part[-1])
        block = s.take(size)
        if not fields:
            version = block.split(b" ", 1)[0].strip()
            if not version.isdigit() or int(version) not in ARC_FIELDS:
                raise ValueError(f"{name}: unknown ARC version {version[:20]!r}")
            fields = ARC_FIELDS[int(version)]
            continue
        uri, address, date, kind = (x.decode("utf-8", "replace") for x in part[:4])
        http, body = _http(block)
        digest = base32_sha1(body)
        yield {"record_id": _record_id(f"{name} {at} {uri} {date} {digest}"), "uri": uri, "address": address, "date": date, "kind": kind,
               "page_id": _header(http, PAGE_ID), "http": http, "payload": body if payload else None, "payload_bytes": len(body), "payload_digest": digest,
               "block_digest": base32_sha1(block) if payload else None, "truncated": len(block) < size}


def _http(block: bytes) -> tuple[bytes | None, bytes]:
    """Status line and headers with the empty line after them (None: no HTTP answer), and the body."""
    if not block.startswith(b"HTTP/"):
        return None, block
    found = [(i + len(e), e) for e in (b"\r\n\r\n", b"\n\n") if (i := block.find(e)) >= 0]
    end = min(found)[0] if found else len(block)
    return block[:end], block[end:]


def _header(http: bytes | None, name: str) -> str | None:
    for line in (http or b"").splitlines():
        key, _, value = line.partition(b":")
        if key.strip().lower() == name.lower().encode():
            return value.strip().decode("utf-8", "replace")
    return None


def _record_id(of: str) -> str:
    """A name-based UUID."""
    h = bytearray(hashlib.sha1(of.encode()).digest()[:16])
    h[6], h[8] = h[6] & 0x0F | 0x50, h[8] & 0x3F | 0x80
    x = h.hex()
    return f"<urn:uuid:{x[:8]}-{x[8:12]}-{x[12:16]}-{x[16:20]}-{x[20:]}>"


def _table(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _read(spark: SparkSession, path: str, records, fields: str, payload: bool) -> DataFrame:
    types = {T.StringType(): pa.string(), T.BinaryType(): pa.binary(), T.LongType(): pa.int64(), T.BooleanType(): pa.bool_()}
    kinds = T._parse_datatype_string(fields)
    schema = pa.schema([(f.name, types[f.dataType]) for f in kinds.fields])

    def run(batches):
        held, size = [], 0
        for name, chunks in _files(batches):
            for r in records(name, chunks, payload):
                held.append(r)
                size += len(r["payload"] or b"") + 500
                if size > BATCH_BYTES:
                    yield _table(held, schema)
                    held, size = [], 0
        if held:
            yield _table(held, schema)

    packed, plain = (x.mapInArrow(run, kinds) for x in _lines(spark, path))
    return packed.unionByName(plain)


def read_arc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records of all ARC files below path; payload False: without payloads and block digests."""
    return _read(spark, path, arc_records, RECORD, payload)


# ---- WARC ------------------------------------------------------------------------

def iso_date(date: str | Column) -> Column:
    """ARC's 8 to 14 digits as a WARC date."""
    d = F.rpad(date, 14, "0")
    day = F.concat_ws("-", F.substring(d, 1, 4), F.substring(d, 5, 2), F.substring(d, 7, 2))
    return F.concat(day, F.lit("T"), F.concat_ws(":", F.substring(d, 9, 2), F.substring(d, 11, 2), F.substring(d, 13, 2)), F.lit("Z"))


def responses(records: DataFrame, at_least: int = 0, key_type: str = "long") -> DataFrame:
    """(payload_digest, response_id, response_page): the record that stands for each payload of at least at_least bytes that several hold."""
    rank = F.struct(F.col("page_id").try_cast(key_type).alias("page"), F.col("record_id").alias("id"))
    large = records.where((F.col("payload_bytes") >= at_least) & F.col("http").isNotNull())
    return (large.groupBy("payload_digest").agg(F.max(rank).alias("r"), F.count("*").alias("n")).where("n > 1")
            .select("payload_digest", F.col("r.id").alias("response_id"), F.col("r.page").cast("string").alias("response_page")))


def convert(spark: SparkSession, arc: str, out: str, at_least: int = 0, key_type: str = "long") -> None:
    """Write the records of the ARC files below arc as WARC files below out, one gzip file per task.

    A revisit keeps its HTTP headers, names the response that holds its payload and has that payload's digest.
    """
    slim = saved(read_arc(spark, arc, payload=False).drop("payload", "block_digest"), "arc-records")
    best = saved(responses(slim, at_least, key_type), "responses")
    # records whose payload surely is their own alone are written where they are read
    flagged, shared = with_maybe(read_arc(spark, arc), "payload_digest", best, "shared"), with_maybe(slim, "payload_digest", best, "shared").where("shared")
    alone = flagged.where("not shared").withColumns({"response_id": F.lit(None).cast("string"), "response_page": F.lit(None).cast("string")})
    got = alone.unionByName(spread_join(flagged.where("shared"), best, ["payload_digest"], "record_id", "left", slim=shared))
    revisit = (F.col("response_id") != F.col("record_id")) & (F.col("payload_bytes") >= at_least) & F.col("http").isNotNull()
    kind = F.when(F.col("http").isNull(), "resource").when(revisit, "revisit").otherwise("response")
    rows = got.withColumn("type", kind).withColumn("block", F.concat(F.coalesce("http", F.lit("").cast("binary")), F.when(F.col("type") == "revisit", F.lit("").cast("binary")).otherwise(F.col("payload"))))

    def line(name: str, value) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(LINE_END)), F.lit(""))

    turned = F.col("type") == "revisit"
    head = F.concat(
        F.lit(WARC_VERSION + LINE_END), line("WARC-Type", F.col("type")), line("WARC-Record-ID", F.col("record_id")), line("WARC-Date", iso_date("date")),
        line("WARC-Target-URI", F.when(F.col("uri") != "-", F.col("uri"))), line("WARC-IP-Address", F.when(F.col("address") != "0.0.0.0", F.col("address"))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        line("WARC-Block-Digest", F.when(~turned, F.concat(F.lit("sha1:"), F.col("block_digest")))),
        line(PAYLOAD_LENGTH, F.when(turned, F.col("payload_bytes").cast("string"))),
        line("WARC-Refers-To", F.when(turned, F.col("response_id"))), line("WARC-Profile", F.when(turned, F.lit(REVISIT_PROFILE))),
        line("WARC-Truncated", F.when(F.col("truncated"), F.lit("unspecified"))),
        line("Content-Type", F.when(F.col("http").isNull(), F.col("kind")).otherwise(F.lit("application/http; msgtype=response"))),
        line("Content-Length", F.octet_length("block").cast("string")), F.lit(LINE_END))
    # a file's first record says what it is
    fields = f"software: sitelens{LINE_END}format: WARC File Format 1.0"
    name = F.sha1(F.concat_ws(" ", F.lit(out), F.spark_partition_id().cast("string")).cast("binary"))
    info = F.concat(F.lit(f"{WARC_VERSION}{LINE_END}WARC-Type: warcinfo{LINE_END}WARC-Record-ID: <urn:uuid:"),
                    F.concat_ws("-", F.substring(name, 1, 8), F.substring(name, 9, 4), F.substring(name, 13, 4), F.substring(name, 17, 4), F.substring(name, 21, 12)),
                    F.lit(f">{LINE_END}WARC-Date: "), iso_date(F.lit(DEFAULT_DATE)),
                    F.lit(f"{LINE_END}Content-Type: application/warc-fields{LINE_END}Content-Length: {len(fields)}{WARC_END}{fields}{WARC_END}"))
    first = F.when(F.col("n").bitwiseAND(F.lit((1 << 33) - 1)) == 0, info).otherwise(F.lit(""))
    (rows.withColumn("n", F.monotonically_increasing_id()).select(_join(first, head, F.col("block")).cast("string").alias("value"))
     .write.options(**GZIP).option("lineSep", WARC_END).text(out))


WARC_RECORD = "type string, record_id string, uri string, date string, page_id string, payload binary, payload_bytes long, payload_digest string, refers_to_id string, truncated boolean"


def warc_records(name: str, chunks: Iterator[bytes], payload: bool = True) -> Iterator[dict]:
    """The records of one WARC file but its warcinfo, in order, as dicts of WARC_RECORD's columns.

    A record whose bytes do not have the digests it names is an error.
    """
    s = Stream(chunks)
    while (head := s.line()) is not None:
        if not head.strip():
            continue
        if not head.startswith(b"WARC/"):
            raise ValueError(f"{name}: no WARC record before byte {s.place}: {head[:200]!r}")
        fields = {}
        while (line := s.line()) is not None and line.strip():
            key, _, value = line.partition(b":")
            fields[key.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
        size = int(fields["content-length"])
        block = s.take(size)
        kind = fields.get("warc-type")
        if kind == "warcinfo":
            continue
        http, body = _http(block)
        named, whole = fields.get("warc-payload-digest", "").removeprefix("sha1:"), len(block) == size
        length = int(fields.get(PAYLOAD_LENGTH.lower()) or _header(http, "Content-Length") or 0) if kind == "revisit" else len(body)
        digest = named if kind == "revisit" else base32_sha1(body)
        if kind != "revisit" and whole and named and named != digest:
            raise ValueError(f"{name}: payload of {fields.get('warc-record-id')} does not have its digest")
        yield {"type": kind, "record_id": fields.get("warc-record-id"), "uri": fields.get("warc-target-uri"), "date": fields.get("warc-date"), "page_id": _header(http, PAGE_ID),
               "payload": body if payload and kind != "revisit" else None, "payload_bytes": length, "payload_digest": digest, "refers_to_id": fields.get("warc-refers-to"),
               "truncated": not whole or "warc-truncated" in fields}


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records of all WARC files below path; a revisit has its payload's length and digest, but no payload."""
    return _read(spark, path, warc_records, WARC_RECORD, payload)


def archive_pages(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", at_least: int = 0) -> DataFrame:
    """Pages through ARC files, converted to WARC files and read back.

    Columns: key, payload_bytes, payload_digest, record_type, refers_to (the key of the
    page whose record holds the payload), record_id, uri; one row per row of pages.
    """
    spark = pages.sparkSession
    arc, warc = scratch(spark, "arc"), scratch(spark, "warc")
    kind = pages.schema[key].dataType
    write_arc(pages, arc, key, url, html)
    convert(spark, arc, warc, at_least, kind.simpleString())
    got = saved(read_warc(spark, warc, payload=False).drop("payload"), "warc-records")
    holders = got.where("type = 'response'").select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("holder"))
    back = spread_join(got, holders, ["refers_to_id"], "record_id", "left")
    return back.select(F.col("page_id").cast(kind).alias(key), "payload_bytes", "payload_digest", F.col("type").alias("record_type"),
                       F.col("holder").cast(kind).alias("refers_to"), "record_id", "uri")
