"""Web archives against brute force, hand-made ARC files and odd rows."""

import base64
import gzip
import hashlib

import pytest

from sitelens.llm import warc

PAGES = "page_id long, url string, html string, payload string, record_type long"
ODD = [
    (1, "http://a.example/1", "<p>one</p>", "x", 1), (2, "http://a.example/2", "<p>one</p>", None, 2), (2, "http://a.example/2", "<p>one</p>", None, 2),
    (3, None, None, None, None), (4, "", "", "", 0), (None, "http://a.example/none", "<p>one</p>", "", 0), (None, None, None, None, None),
    (5, "http://a.example/with space\nand line", "WARC/1.0\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n\r\n\r\n", "", 0),
    (6, "http://a.example/arc", "http://b.example 1.2.3.4 20200101000000 text/html 5\nhello\n\n\nHTTP/1.1 200 OK\n\nmore", "", 0),
    (-7, "é://ü", "é" * 70000 + "\n" * 500 + "\r\r\n", "", 0), (8, "http://a.example/8", "\n", "", 0), (9, "http://a.example/9", "\r\n\r\n", "", 0),
    (10, "http://a.example/10", "x" * 3_000_000, "", 0),
]


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def expected(rows, at_least=0):
    """(page_id, bytes, digest, type, refers_to) of every row; of rows with the same largest id one is the response."""
    out, groups = [], {}
    for key, html in rows:
        groups.setdefault(html or "", []).append(key)
    for html, keys in groups.items():
        n, top = len(html.encode()), max(keys, key=lambda k: (k is not None, k or 0))
        keys = sorted(keys, key=lambda k: k != top)
        for i, k in enumerate(keys):
            again = n >= at_least and i > 0
            out.append((k, n, digest(html), "revisit" if again else "response", top if again else None))
    return out


def order(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("at_least", [0, 5])
def test_round_trip_of_odd_pages(spark, at_least):
    df = spark.createDataFrame(ODD, PAGES).repartition(3)
    got = warc.archive_pages(df, at_least=at_least).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert order(map(tuple, got.collect())) == order(expected([(r[0], r[2]) for r in ODD], at_least))


def test_hot_payload(spark):
    df = spark.range(900).selectExpr("id AS page_id", "concat('http://x/', id) AS url", "CASE WHEN id % 3 = 0 THEN 'same' ELSE cast(id AS string) END AS html")
    got = warc.archive_pages(df).collect()
    assert len(got) == 900 and sum(r.record_type == "revisit" for r in got) == 299
    assert {r.refers_to for r in got if r.record_type == "revisit"} == {897}


def test_no_pages(spark):
    got = warc.archive_pages(spark.createDataFrame([], PAGES))
    assert got.count() == 0 and got.schema["page_id"].dataType.simpleString() == "bigint"


def arc(version, records, end=b"\n"):
    """An ARC file of (url, date, type, block) records."""
    extra = b" 200 - - 0 -" if version == 2 else b""
    block = b"%d 0 test\n%s\n" % (version, warc.ARC_COLUMNS[version].encode())
    out = b"filedesc://t.arc 0.0.0.0 19960923142103 text/plain%s %d\n%s\n" % (extra, len(block), block)
    for url, date, kind, body in records:
        out += b"%s 1.2.3.4 %s %s%s %d\n%s" % (url, date, kind, extra, len(body), body) + end
    return out


LATIN = b"HTTP/1.0 200 OK\nContent-Type: text/html\n\n<p>\xe9\xff\x00</p>\nhttp://not.a/record 1.1.1.1 19960101000000 text/html 4\nabcd\n"
RECORDS = [(b"http://a/with a space", b"19960923142103", b"text/html", LATIN), (b"dns:a", b"199609231421", b"text/dns", b"19960923\na 1 IN A 1.2.3.4\n"),
           (b"http://b/", b"19960923", b"text/html", LATIN), (b"http://c/", b"19960923142103", b"text/html", b"")]


@pytest.mark.parametrize("version", [1, 2])
@pytest.mark.parametrize("packed", [False, True])
def test_conversion_of_legacy_files(spark, tmp_path, version, packed):
    (tmp_path / "in").mkdir()
    raw = arc(version, RECORDS)
    name = tmp_path / "in" / ("t.arc.gz" if packed else "t.arc")
    name.write_bytes(gzip.compress(raw[:300]) + gzip.compress(raw[300:]) if packed else raw)
    warc.convert(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    rows = {r.uri: r for r in warc.read_warc(spark, str(tmp_path / "out")).collect()}
    assert set(rows) == {"http://a/with a space", "dns:a", "http://b/", "http://c/"}
    body = LATIN[LATIN.index(b"\n\n") + 2:]
    same = [rows["http://a/with a space"], rows["http://b/"]]
    assert sorted(r.type for r in same) == ["response", "revisit"] and {r.payload_bytes for r in same} == {len(body)}
    keeper, again = sorted(same, key=lambda r: r.type)
    assert bytes(keeper.payload) == body and again.payload is None and again.refers_to_id == keeper.record_id
    assert {r.payload_digest for r in same} == {base64.b32encode(hashlib.sha1(body).digest()).decode()}
    assert rows["dns:a"].type == "resource" and rows["dns:a"].date == "1996-09-23T14:21:00Z" and rows["http://b/"].date == "1996-09-23T00:00:00Z"
    assert len({r.record_id for r in rows.values()}) == 4


def test_warc_files_are_well_formed(spark, tmp_path):
    df = spark.createDataFrame(ODD, PAGES).coalesce(1)
    warc.write_arc(df, str(tmp_path / "arc"), version=1)
    warc.convert(spark, str(tmp_path / "arc"), str(tmp_path / "warc"))
    seen = 0
    for f in (tmp_path / "warc").glob("*.gz"):
        raw, at = gzip.decompress(f.read_bytes()), 0
        first = True
        while at < len(raw):
            end = raw.index(b"\r\n\r\n", at)
            head = dict(x.split(b": ", 1) for x in raw[at:end].split(b"\r\n")[1:])
            assert raw.startswith(b"WARC/1.0\r\n", at) and (head[b"WARC-Type"] == b"warcinfo") == first
            n = int(head[b"Content-Length"])
            block = raw[end + 4: end + 4 + n]
            if b"WARC-Block-Digest" in head:
                assert head[b"WARC-Block-Digest"] == b"sha1:" + base64.b32encode(hashlib.sha1(block).digest())
            assert raw[end + 4 + n: end + 8 + n] == b"\r\n\r\n"
            at, first, seen = end + 8 + n, False, seen + (not first)
    assert seen == len(ODD)


@pytest.mark.parametrize("raw", [b"no version block\n", b"filedesc://t 0.0.0.0 19960923142103 text/plain 9\n9 0 test\n\n", arc(1, [(b"http://a/", b"1", b"t", b"x")]) + b"not a header\n"])
def test_wrong_files_are_errors(raw):
    with pytest.raises(ValueError):
        list(warc.arc_records("t.arc", iter([raw])))


def test_cut_off_record_and_any_chunking():
    raw = arc(1, RECORDS)[:-60]
    whole = list(warc.arc_records("t.arc", iter([raw])))
    assert whole[-1]["truncated"] and not whole[0]["truncated"]
    for n in (1, 7, 64):
        assert list(warc.arc_records("t.arc", (raw[i: i + n] for i in range(0, len(raw), n)))) == whole
