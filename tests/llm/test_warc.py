"""WARC round trip: heads, ranges, revisits, odd rows."""

import hashlib
import zlib

from lendscope.llm.warc import joined, parse, read_records, write_archives

SCHEMA = "page_id long, url string, html string, file string, offset int, digest string"
BIG = "<p>é</p>\r\n\r\nWARC/1.1\r\n\r\n" * 20
ROWS = [(5, "http://a/ü?q=1 2", BIG, "x", 1, "d"), (3, "http://b", BIG, "x", 1, "d"), (9, None, BIG, None, None, None),
        (None, "http://c\r\nX: 1", BIG, "x", 1, "d"), (1, "http://d", "small", "x", 1, "d"),
        (2, "http://d", "small", "x", 1, "d"), (4, "u", None, "x", 1, "d"), (6, "u", "", "x", 1, "d"),
        (3, "http://b", BIG, "x", 1, "d"), (7, "u", "y" * 99, "x", 1, "d"), (8, "u", "y" * 99, "x", 1, "d"),
        (10, "u", "z" * 100, "x", 1, "d"), (11, "u", "z" * 100, "x", 1, "d"), (12, "u", "long " * 400_000, "x", 1, "d"),
        (None, "u", "w" * 200, "x", 1, "d"), (None, "v", "w" * 200, "x", 1, "d")]


def expected():
    out = []
    for i, _, html, *_ in ROWS:
        data = (html or "").encode()
        ids = [r[0] for r in ROWS if (r[2] or "") == (html or "") and r[0] is not None]
        first = min(ids) if ids and len(data) >= 100 else i
        again = first != i
        out.append((i, "revisit" if again else "response", len(data), hashlib.sha256(data).hexdigest(),
                    first if again else None, None if again else html or ""))
    return sorted(out, key=str)


def test_round_trip(spark, tmp_path):
    pages = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    index = write_archives(pages, f"file://{tmp_path}/warc", file_bytes=1000)
    assert len({r.file for r in index.collect()}) > 3
    assert sorted(map(tuple, read_records(index, range_bytes=500).collect()), key=str) == expected()
    some = index.filter("record_type = 'response' and payload_bytes < 100")
    assert read_records(some).count() == 6
    for r in index.collect():                     # every range is one gzip member with one whole record
        with open(r.file.removeprefix("file://"), "rb") as f:
            f.seek(r.offset)
            z = zlib.decompressobj(31)
            raw = z.decompress(f.read(r.length))
        head, payload = parse(raw)
        assert z.eof and not z.unused_data and raw.startswith(b"WARC/1.1\r\n") and raw.endswith(b"\r\n\r\n")
        assert head["warc-payload-digest"] == f"sha256:{r.payload_digest}"
        assert len(payload) == (r.payload_bytes if r.record_type == "response" else 0)


def test_empty(spark, tmp_path):
    pages = spark.createDataFrame([], SCHEMA)
    assert read_records(write_archives(pages, f"file://{tmp_path}/none")).count() == 0


def test_joined_ranges():
    spans = [(0, 10), (10, 5), (100, 10), (5000, 1), (5001, 9)]
    assert joined(spans, gap=100) == [(0, 110, [0, 1, 2]), (5000, 5010, [3, 4])]
    assert joined(spans, gap=0) == [(0, 15, [0, 1]), (100, 110, [2]), (5000, 5010, [3, 4])]
