import hashlib
import io
import struct
from collections import defaultdict

import pytest
import zstandard

from lapsekit.llm import warc

SCHEMA = "page_id long, url string, html string, payload_bytes int"
LONG = "x" * 200 + "é"


def archive(records, dictionary=b"0123456789abcdef", compress_dictionary=False):
    content = zstandard.ZstdCompressor().compress(dictionary) if compress_dictionary else dictionary
    c = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    return struct.pack("<II", warc.DICT_MAGIC, len(content)) + content + b"".join(map(c.compress, records))


def record(payload=b"payload", **kw):
    return warc.record_bytes(1, "http://a/ b", payload, hashlib.sha256(payload).hexdigest(), **kw)


def test_frames_and_dictionary():
    rows = [record(b"ab" * k) for k in (0, 1, 70_000)]
    for packed in (False, True):
        for block in (1, 7, 1 << 16):
            data = io.BytesIO(archive(rows, compress_dictionary=packed))
            assert list(warc.read_records(data, block)) == rows
    frame = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(b"0123456789abcdef"))
    assert frame.decompress(archive(rows[:1])[8 + 16:]) == rows[0]  # one frame a record


def test_records_are_validated():
    good = record()
    assert warc.parse_record(good)["payload"] == b"payload"
    for bad in (good[:-1], good.replace(b"WARC/1.1", b"WARX/1.1"), good.replace(b"payload\r\n\r\n", b"pay1oad\r\n\r\n"),
                good.replace(b"WARC-Date", b"WARC-Type"), good.replace(b"Content-Length: ", b"Content-Length: 9"),
                good.replace(b"WARC-Record-ID", b"X-Other")):
        with pytest.raises(warc.WarcError):
            warc.parse_record(bad)
    data = archive([good])
    for broken in (b"", data[:10], data[:-3], b"\0" * 8 + data, data + b"junk"):
        with pytest.raises(warc.WarcError):
            list(warc.read_records(io.BytesIO(broken)))


def expected(rows):
    groups = defaultdict(list)
    for pid, _, html, _ in rows:
        body = (html or "").encode()
        if len(body) >= 100:
            groups[hashlib.sha256(body).hexdigest()].append(pid)
    out = []
    for pid, _, html, _ in rows:
        body = (html or "").encode()
        d = hashlib.sha256(body).hexdigest()
        ids = [x for x in groups.get(d, []) if x is not None]
        lead = min(ids) if len(groups.get(d, [])) > 1 and ids else None
        refers = lead if lead is not None and lead != pid else None
        out.append((pid, len(body), d, "revisit" if refers is not None else "response", refers))
    return sorted(out, key=repr)


def test_round_trip_with_edges(spark):
    rows = [(3, "http://a", LONG, 1), (1, None, LONG, 1), (2, "http://b/%20 ü\r\nx", LONG, 1), (4, "u", None, 1),
            (5, "u", "", 1), (6, "u", "short", 1), (7, "u", "short", 1), (None, "u", LONG, 1), (8, "u", "y" * 300_000, 1),
            (1, "again", LONG, 1), (None, "u", None, 1), (9, "u", "<a>\r\n\r\nWARC/1.1\r\n" * 30, None)]
    pages = spark.createDataFrame(rows, SCHEMA)
    back = warc.read_archives(warc.write_archives(pages))
    got = back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got), key=repr) == expected(rows)
    urls = {r["page_id"]: r["url"] for r in back.collect() if r["page_id"] in (2, 3, 9)}
    assert urls == {2: "http://b/%20 ü\r\nx", 3: "http://a", 9: "u"}
    assert {bytes(r["payload"]) for r in back.collect() if r["page_id"] == 9} == {rows[-1][2].encode()}


def test_empty_table(spark):
    assert warc.read_archives(warc.write_archives(spark.createDataFrame([], SCHEMA))).collect() == []


def test_large_ids_survive_nulls(spark):
    big = 2**62 + 1
    pages = spark.createDataFrame([(big, "u", LONG, 1), (big + 2, "u", LONG, 1), (None, "u", "a", 1)], SCHEMA).coalesce(1)
    got = {r["page_id"]: r["refers_to"] for r in warc.read_archives(warc.write_archives(pages)).collect()}
    assert got == {big: None, big + 2: big, None: None}
