"""WARC archives, Zstandard form: writer and validating reader.

A file starts with a skippable frame that holds a Zstandard dictionary; after it
comes one frame a record, compressed with that dictionary, so that any record can
be decoded alone. The reader loads the dictionary from that frame, decodes frame by
frame from a stream (memory: one record and one read block), and checks the version
line, the required headers, Content-Length against the block, the record's end and,
for records with a payload, its SHA-256 against WARC-Payload-Digest.

Records of equal payloads of at least ``MIN_REVISIT_BYTES`` are written once, as the
response of the smallest page_id; the others are revisits that refer to it. Equal
rows that repeat that page_id are all responses. Null html is an empty payload, a
null page_id gives the record id ``null`` (read back as null) and never is the one
referred to unless no other row has the payload; then all are responses. Null urls
leave out the target header. An empty table gives no archive and an empty result.

Executors write the files into the shared folder through ``pyarrow.fs`` under a
name that holds a fresh id for each attempt; only the manifest rows of attempts
that Spark committed name files that are read, so that lost or repeated tasks
leave at most a file that nobody reads.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsekit.llm.common import frame, new_path, stored

MIN_REVISIT_BYTES = 100
DICT_MAGIC = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
DICT_BYTES, DICT_SAMPLE_BYTES = 16 << 10, 1 << 20  # of a file's dictionary, and of its first records that train it
FILE_BYTES = 64 << 20  # a file is closed once it has this many
READ_BLOCK = 64 << 10
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"  # the tables name no time of capture
URI_SAFE = "".join(map(chr, range(0x21, 0x7F)))


class WarcError(ValueError):
    """A file, frame or record that breaks the format."""


def open_fs(path: str):
    from pyarrow import fs
    if path.startswith("file:/") and not path.startswith("file://"):  # as Hadoop writes it
        path = path.removeprefix("file:")
    return fs.FileSystem.from_uri(f"file://{path}" if path.startswith("/") else path)


def record_bytes(page_id, url, payload: bytes, digest: str, refers_to=None) -> bytes:
    """One record: a response with the payload, or (with ``refers_to``) a revisit without it."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http if refers_to is not None else http + payload
    head = [("WARC-Type", "response" if refers_to is None else "revisit"),
            ("WARC-Record-ID", f"<urn:page:{'null' if page_id is None else page_id}>"), ("WARC-Date", DATE)]
    if url is not None:
        head.append(("WARC-Target-URI", quote(url, safe=URI_SAFE.replace("%", ""))))
    head.append(("WARC-Payload-Digest", f"sha256:{digest}"))
    head.append(("X-Payload-Length", str(len(payload))))
    if refers_to is not None:
        head += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Headers and payload of one record; raises WarcError where it breaks the format."""
    head, found, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not found or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise WarcError(f"no WARC version line: {lines[0][:40]!r}")
    h: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name or name.lower() in h:
            raise WarcError(f"bad or repeated header: {line[:80]!r}")
        h[name.lower()] = value.strip()
    if missing := {"warc-type", "warc-record-id", "warc-date", "content-length"} - h.keys():
        raise WarcError(f"headers missing: {sorted(missing)}")
    if not h["content-length"].isdigit() or len(rest) != int(h["content-length"]) + 4:
        raise WarcError(f"Content-Length {h['content-length']}, but {len(rest) - 4} bytes before the record's end")
    if not rest.endswith(b"\r\n\r\n"):
        raise WarcError("the record does not end in two line ends")
    block = rest[:-4]
    payload = None
    if h["warc-type"] == "response":
        _, found, payload = block.partition(b"\r\n\r\n")
        if not found:
            raise WarcError("no end of the HTTP headers")
        digest = h.get("warc-payload-digest", "")
        if digest.startswith("sha256:") and digest[7:] != hashlib.sha256(payload).hexdigest():
            raise WarcError("the payload does not fit its digest")
        if "x-payload-length" in h and h["x-payload-length"] != str(len(payload)):
            raise WarcError("the payload does not fit its length")
    elif h["warc-type"] == "revisit" and "warc-refers-to" not in h:
        raise WarcError("a revisit that refers to nothing")
    return {"headers": h, "payload": payload}


def make_dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; where there is too little to train on, the first records as raw content."""
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICT_BYTES].ljust(8, b" ")


class ArchiveWriter:
    """Writes records to one stream; the dictionary comes from the first ones."""

    def __init__(self, sink):
        self.sink, self.pending, self.held, self.bytes, self.records = sink, [], 0, 0, 0
        self.compressor = None

    def write(self, record: bytes) -> None:
        self.records += 1
        if self.compressor is not None:
            self._put(self.compressor.compress(record))
            return
        self.pending.append(record)
        self.held += len(record)
        if self.held >= DICT_SAMPLE_BYTES:
            self._start()

    def _start(self) -> None:
        content = make_dictionary(self.pending)
        self._put(struct.pack("<II", DICT_MAGIC, len(content)) + content)
        self.compressor = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(content),
                                                   write_checksum=True)
        for record in self.pending:
            self._put(self.compressor.compress(record))
        self.pending = []

    def _put(self, data: bytes) -> None:
        self.bytes += len(data)
        self.sink.write(data)

    def close(self) -> None:
        if self.compressor is None:
            self._start()
        self.sink.close()


def read_records(source, block: int = READ_BLOCK) -> Iterator[bytes]:
    """The decoded records of a stream, one frame each."""
    head = source.read(8)
    if len(head) < 8:
        raise WarcError("no dictionary frame")
    magic, size = struct.unpack("<II", head)
    if magic not in SKIPPABLE:
        raise WarcError("the file does not start with a skippable frame")
    content = b""
    while len(content) < size:
        if not (part := source.read(size - len(content))):
            raise WarcError("the dictionary frame is cut off")
        content += part
    if content[:4] == FRAME_MAGIC:  # the dictionary itself may be compressed
        content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
    decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content))
    data = b""
    while data := data or source.read(block):
        frame, parts = decompressor.decompressobj(), []
        while True:
            try:
                parts.append(frame.decompress(data))
            except zstandard.ZstdError as e:
                raise WarcError(f"a frame cannot be decoded: {e}") from e
            if frame.eof:
                data = frame.unused_data
                break
            if not (data := source.read(block)):
                raise WarcError("the last frame is cut off")
        yield b"".join(parts)


def with_leaders(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, html, digest, leader): leader is the page that holds the payload, where it repeats."""
    p = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"),
                     F.coalesce(F.col(html), F.lit("")).alias("html")).withColumn("digest", F.sha2("html", 256))
    # one row a digest and task before the shuffle; stored, so that the join below has two plain exchanges
    leaders = (p.filter(F.octet_length("html") >= MIN_REVISIT_BYTES).groupBy("digest")
               .agg(F.min("page_id").alias("leader"), F.count("*").alias("n")).filter("n > 1").drop("n"))
    return p.join(stored(leaders, "warc-leaders"), "digest", "left")


def write_archives(pages: DataFrame, **columns: str) -> DataFrame:
    """Write all rows of ``pages``; returns the manifest (path, records, bytes), one row a file."""
    folder = new_path(pages.sparkSession, "warc")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = open_fs(folder)
        fs.create_dir(root)
        writer, path = None, ""
        for b in batches:
            for pid, url, html, digest, leader in zip(b.page_id, b.url, b.html, b.digest, b.leader, strict=True):
                if writer is None:
                    path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
                    writer = ArchiveWriter(fs.open_output_stream(f"{root}/{path.rsplit('/', 1)[1]}"))
                pid = None if pd.isna(pid) else int(pid)
                refers = None if pd.isna(leader) or int(leader) == pid else int(leader)
                writer.write(record_bytes(pid, url, html.encode("utf-8"), digest, refers))
                if writer.bytes >= FILE_BYTES:
                    writer.close()
                    yield pd.DataFrame({"path": [path], "records": [writer.records], "bytes": [writer.bytes]})
                    writer = None
        if writer is not None:
            writer.close()
            yield pd.DataFrame({"path": [path], "records": [writer.records], "bytes": [writer.bytes]})

    rows = with_leaders(pages, **columns).select(
        F.col("page_id").cast("decimal(20,0)"), "url", "html", "digest", F.col("leader").cast("decimal(20,0)"))
    return stored(rows.mapInPandas(write, "path string, records long, bytes long"), "warc-manifest")


def read_archives(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of the files that ``manifest`` names: page_id, url, record_type, payload_bytes,
    payload_digest, refers_to and (``with_payload``) payload, null for revisits. A file that breaks
    the format fails the job with its path."""
    schema = ("page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
              "refers_to long" + ", payload binary" * with_payload)
    names = [c.split()[0] for c in schema.split(", ")]

    def page(urn: str | None):
        at = (urn or "").removeprefix("<urn:page:").removesuffix(">")
        return None if at in ("", "null") else int(at)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for path, expected in ((p, n) for b in batches for p, n in zip(b.path, b.records, strict=True)):
            fs, name = open_fs(path)
            n, held, rows = 0, 0, []
            with fs.open_input_stream(name) as source:
                try:
                    for raw in read_records(source):
                        r = parse_record(raw)
                        h, payload = r["headers"], r["payload"]
                        size = int(h["x-payload-length"]) if payload is None else len(payload)
                        row = (page(h["warc-record-id"]), unquote(u) if (u := h.get("warc-target-uri")) is not None
                               else None, h["warc-type"], size, h["warc-payload-digest"].removeprefix("sha256:"),
                               page(h.get("warc-refers-to")))
                        rows.append((*row, payload) if with_payload else row)
                        n, held = n + 1, held + (len(payload or b"") if with_payload else 0)
                        if len(rows) >= 10_000 or held >= 8 << 20:
                            yield frame(rows, names, ("page_id", "refers_to"))
                            rows, held = [], 0
                except WarcError as e:
                    raise WarcError(f"{path}, record {n}: {e}") from e
            if n != expected:
                raise WarcError(f"{path}: {n} records, the manifest has {expected}")
            if rows:
                yield frame(rows, names, ("page_id", "refers_to"))

    spark = manifest.sparkSession
    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return manifest.select("path", "records").repartition(n).mapInPandas(read, schema)

