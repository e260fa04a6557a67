"""WARC archives in seekable Zstandard bundles.

Records that follow each other are grouped into independent frames of about `frame_bytes`
of plain text, so small pages are compressed together; a longer record ends its frame.  A
bundle holds frames of about `bundle_bytes` and ends in a seek table in a skippable frame.
An index maps record ids to (bundle, frame, offset in the decompressed frame), so a record
is read by decompressing one frame.

Of records with equal payloads of at least `min_bytes`, the one with the smallest id is the
response; the others are revisits that refer to it and carry no payload.  Equal payloads
are found by SHA-256 in a narrow aggregation, whose groups that have copies are a table.  Up to
MAX_BROADCAST of them are broadcast, and pages don't shuffle; more are joined with the pages by (digest, salt), so
one payload on a third of all pages is spread over SALTS tasks.  Bundles are rows of a table that Spark commits in the shared folder: a lost
executor's bundles are written again and no reader sees a partial one.

Defined cases: a null payload is empty; an empty or short one is always a response; pages
that share an id each get a record, and the copies of one text with one id are all
responses; a null url is written as an empty target; a very long payload is one record of
a frame that it ends, held whole by its task; an empty table gives no bundle; further columns
of pages are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import scratch, written
from . import textbatch as tb
from .runtime import prepare

BUNDLE_BYTES = 4 << 20
FRAME_BYTES = 64 << 10
MIN_BYTES = 100
SALTS = 32
MAX_BROADCAST = 1 << 18  # groups of copies, some 150 bytes each in a hash table
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
DATE = "2024-01-01T00:00:00Z"


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to: int | None, is_revisit: bool) -> bytes:
    """A WARC/1.1 record; its block is an HTTP response, for a revisit only the head of it."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if is_revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {''.join((url or '').splitlines())}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Page-ID: {'' if page_id is None else page_id}",
        f"X-Payload-Bytes: {len(payload)}",
    ]
    if is_revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page: {refers_to}"]
    block = http if is_revisit else http + payload
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """(headers, payload, where the next one begins) of the record that begins at a byte."""
    end = raw.index(b"\r\n\r\n", at)
    lines = raw[at:end].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    stop = end + 4 + int(headers["Content-Length"])
    return headers, raw[raw.index(b"\r\n\r\n", end + 4) + 4 : stop], stop + 4


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    """The skippable frame of (compressed, decompressed) frame sizes that ends a seekable file."""
    body = b"".join(struct.pack("<II", *x) for x in sizes) + struct.pack("<IBI", len(sizes), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def frames(bundle: bytes) -> list[tuple[int, int, int]]:
    """(start, compressed size, decompressed size) of each frame, from the footer alone."""
    n, flags, magic = struct.unpack("<IBI", bundle[-9:])
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    width = 12 if flags & 0x80 else 8
    at, out = len(bundle) - 9 - n * width, []
    start = 0
    for i in range(n):
        packed, plain = struct.unpack_from("<II", bundle, at + i * width)
        out.append((start, packed, plain))
        start += packed
    return out


def read_frame(bundle: bytes, n: int) -> bytes:
    start, packed, plain = frames(bundle)[n]
    return zstandard.ZstdDecompressor().decompress(bundle[start : start + packed], max_output_size=max(plain, 1))


def plan_records(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """page_id, url, html, digest, first: the page that a revisit refers to, null for responses."""
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    p = p.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    copies = (
        p.where((F.octet_length("html") >= min_bytes) & F.col("page_id").isNotNull())
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.max("page_id").alias("other"))
        .where(F.col("first") < F.col("other"))
        .select("digest", "first")
    )
    groups, _ = written(copies, "copies")
    if groups.count() <= MAX_BROADCAST:
        joined = p.join(F.broadcast(groups), "digest", "left")
    else:
        spread = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = p.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int")).join(spread, ["digest", "salt"], "left")
    return joined.select("page_id", "url", "html", "digest", F.when(F.col("page_id") > F.col("first"), F.col("first")).alias("first"))


def bundles(pages: DataFrame, bundle_bytes: int = BUNDLE_BYTES, frame_bytes: int = FRAME_BYTES, min_bytes: int = MIN_BYTES, level: int = 3) -> DataFrame:
    """Rows (bundle, data, index): the bundle's name, its bytes, and array of (page_id, frame, offset)."""
    prepare(pages.sparkSession)

    def write(batches):
        squeeze = zstandard.ZstdCompressor(level=level, write_content_size=True)
        parts, sizes, index, plain, raw = [], [], [], [], 0  # frames, their sizes, places; records and bytes of the open frame

        def close_frame():
            nonlocal plain, raw
            if plain:
                parts.append(squeeze.compress(b"".join(plain)))
                sizes.append((len(parts[-1]), raw))
                plain, raw = [], 0

        def done():
            data = b"".join(parts) + seek_table(sizes)
            name = hashlib.sha256(data).hexdigest()[:24]
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([data], pa.binary()), pa.array([index], _INDEX)], names=["bundle", "data", "index"])

        for b in batches:
            for page_id, url, html, digest, first in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "html", "digest", "first")), strict=True):
                rec = record(page_id, url, html.encode(), digest, first, first is not None)
                index.append({"page_id": page_id, "frame": len(sizes), "offset": raw})
                plain.append(rec)
                raw += len(rec)
                if raw >= frame_bytes:
                    close_frame()
                    if sum(n for _, n in sizes) >= bundle_bytes:
                        yield done()
                        parts, sizes, index = [], [], []
        close_frame()
        if sizes:
            yield done()

    return plan_records(pages, min_bytes).mapInArrow(tb.task(write), "bundle string, data binary, index array<struct<page_id:long,frame:int,offset:int>>")


_INDEX = pa.list_(pa.struct([("page_id", pa.int64()), ("frame", pa.int32()), ("offset", pa.int32())]))


def write_archive(pages: DataFrame, path: str, **options) -> None:
    """The bundles as a table at path, on any file system that Spark writes to."""
    bundles(pages, **options).write.mode("overwrite").option("compression", "none").parquet(path)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to of every record, by seek table and index, checked against its digest."""
    prepare(spark)

    def read(batches):
        for b in batches:
            for data, index in zip(b.column("data").to_pylist(), b.column("index").to_pylist(), strict=True):
                for n, places in groupby(index, key=lambda i: i["frame"]):
                    yield pa.RecordBatch.from_pylist(list(_described(read_frame(data, n), list(places))), schema=_READ)

    return spark.read.parquet(path).select("data", "index").mapInArrow(tb.task(read), "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long")


_READ = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])


def _described(raw: bytes, places: list[dict]) -> Iterator[dict]:
    """What is read of the records of a frame, at their places by the index."""
    stop = 0
    for place in places:
        if place["offset"] != stop:
            raise ValueError(f"the index of page {place['page_id']} leads to no record")
        h, payload, stop = parse(raw, place["offset"])
        digest, n, kind = h["WARC-Payload-Digest"].removeprefix("sha256:"), int(h["X-Payload-Bytes"]), h["WARC-Type"]
        if kind == "response" and (len(payload) != n or hashlib.sha256(payload).hexdigest() != digest):
            raise ValueError(f"payload of {h['WARC-Record-ID']} doesn't match its digest")
        page, first = (int(h[k]) if h.get(k) else None for k in ("X-Page-ID", "X-Refers-To-Page"))
        if page != place["page_id"]:
            raise ValueError(f"the index leads from page {place['page_id']} to {page}")
        yield {"page_id": page, "url": h["WARC-Target-URI"], "payload_bytes": n, "payload_digest": digest, "record_type": kind, "refers_to": first}
    if stop != len(raw):
        raise ValueError("the index lacks records of a frame")


def lookup(spark: SparkSession, path: str, page_ids: list[int]) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(page_id, headers, payload) of a few records, each by decompressing its own frame."""
    wanted = spark.createDataFrame([(i,) for i in page_ids], "page_id long")
    at = spark.read.parquet(path).select("bundle", F.explode("index").alias("i")).select("bundle", "i.*").join(F.broadcast(wanted), "page_id")
    for r in at.join(spark.read.parquet(path).select("bundle", "data"), "bundle").collect():
        headers, payload, _ = parse(read_frame(bytes(r.data), r.frame), r.offset)
        yield r.page_id, headers, payload


def export(spark: SparkSession, path: str, folder: str) -> None:
    """The bundles as .warc.zst files in a folder of any file system that pyarrow knows; each appears whole or not at all."""

    def put(rows):
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        for r in rows:
            part = f"{root}/.{r.bundle}-{uuid.uuid4().hex}"
            with store.open_output_stream(part) as out:
                out.write(r.data)
            store.move(part, f"{root}/{r.bundle}.warc.zst")

    spark.read.parquet(path).select("bundle", "data").foreachPartition(put)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write pages to an archive in the shared folder and read it back."""
    path = scratch(pages.sparkSession, "warc")
    write_archive(pages, path)
    return read_archive(pages.sparkSession, path)
