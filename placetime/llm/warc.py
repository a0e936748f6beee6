"""WARC archives compressed with an embedded Zstandard dictionary.

Method: pages are dealt to archives by a hash; each archive trains a
dictionary on an evenly spaced part of its own records, writes it in a leading
skippable frame, and compresses every record as a frame of its own with it.
Of equal payloads the one with the smallest page_id is stored as a response
and the others as revisits.

Equal payloads are found by an aggregation over SHA-256 digests with map-side
combine.  The html is shuffled once, to its archive; an archive gets only the
digests that occur in it, at most one row each, so a payload shared by a third
of all pages adds one row per archive.  A task writes to a name of its own
attempt and renames it, so a retried or speculative task leaves one file.

Defined results: null html is an empty payload; payloads under ``MIN_BYTES``
are always responses; null page_ids never become the smallest id unless all
copies have none, then all are responses; rows that repeat the smallest
page_id are all responses; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import uuid

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch_dir, stored, table, total_chars

MIN_BYTES = 100
ARCHIVE_BYTES = 24 << 20
DICT_BYTES = 32 << 10
SAMPLE_BYTES = 2 << 20
SKIPPABLE = 0x184D2A5D
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
MANIFEST = "archive long, path string, records long, bytes long"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"


def _uri(path: str) -> str:
    return re.sub(r"^file:/+", "file:///", path) if "://" in path or path.startswith("file:") else f"file://{path}"


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC/1.1 record; a revisit carries no payload."""
    block = HTTP_HEAD + payload if refers_to is None else HTTP_HEAD
    head = [b"WARC/1.1", b"WARC-Type: " + (b"response" if refers_to is None else b"revisit")]
    if page_id is not None:
        head.append(b"WARC-Record-ID: <urn:page:%d>" % page_id)
    if url is not None:
        head.append(b"WARC-Target-URI: " + re.sub(r"[\r\n]+", " ", url).encode())
    head.append(b"WARC-Payload-Digest: sha256:" + digest.encode())
    head.append(b"X-Payload-Length: %d" % len(payload))
    if refers_to is not None:
        head += [b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 b"WARC-Refers-To: <urn:page:%d>" % refers_to]
    head += [b"Content-Type: application/http;msgtype=response", b"Content-Length: %d" % len(block)]
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


def dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Trained on evenly spaced records of at most SAMPLE_BYTES; raw content
    where they are too few or too alike to train on."""
    total = sum(map(len, records))
    step = max(1, -(-total // SAMPLE_BYTES))
    sample = [r[:SAMPLE_BYTES] for r in records[::step]]
    try:
        return zstandard.train_dictionary(min(DICT_BYTES, max(256, total // 4)), sample)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(sample)[-DICT_BYTES:], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def pack_archive(records: list[bytes]) -> bytes:
    known = dictionary(records)
    raw = known.as_bytes()
    compress = zstandard.ZstdCompressor(level=3, dict_data=known).compress
    return b"".join([struct.pack("<II", SKIPPABLE, len(raw)), raw, *map(compress, records)])


def unpack_archive(data: bytes):
    """Yield (headers, block) of every record of an archive, in order."""
    magic, size = struct.unpack_from("<II", data)
    if magic != SKIPPABLE:
        raise ValueError("the archive does not begin with a dictionary frame")
    raw = data[8 : 8 + size]
    kind = zstandard.DICT_TYPE_FULLDICT if raw[:4] == b"\x37\xa4\x30\xec" else zstandard.DICT_TYPE_RAWCONTENT
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw, dict_type=kind)).stream_reader(
        io.BytesIO(data[8 + size :]), read_across_frames=True)
    stream = io.BufferedReader(reader, 1 << 20)
    while line := stream.readline():
        if line != b"WARC/1.1\r\n":
            raise ValueError("a record does not begin with its version line")
        headers = {}
        while (line := stream.readline()) != b"\r\n":
            key, _, value = line.partition(b": ")
            headers[key] = value[:-2]
        block = stream.read(int(headers[b"Content-Length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record does not end as it should")
        yield headers, block


def _write(folder: str, archive: int, pages: pa.Table, firsts: pa.Table) -> pa.Table:
    first = dict(zip(firsts["equal"].to_pylist(), firsts["first_id"].to_pylist(), strict=True))
    rows, order = [], pages.sort_by([("page_id", "ascending")])
    for batch in order.to_batches(max_chunksize=1024):
        for page_id, url, html, digest in zip(*[batch[c].to_pylist() for c in ("page_id", "url", "html", "digest")], strict=True):
            of = first.get(digest)
            rows.append(record(page_id, url, html.encode(), digest, None if of is None or of == page_id else of))
    data = pack_archive(rows)
    fs, base = pyarrow.fs.FileSystem.from_uri(folder)
    name = f"{base}/part-{archive:06d}.warc.zst"
    with fs.open_output_stream(own := f"{name}.{uuid.uuid4().hex}.tmp") as out:
        out.write(data)
    fs.move(own, name)
    return pa.table({"archive": [archive], "path": [name], "records": [len(rows)], "bytes": [len(data)]},
                    schema=pa.schema([("archive", pa.int64()), ("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))


def write(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Write the archives of ``pages`` (page_id, url, html) to ``folder``; returns their manifest."""
    uri = _uri(folder)
    fs, base = pyarrow.fs.FileSystem.from_uri(uri)
    fs.create_dir(base, recursive=True)
    n = -(-total_chars(pages, "html") // archive_bytes)
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha2("html", 256))
    rows = rows.withColumn("archive", F.pmod(F.xxhash64("page_id", "url", "digest"), F.lit(n)))
    ids = rows.where(F.octet_length("html") >= min_bytes).select(
        F.col("digest").alias("equal"), F.col("page_id").alias("id"), F.col("archive").alias("at"))
    firsts = ids.groupBy("equal").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    firsts = firsts.where("n > 1 and first_id is not null").select(F.col("equal").alias("of"), "first_id")
    entries = ids.select("at", "equal").distinct().join(firsts, F.col("equal") == F.col("of")).select("at", "equal", "first_id")

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        return _write(uri, key[0].as_py(), left, right)

    return rows.groupBy("archive").cogroup(entries.groupBy("at")).applyInArrow(
        lambda key, left, right: run(key, left, right) if left.num_rows else _nothing(), MANIFEST)


def _nothing() -> pa.Table:
    return pa.table({"archive": pa.array([], pa.int64()), "path": pa.array([], pa.string()),
                     "records": pa.array([], pa.int64()), "bytes": pa.array([], pa.int64())})


def _rows(headers: dict, block: bytes, with_payload: bool):
    def number(key):
        return int(headers[key][10:-1]) if key in headers else None

    kind = headers[b"WARC-Type"].decode()
    payload = block[len(HTTP_HEAD) :] if kind == "response" else None
    stated = headers[b"WARC-Payload-Digest"].decode().removeprefix("sha256:")
    digest = hashlib.sha256(payload).hexdigest() if payload is not None else stated
    if digest != stated:
        raise ValueError(f"payload of {headers.get(b'WARC-Record-ID')} does not match its digest")
    size = len(payload) if payload is not None else int(headers[b"X-Payload-Length"])
    url = headers[b"WARC-Target-URI"].decode() if b"WARC-Target-URI" in headers else None
    return number(b"WARC-Record-ID"), size, digest, kind, number(b"WARC-Refers-To"), url, payload if with_payload else None


def read(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """The records of all archives in ``folder``; a response's digest is computed from what was read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder).select("content")
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]

    def parse(batches):
        for batch in batches:
            for data in batch["content"]:
                rows, held = [], 0
                for headers, block in unpack_archive(data.as_py()):
                    rows.append(_rows(headers, block, with_payload))
                    held += len(block) if with_payload else 100
                    if held > 4 << 20:
                        yield _batch(rows)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows)

    def _batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return files.mapInArrow(parse, RECORDS)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "warc")
    stored(spark, write(table(spark, sf_dir, "pages"), folder), "warc-manifest")
    return read(spark, folder, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
f AS (SELECT payload_digest AS digest, min(page_id) AS first_id FROM d WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first_id IS NULL OR first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first_id IS NULL OR first_id = page_id THEN NULL ELSE first_id END AS refers_to
FROM d LEFT JOIN f ON digest = payload_digest
"""
