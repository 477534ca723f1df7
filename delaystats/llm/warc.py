"""WARC archives: whole-file gzip in, one gzip member per record and an index out.

``write_monolithic`` writes a page per record as gzip files that are one stream
from end to end, as a careless crawler leaves them: no record can be read
without inflating all before it.  ``normalise`` inflates each file once,
compresses every record as a member of its own, and writes next to it a sidecar
index with the offset and length of every member.  Both files end in an empty
member, the usual end mark of blocked gzip files.

Records with equal payloads (SHA-1 and length) of at least ``min_bytes`` are
written once: the smallest page id is the response, the others revisit it.

Spark's own text writer and binary-file reader do all file access, so archives
can be in any store Spark reaches; the number of records per file bounds what
a task holds.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaystats.llm.common import written

RECORDS_PER_FILE = 4000
LEVEL = 3                   # compression of the members
_END = b"\r\n\r\n"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def member(data: bytes) -> bytes:
    """One gzip member (no name, no time, so equal data give equal bytes)."""
    c = zlib.compressobj(LEVEL, zlib.DEFLATED, -15)
    body = c.compress(data) + c.flush()
    return (b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\xff" + body
            + zlib.crc32(data).to_bytes(4, "little") + (len(data) & 0xFFFFFFFF).to_bytes(4, "little"))


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """A WARC record without its closing blank lines."""
    block = _HTTP if revisit else _HTTP + payload
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    name = "null" if page_id is None else page_id
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
             f"WARC-Record-ID: <urn:page:{name}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}",
              "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + _END + block


def _record_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            rows = batch.slice(at, 500).to_pylist()
            yield pa.record_batch({"record": pa.array(
                [record(r["page_id"], r["url"], (r["html"] or "").encode("utf-8", "surrogatepass"),
                        r["first"], r["revisit"]) for r in rows], pa.binary())})


def write_monolithic(pages: DataFrame, path: str, min_bytes: int = 0) -> str:
    """Write a WARC record per page as whole-file gzip streams.

    Null html is an empty payload; null urls have no target line; a null page
    id is written as null and is a response unless a page with an id has the
    same payload.  Rows that repeat the smallest page id of their payload are
    all responses.  Other columns are left out; an empty table writes no record.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = rows.withColumns({"sha": F.sha1(payload), "size": F.octet_length(payload)})
    repeated = written(rows.where(F.col("size") >= min_bytes).groupBy("sha", "size")
                       .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
                       .where("n > 1 and first is not null").drop("n"), "repeated")
    (rows.join(repeated, ["sha", "size"], "left")
     .select("page_id", "url", "html", "first",
             (F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))).alias("revisit"))
     .mapInArrow(_record_rows, "record binary").select(F.col("record").cast("string"))
     .write.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
     .option("lineSep", _END.decode()).option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))
    return path


def records(stream: Iterator[bytes]) -> Iterator[bytes]:
    """The records of an inflated archive, without their closing blank lines."""
    held = bytearray()
    for data in stream:
        held += data
        while True:
            while held[:4] == _END:
                del held[:4]
            head = held.find(_END)
            if head < 0:
                break
            headers = parse_headers(bytes(held[:head]))
            end = head + 4 + int(headers["content-length"])
            if len(held) < end + 4:
                break
            yield bytes(held[:end])
            del held[:end + 4]
    if held.strip():
        raise ValueError("archive ends inside a record")


def parse_headers(head: bytes) -> dict[str, str]:
    out = {}
    for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def inflate(content: bytes, step: int = 1 << 18) -> Iterator[bytes]:
    """A gzip stream of one member or many, inflated in pieces, read once."""
    d = zlib.decompressobj(31)
    view, at = memoryview(content), 0
    while at < len(content) or d.unused_data:
        if d.eof:
            left = d.unused_data
            d = zlib.decompressobj(31)
            data = left
        else:
            data = view[at:at + step]
            at += step
        if data:
            yield d.decompress(data)
    if not d.eof and len(content):
        raise ValueError("truncated gzip stream")


def _normalised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            name = path.rsplit("/", 1)[-1].split(".")[0]
            members, index, offset = [], ["offset length record_id"], 0
            for r in records(inflate(content)):
                m = member(r + _END)
                index.append(f"{offset} {len(m)} {parse_headers(r[:r.find(_END)])['warc-record-id']}")
                members.append(m)
                offset += len(m)
            yield pa.record_batch({
                "archive": pa.array([name, name]), "kind": pa.array(["warc", "index"]),
                "value": pa.array([b"".join(members), member(("\n".join(index) + "\n").encode())], pa.binary())})


def normalise(spark: SparkSession, source: str, path: str) -> str:
    """Rewrite whole-file gzip archives of a folder below ``path``, as
    archive=NAME/kind=warc and archive=NAME/kind=index, in one job."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source)
             .select("path", "content"))
    (files.mapInArrow(_normalised, "archive string, kind string, value binary")
     .withColumn("value", F.col("value").cast("string"))
     .write.partitionBy("archive", "kind").option("encoding", "ISO-8859-1")
     .option("lineSep", member(b"").decode("latin-1")).text(path))
    return path


def _field_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.int64())])
    page = lambda x: None if x is None or x == "<urn:page:null>" else int(x[10:-1])
    for batch in batches:
        for content in batch.column(0).to_pylist():
            rows = []
            for r in records(inflate(content)):
                head = r.find(_END)
                h = parse_headers(r[:head])
                revisit = h["warc-type"] == "revisit"
                body = r[head + 4:]
                payload = None if revisit else body[body.find(_END) + 4:]
                digest = h["warc-payload-digest"].partition(":")[2]
                if payload is not None and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                    raise ValueError(f"payload of {h['warc-record-id']} does not match its digest")
                rows.append({"page_id": page(h["warc-record-id"]), "url": h.get("warc-target-uri"),
                             "payload": payload, "payload_digest": digest, "record_type": h["warc-type"],
                             "payload_bytes": int(h["x-payload-length"]) if revisit else len(payload),
                             "refers_to": page(h.get("warc-refers-to"))})
                if len(rows) == 500:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Every record of normalised archives; digests are checked on the way."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
             .where(F.col("path").contains("/kind=warc/")).select("content"))
    out = files.mapInArrow(_field_rows, "page_id long, url string, payload binary, payload_bytes long, "
                           "payload_digest string, record_type string, refers_to long")
    return out if payloads else out.drop("payload")


def read_member(archive: bytes, offset: int, length: int) -> bytes:
    """One record by its place in the index, without reading the rest."""
    return zlib.decompress(archive[offset:offset + length], 31)[:-4]
