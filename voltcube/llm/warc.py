"""Operator 9: WARC archives, written from a table of pages and read back.

Writing: every page becomes a response record, or a revisit record where an earlier
page has the same payload (WARC-Refers-To names it). The payload is an HTTP message
with chunked transfer framing. A block longer than ``segment_bytes`` is cut into
segments: the first keeps the record's type, the rest are continuation records with
WARC-Segment-Origin-ID, WARC-Segment-Number and, on the last, the total length.
Archives are plain files of records: Spark's text sink ends each record with the
two line ends that close it; they are gzipped.

Reading: files are parsed by their Content-Length fields, never by searching for a
separator. Segments are grouped by origin, ordered by number and their total
length is verified; then the chunked framing is decoded and the payload's digest is
compared with the one declared.

Defined results: a null payload is empty; a page without an id is a response of its
own and takes no part in finding revisits; rows repeating a page_id with the same
payload are all responses if they hold the smallest id; an empty table gives an
empty result. Extra columns of the pages are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltcube.llm.common import cut, drop_path, small_batches
from voltcube.session import scratch_path

SEGMENT_BYTES, CHUNK_BYTES = 32 << 10, 8 << 10
#: Records of one archive file: with segments of 32 KiB at most 64 MiB before compression.
FILE_RECORDS = 2000
DATE = "2024-01-01T00:00:00Z"
END = b"\r\n\r\n"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int) -> bytes:
    out = [b"%x\r\n%b\r\n" % (len(payload[i:i + size]), payload[i:i + size]) for i in range(0, len(payload), size)]
    return b"".join([*out, b"0\r\n\r\n"])


def dechunked(body: bytes) -> bytes:
    """The payload of a chunked message body; ValueError where the framing is broken."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        n = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if not n:
            return b"".join(out)
        if body[at + n:at + n + 2] != b"\r\n":
            raise ValueError("broken chunk")
        out.append(body[at:at + n])
        at += n + 2


def record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """One record without the two line ends that close it."""
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", len(block))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block


def uri(number: int, kind: str, page: object) -> str:
    return f"<urn:warc:{kind}:{page if page is not None else 'none'}:{number}>"


def page_records(number: int, page: int | None, url: str | None, payload: bytes, refers_to: int | None, segment: int) -> list[bytes]:
    revisit = refers_to is not None and refers_to != page
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    block = head if revisit else head + chunked(payload, CHUNK_BYTES)
    rid = uri(number, "page", page)
    target = "".join(c for c in (url or "") if c >= " ")
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", rid), ("WARC-Date", DATE), ("WARC-Target-URI", target),
              ("WARC-Page-ID", "" if page is None else page), ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"),
              ("WARC-Payload-Length", len(payload)), ("Content-Type", "application/http; msgtype=response")]
    if revisit:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To-Page", refers_to)]
    if len(block) <= segment:
        return [record(fields, block)]
    out = [record([*fields, ("WARC-Segment-Number", 1)], block[:segment])]
    for n, i in enumerate(range(segment, len(block), segment), 2):
        more = [("WARC-Segment-Total-Length", len(block))] if i + segment >= len(block) else []
        out.append(record([("WARC-Type", "continuation"), ("WARC-Record-ID", uri(number, f"segment-{n}", page)), ("WARC-Date", DATE),
                           ("WARC-Segment-Origin-ID", rid), ("WARC-Segment-Number", n), *more], block[i:i + segment]))
    return out


def write_archives(pages: DataFrame, path: str, *, page_id: str = "page_id", url: str = "url", payload: str = "html",
                   least: int = 0, segment_bytes: int = SEGMENT_BYTES) -> None:
    """Archives of ``pages`` in the folder ``path``. Payloads under ``least`` bytes are never revisits."""
    spark = pages.sparkSession
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                        F.coalesce(F.col(payload), F.lit("")).alias("payload"))
    # The digest that finds revisits; the payload itself is not part of this shuffle.
    first = (rows.filter((F.octet_length("payload") >= least) & F.col("page_id").isNotNull()).groupBy(F.sha1(F.col("payload").cast("binary")).alias("sha"))
                 .agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1").drop("n"))
    first, first_path = cut(spark, first, "warc-first")
    key = F.when(F.col("page_id").isNotNull(), F.sha1(F.col("payload").cast("binary")))
    rows = rows.withColumn("key", key).join(first, F.col("key") == F.col("sha"), "left").select("page_id", "url", "payload", "refers_to")

    def encode(batches):
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 40
        for b in small_batches(batches, "payload"):
            out = []
            for page, u, p, first in zip(*(c.to_pylist() for c in b.columns), strict=True):
                out += page_records(number, page, u, p.encode("utf-8", "surrogatepass"), first, segment_bytes)
                number += 1
            yield pa.record_batch({"record": pa.array(out, pa.binary())})

    (rows.mapInArrow(encode, "record binary").select(F.col("record").cast("string").alias("value"))
         .write.option("lineSep", END.decode()).option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(path))
    drop_path(spark, first_path)


def parse(data: bytes):
    """(fields, block) of each record in an archive's bytes."""
    if data[:2] == b"\x1f\x8b":
        out, rest = [], data
        while rest:                      # one or more gzip members
            d = zlib.decompressobj(31)
            out.append(d.decompress(rest) + d.flush())
            rest = d.unused_data
        data = b"".join(out)
    at = 0
    while at < len(data):
        end = data.index(END, at)
        lines = data[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("no WARC record")
        fields = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines[1:])}
        n = int(fields["content-length"])
        yield fields, data[end + 4:end + 4 + n]
        at = end + 4 + n + 4


RECORD = ("page_id long, url string, record_type string, refers_to long, digest string, payload_bytes long, "
          "payload binary, intact boolean, origin string, segment int, total long, block binary, head string")


def read_archives(spark: SparkSession, path: str, *, with_payload: bool = True) -> DataFrame:
    """One row per record written: page_id, url, record_type, refers_to, payload_bytes, payload_digest,
    payload (null for revisits) and ``intact`` (segments complete, framing and digest right)."""
    names = [x.split()[0] for x in RECORD.split(", ")]
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")

    def decode(f: dict, block: bytes) -> dict:
        digest, n = f["warc-payload-digest"].removeprefix("sha1:"), int(f["warc-payload-length"])
        row = {"page_id": int(f["warc-page-id"]) if f["warc-page-id"] else None, "url": f["warc-target-uri"] or None, "record_type": f["warc-type"],
               "refers_to": int(f["warc-refers-to-page"]) if "warc-refers-to-page" in f else None, "digest": digest, "payload_bytes": n, "payload": None, "intact": True}
        if f["warc-type"] == "response":
            try:
                payload = dechunked(block[block.index(END) + 4:])
                row |= {"payload_bytes": len(payload), "digest": payload_digest(payload), "payload": payload if with_payload else None,
                        "intact": len(payload) == n and payload_digest(payload) == digest}
            except (ValueError, IndexError):
                row["intact"] = False
        return row

    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("digest", pa.string()),
                        ("payload_bytes", pa.int64()), ("payload", pa.binary()), ("intact", pa.bool_()), ("origin", pa.string()), ("segment", pa.int32()),
                        ("total", pa.int64()), ("block", pa.binary()), ("head", pa.string())])

    def read(want_segments: bool):
        def run(batches):
            for b in batches:
                for data in b.column("content"):
                    rows, held = [], 0
                    for f, block in parse(data.as_py()):
                        if ("warc-segment-number" in f) != want_segments:
                            continue
                        if want_segments:
                            head = {k: v for k, v in f.items() if f["warc-type"] != "continuation"}
                            rows.append({"origin": f.get("warc-segment-origin-id", f["warc-record-id"]), "segment": int(f["warc-segment-number"]),
                                         "total": int(f["warc-segment-total-length"]) if "warc-segment-total-length" in f else None,
                                         "block": block, "head": "\r\n".join(f"{k}: {v}" for k, v in head.items()) or None})
                        else:
                            rows.append(decode(f, block))
                        held += len(block)
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
        return run

    whole = files.mapInArrow(read(False), RECORD)
    parts = files.mapInArrow(read(True), RECORD).select("origin", F.struct("segment", "total", "block", "head").alias("part"))
    parts = parts.groupBy("origin").agg(F.sort_array(F.collect_list("part")).alias("parts"))

    def join(batches):
        for b in batches:
            for parts in b.column("parts"):
                parts = parts.as_py()
                f = {k: v for k, v in (x.split(": ", 1) for x in (parts[0]["head"] or "").split("\r\n") if x)}
                block = b"".join(p["block"] for p in parts)
                row = decode(f, block) if f else {"record_type": "continuation", "intact": False}
                row["intact"] &= [p["segment"] for p in parts] == [*range(1, len(parts) + 1)] and parts[-1]["total"] == len(block)
                yield pa.RecordBatch.from_pylist([row], schema=schema)

    out = whole.unionByName(parts.mapInArrow(join, RECORD))
    return out.select(*[c for c in names[:8] if c != "digest" and (with_payload or c != "payload")], F.col("digest").alias("payload_digest"))


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Archives of the pages, written under the shared folder and read back (without the payloads)."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path, **options)
    return read_archives(spark, path, with_payload=False)
