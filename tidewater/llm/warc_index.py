"""WARC archives, index first.

Pages are written as WARC 1.1 records, one gzip member each, and every record
leaves an index row: file, offset, length, URL and payload digest.  Records
are read back through the index only: selected rows are sorted by file and
offset, neighbouring byte ranges are joined into one read, and each record is
parsed from its own range.  Pages with equal payloads are stored once; the
others are revisit records that refer to the one with the smallest id.

Shape: owners of a payload come from a map-side combined ``min`` over
(digest, id) pairs without payloads; payloads are shuffled once, by page.  A
task writes its own files under the shared folder with names no other attempt
uses, and the index, written as a table, names only files of tasks that ended
well; files of lost attempts are never read.

Defined cases: a null payload is empty; payloads shorter than ``min_bytes``
are all responses; a page without an id is a revisit of a page with an id, and
else a response; a row that repeats id and payload is a revisit of its own id;
a null URL is written as the page's urn; line breaks in URLs are escaped in the
archive and kept in the index.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, scratch_path

#: Capture date of every record: the tables have none.
DATE = "2000-01-01T00:00:00Z"
FILE_BYTES = 512 << 20
#: Ranges closer than this are read together, up to so many bytes at once.
GAP, RUN = 64 << 10, 8 << 20

INDEX = ("file string, offset bigint, length bigint, page_id bigint, url string, payload_digest string, "
         "record_type string")
RECORD = ("page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, "
          "refers_to bigint, payload binary")


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder that all executors share (file, hdfs, s3, gs)."""
    if uri.startswith("/"):
        uri = f"file://{uri}"
    elif uri.startswith("file:/") and not uri.startswith("file://"):
        uri = f"file://{uri[5:]}"
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
           revisit: bool) -> bytes:
    """One WARC record, gzipped by itself."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: %d\r\n\r\n" % len(payload))
    block = http if revisit else http + payload
    target = (url or urn(page_id)[1:-1]).replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {urn(page_id)}",
            f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}",
            "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {urn(refers_to)}"]
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + z.flush()


def parse(member: bytes) -> dict:
    """The fields of RECORD that one gzipped record holds."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    field = dict(x.split(": ", 1) for x in lines)
    block = rest[:int(field["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(next(x for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")).split(b":")[1])
    number = lambda u: int(u[10:-1]) if len(u) > 11 else None
    revisit = field["WARC-Type"] == "revisit"
    digest = field["WARC-Payload-Digest"].removeprefix("sha1:")
    if not revisit and (len(payload) != size or base32(hashlib.sha1(payload).digest()) != digest):
        raise ValueError(f"payload of {field['WARC-Record-ID']} does not match its digest")
    return {"page_id": number(field["WARC-Record-ID"]), "payload_bytes": size, "payload_digest": digest,
            "record_type": field["WARC-Type"], "payload": None if revisit else payload,
            "refers_to": number(field["WARC-Refers-To"]) if revisit else None}


def base32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def with_owner(pages: DataFrame, page_id: str, url: str, payload: str, min_bytes: int) -> DataFrame:
    """(page_id, url, payload, sha1, revisit, refers_to) per row."""
    body = F.coalesce(F.encode(F.col(payload), "UTF-8"), F.lit(b""))
    d = pages.select(F.col(page_id).cast("bigint").alias("page_id"), F.col(url).alias("url"), body.alias("payload"))
    d = d.withColumn("sha1", F.sha1("payload")).withColumn("key", F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    owner = materialize(d.groupBy("sha1").agg(F.min("page_id").alias("owner")), "payload-owners")
    ids = d.groupBy("sha1", "key").agg(F.lit(1).alias("one")).drop("one").join(owner, "sha1")
    nth = F.row_number().over(Window.partitionBy("key", "sha1").orderBy("url"))
    d = d.join(ids.hint("merge"), ["key", "sha1"]).withColumn("nth", nth)
    revisit = ((F.length("payload") >= min_bytes) & F.col("owner").isNotNull()
               & ~(F.col("page_id").eqNullSafe(F.col("owner")) & (F.col("nth") == 1)))
    return d.select("page_id", "url", "payload", "sha1", revisit.alias("revisit"),
                    F.when(revisit, F.col("owner")).alias("refers_to"))


def write(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", payload: str = "html",
          min_bytes: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write one record per row of ``pages`` below ``folder``; returns the index."""
    rows = with_owner(pages, page_id, url, payload, min_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_folder(folder)
        store.create_dir(base, recursive=True)
        out, name, at = None, "", 0
        for b in batches:
            index: list[tuple] = []
            for i, u, body, sha1, revisit, owner in zip(*(c.to_pylist() for c in b.columns)):
                if out is None or at >= file_bytes:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                digest = base32(bytes.fromhex(sha1))
                member = record(i, u, body, digest, owner, revisit)
                out.write(member)
                index.append((name, at, len(member), i, u, digest, "revisit" if revisit else "response"))
                at += len(member)
            cols = list(zip(*index)) or [()] * 7
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, (
                pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()))],
                names=["file", "offset", "length", "page_id", "url", "payload_digest", "record_type"])
        if out is not None:
            out.close()

    return rows.mapInArrow(run, INDEX)


def runs(ranges: Iterator[tuple], gap: int = GAP, most: int = RUN) -> Iterator[list[tuple]]:
    """Groups of (file, offset, length, ...) rows, sorted, that one read covers."""
    group: list[tuple] = []
    for r in ranges:
        if group and (r[0] != group[0][0] or r[1] > group[-1][1] + group[-1][2] + gap
                      or r[1] + r[2] - group[0][1] > most):
            yield group
            group = []
        group.append(r)
    if group:
        yield group


def read(index: DataFrame, folder: str) -> DataFrame:
    """The records of the selected index rows, by coalesced range reads."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_folder(folder)
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        name, file = None, None
        for group in runs(rows):
            if group[0][0] != name:
                if file is not None:
                    file.close()
                name = group[0][0]
                file = store.open_input_file(f"{base}/{name}")
            begin, end = group[0][1], group[-1][1] + group[-1][2]
            data = memoryview(file.read_at(end - begin, begin))
            found = [parse(bytes(data[o - begin:o - begin + n])) | {"url": u} for _, o, n, u in group]
            yield pa.RecordBatch.from_pylist(found, schema=ARROW)
        if file is not None:
            file.close()

    return (index.select("file", "offset", "length", "url").repartitionByRange("file", "offset")
            .sortWithinPartitions("file", "offset").mapInArrow(run, RECORD))


ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                   ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                   ("payload", pa.binary())])


def archive(pages: DataFrame, min_bytes: int = 0) -> tuple[str, DataFrame]:
    """Write all pages to a new folder; its path and the index as a stored table."""
    folder = scratch_path(pages.sparkSession, "warc")
    return folder, materialize(write(pages, folder, min_bytes=min_bytes), "warc-index")
