"""WARC archives written with an index, read back by byte ranges.

``write`` puts one record per row into gzip archives (one member per record)
in a folder that all executors share, and keeps an index row per record:
file, offset, length, URL, digest, type.  Of rows with equal payloads of at
least ``least`` bytes the one with the smallest key is a response, the others
are revisits that refer to it and carry the HTTP header without the payload.
``read`` selects index rows first, gathers their byte ranges file by file,
joins neighbouring ranges and reads each joined range once.

Only files named by the index count: a task that is run again writes a new
file, and the file of a lost attempt is never read.  A null payload is an
empty one; a null URL is left out of the record; a null key is larger than any
other.  Rows that repeat the smallest key of their payload all are responses.
An empty table gives an empty index.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskweave.llm.common import attach_group
from maskweave.session import discard, materialize, scratch_path

#: An archive file is closed beyond this size; ranges of one read end here.
FILE_BYTES, READ_BYTES, GAP_BYTES = 256 << 20, 8 << 20, 64 << 10

INDEX = ("key long, url string, payload_digest string, payload_bytes long, record_type string, "
         "refers_to long, file string, offset long, length long")
RECORD = ("key long, url string, payload binary, payload_bytes long, payload_digest string, "
          "record_type string, refers_to long")


def _store(uri: str):
    """(file system, path) of a shared folder or file."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def record(key, url, payload: bytes, digest: str, refers_to=None, revisit=False,
           date: str = "1970-01-01T00:00:00Z") -> bytes:
    """The bytes of one WARC record."""
    block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
             f"Content-Length: {len(payload)}\r\n\r\n").encode()
    if not revisit:
        block += payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <urn:record:{'' if key is None else key}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x1f%]", lambda m: f"%{ord(m[0]):02X}", url))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <urn:record:{refers_to}>")
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes):
    """(key, url, type, refers_to, digest, payload or None, payload bytes)."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])

    def number(name):
        inner = fields.get(name, "<urn:record:>")[len("<urn:record:"):-1]
        return int(inner) if inner else None

    url = fields.get("WARC-Target-URI")
    if url is not None:
        url = re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), url)
    kind = fields["WARC-Type"]
    return (number("WARC-Record-ID"), url, kind, number("WARC-Refers-To"),
            fields["WARC-Payload-Digest"].removeprefix("sha1:"), payload if kind == "response" else None, size)


def _write(folder: str):
    def run(batches):
        store, path = _store(folder)
        out, name, at = None, None, 0
        try:
            for b in batches:
                rows = []
                for key, url, payload, sha1, refers, revisit in zip(*(c.to_pylist() for c in b.columns)):
                    if out is None or at >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{path}/{name}", compression=None)
                    digest = base64.b32encode(sha1).decode()
                    pack = zlib.compressobj(3, zlib.DEFLATED, 31)
                    member = pack.compress(record(key, url, payload, digest, refers, revisit)) + pack.flush()
                    out.write(member)
                    rows.append((key, url, digest, len(payload), "revisit" if revisit else "response",
                                 refers, name, at, len(member)))
                    at += len(member)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 9,
                     (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(),
                      pa.int64(), pa.int64()))],
                    [c.split()[0] for c in INDEX.split(", ")])
        finally:
            if out is not None:
                out.close()
    return run


def write(rows: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html",
          least: int = 0) -> DataFrame:
    """Writes the archives and returns their index (read from ``folder``)."""
    store, path = _store(folder)
    store.create_dir(path, recursive=True)
    body = F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary")
    src = rows.select(F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"),
                      body.alias("payload"), F.unhex(F.sha1(body)).alias("sha1"))
    groups = materialize(src.where(F.length("payload") >= least).groupBy("sha1")
                         .agg(F.min("key").alias("first"), F.count("*").alias("rows")).where("rows > 1"), "payloads")
    marked = attach_group(src, groups, "sha1", "rows")
    revisit = F.coalesce(~F.col("key").eqNullSafe(F.col("first")) & F.col("rows").isNotNull()
                         & (F.length("payload") >= least), F.lit(False))
    marked = marked.select("key", "url", "payload", "sha1", F.when(revisit, F.col("first")).alias("refers"),
                           revisit.alias("revisit"))
    index = f"{folder.rstrip('/')}/index"
    marked.mapInArrow(_write(folder), INDEX).write.mode("errorifexists").parquet(index)
    discard(groups)
    return rows.sparkSession.read.parquet(index)


def _read(folder: str, with_payload: bool):
    def run(batches):
        store, path = _store(folder)
        for b in batches:
            for file, records in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                rows = []
                with store.open_input_file(f"{path}/{file}") as f:
                    k = 0
                    while k < len(records):
                        begin = records[k]["offset"]
                        z, stop = k, begin
                        while z < len(records) and records[z]["offset"] - stop <= GAP_BYTES and (
                                z == k or records[z]["offset"] - begin < READ_BYTES):
                            stop = records[z]["offset"] + records[z]["length"]
                            z += 1
                        f.seek(begin)
                        data = f.read(stop - begin)
                        for r in records[k:z]:
                            a = r["offset"] - begin
                            key, url, kind, refers, digest, payload, size = parse(
                                zlib.decompress(data[a:a + r["length"]], 31))
                            if digest != r["payload_digest"] or (payload is not None and (
                                    len(payload) != size
                                    or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest)):
                                raise ValueError(f"{file}: the record at {r['offset']} differs from its digest")
                            rows.append((key, url, payload if with_payload else None, size, digest, kind, refers))
                        k = z
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (
                        pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()))],
                    [c.split()[0] for c in RECORD.split(", ")])
    return run


def read(index: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """The records of the given index rows, payloads of responses checked
    against their digests.  Ranges are grouped by file and READ_BYTES, so a
    task never holds the index of a whole archive."""
    ranges = (index.groupBy("file", F.floor(F.col("offset") / READ_BYTES).alias("part"))
              .agg(F.sort_array(F.collect_list(F.struct("offset", "length", "payload_digest"))).alias("records"))
              .select("file", "records"))
    return ranges.mapInArrow(_read(folder, with_payload), RECORD)


def round_trip(rows: DataFrame, least: int = 0, **columns) -> DataFrame:
    """Writes ``rows`` to a fresh shared folder and reads every record back,
    without payloads."""
    folder = scratch_path(rows.sparkSession, "warc")
    return read(write(rows, folder, least=least, **columns), folder, with_payload=False)
