"""Operator 8 — WARC writer and splittable WARC reader.

Write: payloads are grouped by digest (partially aggregated, so a payload that a
third of all pages share costs one row per task); the largest page id of a group
of equal payloads is the response, the others are revisits of it. Each task
streams its records, one gzip member each, into archives of its own under a
shared folder; a manifest lists the archives of the attempts that succeeded, so
a lost executor or a repeated task leaves only unlisted files behind.

Read: every archive is cut into byte ranges; a task scans its range for the gzip
magic, validates a candidate member by decoding its WARC version line, and owns
the records that start inside its range, reading past the end for the last one.
Memory is one read block and one record. Archives are opened with
``pyarrow.fs`` by URI, so the folder may be any file system that all tasks reach.

Defined cases: a null payload is empty; equal payloads shorter than
``min_revisit_bytes`` are all responses; a null page id is smaller than any
other, and of pages that share the largest id and the payload each is a response;
rows with a null id and no other id in the group are responses. Null urls leave
the target header out. An empty table gives archives without records.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankmill.session import checkpoint_dir

MAX_ARCHIVE_BYTES = 64 << 20
SPLIT_BYTES = 8 << 20
READ_BLOCK = 1 << 18
RANGES_PER_TASK = 16
GZIP_LEVEL = 3
# Fixed values of the format.
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1\r\n"
DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def open_folder(uri: str):
    """(file system, path) of a URI or plain path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def bare_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def encode_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record as a gzip member; ``refers_to`` makes it a revisit without payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"))
    head.append(f"WARC-Payload-Digest: sha1:{bare_digest(payload)}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    raw = VERSION + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    gz = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
    return gz.compress(raw) + gz.flush()


def decode_record(raw: bytes) -> tuple:
    """Fields of ``_RECORD`` from a whole decompressed record; raises on a damaged one."""
    head, sep, rest = raw.partition(b"\r\n\r\n")
    if not sep or not head.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    size = int(fields["Content-Length"])
    if len(rest) != size + 4:
        raise ValueError("a WARC record of another length than its header says")
    http, _, payload = rest[:size].partition(b"\r\n\r\n")
    length = int(http.decode().rpartition("Content-Length: ")[2])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    name = lambda key: int(v) if (v := fields[key][len("<urn:page:") : -1]) else None
    url = fields.get("WARC-Target-URI")
    if url is not None:
        url = url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
    if fields["WARC-Type"] == "revisit":
        return name("WARC-Record-ID"), url, "revisit", name("WARC-Refers-To"), length, digest, None
    if len(payload) != length or bare_digest(payload) != digest:
        raise ValueError("a payload that differs from its digest")
    return name("WARC-Record-ID"), url, "response", None, length, digest, payload


def with_revisits(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, refers_to): refers_to is the largest id of the equal payloads, null for that one."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload")
    ).withColumn("digest", F.sha1("payload"))
    lead = rows.groupBy("digest").agg(F.max("page_id").alias("lead"))
    joined = rows.join(lead, "digest")
    revisit = (F.octet_length("payload") >= min_revisit_bytes) & F.col("lead").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("lead"))
    return joined.select("page_id", "url", "payload", F.when(revisit, F.col("lead")).alias("refers_to"))


def write_warc(pages: DataFrame, folder: str, min_revisit_bytes: int = 0) -> DataFrame:
    """Write all pages below ``folder``; returns the manifest (path, n_bytes, n_records), read back from Parquet."""
    archives, manifest = f"{folder}/archives", f"{folder}/manifest"

    def run(batches):
        store, path = open_folder(archives)
        store.create_dir(path, recursive=True)
        out, name, size, count = None, "", 0, 0

        def close():
            out.close()
            return pa.RecordBatch.from_pydict({"path": [name], "n_bytes": [size], "n_records": [count]})

        for b in batches:
            for row in zip(*(b.column(c) for c in ("page_id", "url", "payload", "refers_to")), strict=True):
                page_id, url, payload, refers_to = (v.as_py() for v in row)
                member = encode_record(page_id, url, payload, refers_to)
                if out is None:
                    name, size, count = f"{archives}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(open_folder(name)[1], compression=None)
                out.write(member)
                size, count = size + len(member), count + 1
                if size >= MAX_ARCHIVE_BYTES:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    with_revisits(pages, min_revisit_bytes).mapInArrow(run, "path string, n_bytes long, n_records long").write.parquet(manifest)
    return pages.sparkSession.read.schema("path string, n_bytes long, n_records long").parquet(manifest)


class _Tail:
    """Bytes of a file from a place on, read in blocks; ``drop`` forgets what is done."""

    def __init__(self, source, start: int, size: int):
        self.source, self.at, self.size, self.buf = source, start, size, b""
        source.seek(start)

    def more(self) -> bool:
        block = self.source.read(READ_BLOCK)
        self.buf += block
        return bool(block)

    def drop(self, n: int) -> None:
        self.buf, self.at = self.buf[n:], self.at + n


def _member(tail: _Tail) -> bytes | None:
    """Decompress the member at the tail's start and step behind it; None if none is there."""
    inflate, parts = zlib.decompressobj(31), []
    fed = 0
    try:
        while not inflate.eof:
            if fed == len(tail.buf) and not tail.more():
                return None
            parts.append(inflate.decompress(tail.buf[fed:]))
            fed = len(tail.buf)
            head = parts[0] if len(parts[0]) >= 5 else b"".join(parts)
            if not b"WARC/".startswith(head[:5]):
                return None
    except zlib.error:
        return None
    tail.drop(fed - len(inflate.unused_data))
    return b"".join(parts)


def records_in_range(source, size: int, start: int, end: int):
    """Decoded records whose gzip member starts in [start, end)."""
    tail = _Tail(source, start, size)
    synced = False
    while tail.at < end:
        while len(tail.buf) < len(MAGIC) and tail.more():
            pass
        if not tail.buf:
            return
        if not tail.buf.startswith(MAGIC):
            if synced:
                raise ValueError(f"no gzip member at byte {tail.at}")
            hop = tail.buf.find(MAGIC)
            tail.drop(hop if hop >= 0 else max(1, len(tail.buf) - len(MAGIC) + 1))
            continue
        raw = _member(tail)
        if raw is None:
            if synced:
                raise ValueError(f"a damaged gzip member at byte {tail.at}")
            tail.drop(1)  # the magic occurred inside compressed data
            continue
        synced = True
        yield decode_record(raw)


def read_tasks(manifest: DataFrame, split_bytes: int) -> int:
    """Tasks for the byte ranges of the listed archives: one per range, and for very many one per ``RANGES_PER_TASK``."""
    ranges = manifest.agg(F.sum(F.ceil(F.col("n_bytes") / split_bytes))).first()[0] or 0
    few = 8 * manifest.sparkSession.sparkContext.defaultParallelism
    return int(max(1, min(ranges, max(few, ranges // RANGES_PER_TASK))))


def read_warc(manifest: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Records of all listed archives, read by byte ranges of ``split_bytes``."""
    ranges = manifest.filter("n_bytes > 0").select("path", "n_bytes", F.explode(F.expr(f"sequence(0L, n_bytes - 1, {int(split_bytes)}L)")).alias("start"))

    def run(batches):
        names = [f.split()[0] for f in _RECORD.split(", ")]
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        schema = pa.schema(list(zip(names, kinds, strict=True)))
        for b in batches:
            for row in b.to_pylist():
                store, path = open_folder(row["path"])
                held, weight = [], 0
                with store.open_input_file(path) as source:
                    for r in records_in_range(source, row["n_bytes"], row["start"], min(row["n_bytes"], row["start"] + split_bytes)):
                        held.append(r)
                        weight += len(r[6] or b"") + 200
                        if weight > 4 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), kinds, strict=True)], schema=schema)
                            held, weight = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), kinds, strict=True)], schema=schema)

    # rows of a range are small and its work is not: the number of tasks follows the ranges
    return ranges.repartition(read_tasks(manifest, split_bytes), "path", "start").mapInArrow(run, _RECORD)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """``records`` with the payload of revisits taken from the response that they name."""
    full = records.filter("record_type = 'response' AND page_id IS NOT NULL").groupBy("page_id", "payload_digest").agg(F.any_value("payload").alias("full"))
    joined = records.alias("r").join(full.alias("f"), (F.col("r.refers_to") == F.col("f.page_id")) & (F.col("r.payload_digest") == F.col("f.payload_digest")), "left")
    return joined.select(*[F.col(f"r.{c}") if c != "payload" else F.coalesce("r.payload", "f.full").alias("payload") for c in records.columns])


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: write all pages, read them back; one row per page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    folder = f"{checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    return read_warc(write_warc(pages, folder)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


#: DuckDB twin.
ORACLE_SQL = """
WITH p AS (SELECT page_id, url, encode(coalesce(html, '')) AS body FROM pages),
g AS (SELECT *, CAST(CAST(unhex(sha1(body)) AS BIT) AS VARCHAR) AS bits, max(page_id) OVER (PARTITION BY body) AS lead FROM p)
SELECT page_id, CAST(octet_length(body) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST('0b' || substr(bits, 5 * i + 1, 5) AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN lead IS NULL OR page_id = lead THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> lead THEN lead END AS refers_to, url FROM g
"""
