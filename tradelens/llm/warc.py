"""Legacy archive converter: ARC files to WARC files with revisit records.

An ARC file opens with a ``filedesc://`` record whose body names the version and
the fields of the header lines that follow; version 1 lines hold URL, IP, date,
type and length, version 2 lines also result code, checksum, location, offset and
file name. Each record is a header line, exactly the declared number of bytes
(an HTTP message) and a line feed. The converter synthesises the equivalent WARC
records: identifier (a UUID of page and digest), ISO timestamp, target URI,
type, SHA-256 payload digest.

Of records with equal payloads of at least ``REVISIT_BYTES`` the one with the
smallest page id is the response, the others are revisits that carry only the
HTTP head and point to it.

Files are written by Spark's text writer (rows are whole records, the line
separator is the record's end) and read with the ``binaryFile`` source, so any
store that Spark reads will do; a file holds one input partition and is gunzipped
in a stream, so a task holds one file's compressed bytes and one record.
The repeated digests are counted first: up to ``BROADCAST_DIGESTS`` of them are
broadcast to the payloads, more are joined on the digest.

Defined cases: null html is an empty payload; a null URL becomes a URN of the
page; white space and control bytes in URLs are percent-encoded; a null page id
stays null, refers to the smallest id of its payload if there is one and is never
referred to; rows with equal page id and payload are all responses; extra columns
are ignored; an empty table gives no records.
"""

from __future__ import annotations

import hashlib
import os
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, scratch_path

REVISIT_BYTES = 100
BROADCAST_DIGESTS = 200_000    # rows of a digest, a page id and a count
GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}

# Fixed header layouts of the two ARC versions
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location",
        "Offset", "Filename", "Archive-length"],
}
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


def _uri(url: str | None, page_id) -> str:
    if not url:
        return f"urn:page:{page_id}"
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


# ------------------------------------------------------------------ ARC

def arc_filedesc(version: int) -> bytes:
    body = f"{version} 0 Archive\n{' '.join(ARC_FIELDS[version])}\n".encode()
    extra = "" if version == 1 else " 200 - - 0 archive.arc"
    return (f"filedesc://archive.arc 0.0.0.0 20200101000000 text/plain{extra} {len(body)}\n"
            ).encode() + body


def arc_record(version: int, page_id, url: str | None, html: str | None) -> bytes:
    payload = (html or "").encode()
    head = (f"HTTP/1.0 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\nX-Page-Id: {'' if page_id is None else page_id}"
            "\r\n\r\n").encode()
    sec = (page_id or 0) % 86400
    date = f"20200101{sec // 3600:02d}{sec // 60 % 60:02d}{sec % 60:02d}"
    extra = "" if version == 1 else f" 200 {zlib.crc32(payload):08x} - 0 archive.arc"
    return (f"{_uri(url, page_id)} 0.0.0.0 {date} text/html{extra} {len(head) + len(payload)}\n"
            ).encode() + head + payload


def _write_records(df: DataFrame, make, first: bytes, end: str, path: str) -> None:
    """One gzip text file per partition: ``first``, then a record per row."""
    def run(batches):
        yield pa.record_batch([pa.array([first], pa.binary())], names=["record"])
        for b in batches:
            yield pa.record_batch([pa.array([make(r) for r in b.to_pylist()], pa.binary())],
                                  names=["record"])
    # binary to string keeps the bytes as they are, and the text writer writes them
    df.mapInArrow(run, "record binary").select(F.col("record").cast("string")).write.options(
        lineSep=end, **GZIP).text(path)


def write_arc(pages: DataFrame, path: str, version: int = 1) -> None:
    """ARC files of the pages, one per partition."""
    _write_records(pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"),
                                F.col("html").cast("string")),
                   lambda r: arc_record(version, r["page_id"], r["url"], r["html"]),
                   arc_filedesc(version), "\n", path)


class _Stream:
    """Reads lines and exact lengths from gzip members, inflating as needed."""

    def __init__(self, raw: bytes, step: int = 1 << 20):
        self.raw, self.at, self.step, self.buf, self.pos = raw, 0, step, b"", 0
        self.z = zlib.decompressobj(31)

    def _more(self) -> bool:
        if self.z.eof and self.z.unused_data:
            rest, self.z = self.z.unused_data, zlib.decompressobj(31)
            out = self.z.decompress(rest)
        elif self.at < len(self.raw):
            if self.z.eof:
                self.z = zlib.decompressobj(31)
            out = self.z.decompress(self.raw[self.at:self.at + self.step])
            self.at += self.step
        else:
            return False
        self.buf, self.pos = self.buf[self.pos:] + out, 0
        return True

    def line(self) -> bytes | None:
        while (i := self.buf.find(b"\n", self.pos)) < 0:
            if not self._more():
                return None
        out, self.pos = self.buf[self.pos:i], i + 1
        return out

    def take(self, n: int) -> bytes:
        while len(self.buf) - self.pos < n:
            if not self._more():
                raise ValueError(f"archive ends inside a record of {n} bytes")
        out, self.pos = self.buf[self.pos:self.pos + n], self.pos + n
        return out


def parse_arc(raw: bytes) -> Iterator[dict]:
    """Records of a gzipped ARC file: page_id, uri, ip, date, mime, head, payload."""
    s, fields = _Stream(raw), ARC_FIELDS[1]
    while (line := s.line()) is not None:
        if not line.strip():
            continue
        parts = line.decode("utf-8", "replace").split(" ")
        body = s.take(int(parts[-1]))
        if parts[0].startswith("filedesc://"):
            said = body.split(b"\n")
            fields = said[1].decode().split(" ") if len(said) > 1 and said[1] else ARC_FIELDS[
                int(said[0].split()[0])]
            continue
        f = dict(zip(fields, parts, strict=True))
        head, _, payload = body.partition(b"\r\n\r\n")
        yield {"page_id": _number(_field(head, b"x-page-id")), "uri": f["URL"], "ip": f["IP-address"],
               "date": f["Archive-date"], "head": head, "payload": payload,
               "digest": hashlib.sha256(payload).hexdigest(), "bytes": len(payload)}


def _field(head: bytes, name: bytes) -> bytes:
    for line in head.split(b"\r\n"):
        k, _, v = line.partition(b":")
        if k.strip().lower() == name:
            return v.strip()
    return b""


def _number(v: bytes) -> int | None:
    return int(v) if v else None


ARC_ROWS = ("page_id long, uri string, ip string, date string, head binary, payload binary, "
            "digest string, bytes long")
SLIM_ROWS = "page_id long, digest string, bytes long"


def _read(spark: SparkSession, path: str, parse, schema: str) -> DataFrame:
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        for b in batches:
            for raw in b.column("content"):
                rows, size = [], 0
                for r in parse(raw.as_py()):
                    rows.append({k: r[k] for k in names})
                    size += len(r.get("payload") or b"") if "payload" in names else 64
                    if size > 4 << 20:
                        yield _batch(rows)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows)
    types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    arrow = pa.schema([(c.split()[0], types[c.split()[1]]) for c in schema.split(", ")])

    def _batch(rows):
        return pa.RecordBatch.from_pylist(rows, schema=arrow)

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select(
        "content").mapInArrow(run, schema)


def read_arc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    return _read(spark, path, parse_arc, ARC_ROWS if payload else SLIM_ROWS)


# ------------------------------------------------------------------ WARC

def _record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}')}>"


def warc_record(r: dict) -> bytes:
    """A response record, or a revisit if ``refers_to`` holds a page id."""
    d = r["date"]
    fields = [("WARC-Type", "response" if r["refers_to"] is None else "revisit"),
              ("WARC-Record-ID", _record_id(r["page_id"], r["digest"])),
              ("WARC-Date", f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"),
              ("WARC-Target-URI", r["uri"]), ("WARC-IP-Address", r["ip"]),
              ("WARC-Payload-Digest", f"sha256:{r['digest']}")]
    block = r["head"] + b"\r\n\r\n"
    if r["refers_to"] is None:
        block += r["payload"]
    else:
        fields += [("WARC-Profile", PROFILE),
                   ("WARC-Refers-To", _record_id(r["refers_to"], r["digest"])),
                   ("X-Refers-To-Page-Id", str(r["refers_to"]))]
    fields += [("Content-Type", "application/http; msgtype=response"),
               ("Content-Length", str(len(block)))]
    return ("WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode() + block


def warcinfo() -> bytes:
    body = b"format: WARC File Format 1.0\r\n"
    return (f"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: {_record_id('info', '')}\r\n"
            "WARC-Date: 2020-01-01T00:00:00Z\r\nContent-Type: application/warc-fields\r\n"
            f"Content-Length: {len(body)}\r\n\r\n").encode() + body


def parse_warc(raw: bytes) -> Iterator[dict]:
    """Response and revisit records of a gzipped WARC file; a response's digest is
    taken from its payload anew and must be the declared one."""
    s = _Stream(raw)
    while (line := s.line()) is not None:
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        f = {}
        while line := s.line().strip():
            k, _, v = line.partition(b":")
            f[k.strip().lower()] = v.strip()
        block = s.take(int(f[b"content-length"]))
        kind = f[b"warc-type"].decode()
        if kind not in ("response", "revisit"):
            continue
        head, _, payload = block.partition(b"\r\n\r\n")
        digest = f[b"warc-payload-digest"].decode().removeprefix("sha256:")
        n = int(_field(head, b"content-length") or 0)
        if kind == "response":
            n = len(payload)
            if hashlib.sha256(payload).hexdigest() != digest:
                raise ValueError(f"payload of {f[b'warc-record-id']} differs from its digest")
        yield {"page_id": _number(_field(head, b"x-page-id")), "payload_bytes": n,
               "payload_digest": digest, "record_type": kind,
               "refers_to": _number(f.get(b"x-refers-to-page-id", b"")), "payload": payload,
               "uri": f[b"warc-target-uri"].decode("utf-8", "replace")}


WARC_ROWS = ("page_id long, payload_bytes long, payload_digest string, record_type string, "
             "refers_to long")


def read_warc(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    return _read(spark, path, parse_warc,
                 WARC_ROWS + (", uri string, payload binary" if payload else ""))


def arc_to_warc(spark: SparkSession, arc_path: str, warc_path: str) -> None:
    """Converts ARC files into WARC files with revisit records."""
    first = read_arc(spark, arc_path, payload=False).where(F.col("bytes") >= REVISIT_BYTES).groupBy(
        "digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    first = cut_lineage(first)
    if first.count() <= BROADCAST_DIGESTS:
        first = F.broadcast(first)
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    records = read_arc(spark, arc_path).join(first, "digest", "left").withColumn(
        "refers_to", refers).select("page_id", "uri", "ip", "date", "head", "digest", "refers_to",
                                    F.when(F.col("refers_to").isNull(), F.col("payload"))
                                    .alias("payload"))
    _write_records(records, warc_record, warcinfo(), "\r\n\r\n", warc_path)


def pages_to_warc(pages: DataFrame, version: int = 1) -> DataFrame:
    """The pages as ARC files, converted to WARC files, and what these hold."""
    spark = pages.sparkSession
    folder = scratch_path(spark, f"archives-{uuid.uuid4().hex}")
    arc, warc = os.path.join(folder, "arc"), os.path.join(folder, "warc")
    write_arc(pages, arc, version)
    arc_to_warc(spark, arc, warc)
    return read_warc(spark, warc)


ORACLE_SQL = f"""
with p as (
  select page_id, strlen(coalesce(html, '')) as payload_bytes,
         sha256(coalesce(html, '')) as payload_digest from pages
), f as (select *, min(page_id) over (partition by payload_digest) as first from p)
select page_id, cast(payload_bytes as bigint) as payload_bytes, payload_digest,
  case when payload_bytes >= {REVISIT_BYTES} and first is not null and page_id is distinct from first
       then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= {REVISIT_BYTES} and page_id is distinct from first then first end as refers_to
from f
"""
