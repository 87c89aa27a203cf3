"""WARC records in ZIP archives, read back by byte ranges.

Writing: every task writes one archive with two stored members,
``archive/data.warc.gz`` (one gzip member per record) and
``indexes/index.jsonl`` (one line per record: id, offset, length), to a folder
that all executors share, and returns the archive's path. Only the paths of
finished tasks are read, so what a lost task left behind is never seen.

Reading: the end record, the ZIP64 records and the central directory are parsed
from the tail of the archive; stored members are located by their local headers;
the index member is read by range, and records are read by range in index order
without extracting the member.

Equal payloads of ``min_bytes`` or more are written once: the record with the
largest id is the response, the others are revisits that refer to it and hold
only the HTTP head. Ids are compared as numbers, a null id below all others. A
repeated id with the same payload is a response again. Null html is an empty
payload; a null url is an empty target. Other columns are ignored; an empty
table gives no archives and no rows. Payloads are never cut."""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zipfile
import zlib

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, shared_folder, table

MIN_BYTES = 1000
DATA, INDEX = "archive/data.warc.gz", "indexes/index.jsonl"
DATE = "2024-01-01T00:00:00Z"
MANIFEST = "path string, records bigint"
RECORDS = ("path string, offset bigint, length bigint, page_id bigint, url string, record_type string, refers_to bigint, "
           "payload_bytes bigint, payload_digest string, payload binary")
BROADCAST_ROWS = 200_000
READ_BYTES = 4 << 20


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return pafs.FileSystem.from_uri(uri)


def _clean(s: str) -> str:
    return "".join(c if c >= " " and c != "\x7f" else "%%%02X" % ord(c) for c in s)


def record(page_id: int | None, url: str, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record: a response, or a revisit without the payload."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = head + payload if refers_to is None else head
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
             f"WARC-Date: {DATE}", f"WARC-Target-URI: {_clean(url)}", f"WARC-Payload-Digest: sha1:{digest}",
             "Content-Type: application/http; msgtype=response"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                  "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines.append(f"Content-Length: {len(body)}")
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + body + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Headers, payload and payload digest of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    h = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    body = rest[:int(h["content-length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    number = lambda v: int(v[len("<urn:page:"):-1]) if v and v != "<urn:page:>" else None
    kind = h["warc-type"]
    if kind == "response" and len(payload) != size:
        raise ValueError("payload of another length than its head says")
    return {"page_id": number(h["warc-record-id"]), "url": h["warc-target-uri"], "record_type": kind,
            "refers_to": number(h.get("warc-refers-to")), "payload_bytes": size,
            "payload_digest": base64.b32decode(h["warc-payload-digest"].removeprefix("sha1:")).hex(),
            "payload": payload if kind == "response" else None}


def write_archive(rows, uri: str) -> int:
    """Write (page_id, url, payload, refers_to) rows as one archive; the number of records."""
    fs, path = _open(uri)
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    index, at = [], 0
    with fs.open_output_stream(path) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True) as z:
        with z.open(zipfile.ZipInfo(DATA, (2024, 1, 1, 0, 0, 0)), "w", force_zip64=True) as member:
            for page_id, url, payload, refers_to in rows:
                packer = zlib.compressobj(4, zlib.DEFLATED, 31)
                raw = packer.compress(record(page_id, url, payload, refers_to)) + packer.flush()
                member.write(raw)
                index.append(json.dumps({"id": page_id, "url": url, "offset": at, "length": len(raw)}))
                at += len(raw)
        z.writestr(zipfile.ZipInfo(INDEX, (2024, 1, 1, 0, 0, 0)), "\n".join(index))
    return len(index)


def directory(f, size: int) -> dict[str, tuple[int, int, int]]:
    """Members of a ZIP archive: name -> (method, local header offset, stored
    bytes), from its central directory (ZIP64 where the fields overflow)."""
    tail_at = max(0, size - 65_557)
    f.seek(tail_at)
    tail = f.read(size - tail_at)
    at = tail.rfind(b"PK\x05\x06")
    while at >= 0 and (at + 22 > len(tail) or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
        at = tail.rfind(b"PK\x05\x06", 0, at)
    if at < 0:
        raise ValueError("no end of central directory")
    entries, length, offset = struct.unpack_from("<HII", tail, at + 10)
    if entries == 0xFFFF or length == 0xFFFFFFFF or offset == 0xFFFFFFFF:
        f.seek(tail_at + at - 20)
        sig, _, end64, _ = struct.unpack("<4sIQI", f.read(20))
        if sig != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        f.seek(end64)
        head = f.read(56)
        if head[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end record")
        entries, length, offset = struct.unpack_from("<QQQ", head, 32)
    f.seek(offset)
    central, out, at = f.read(length), {}, 0
    for _ in range(entries):
        if central[at:at + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        flags, method = struct.unpack_from("<HH", central, at + 8)
        stored, plain, n, m, k = struct.unpack_from("<IIHHH", central, at + 20)
        local = struct.unpack_from("<I", central, at + 42)[0]
        name = central[at + 46:at + 46 + n].decode("utf-8" if flags & 0x800 else "cp437")
        extra, x = central[at + 46 + n:at + 46 + n + m], 0
        while x + 4 <= len(extra):
            tag, size_ = struct.unpack_from("<HH", extra, x)
            if tag == 1:
                wide = iter(struct.unpack_from(f"<{size_ // 8}Q", extra, x + 4))
                plain = next(wide) if plain == 0xFFFFFFFF else plain
                stored = next(wide) if stored == 0xFFFFFFFF else stored
                local = next(wide) if local == 0xFFFFFFFF else local
            x += 4 + size_
        out[name] = (method, local, stored)
        at += 46 + n + m + k
    return out


def stored_range(f, entry: tuple[int, int, int]) -> tuple[int, int]:
    """(first byte, bytes) of a stored member."""
    method, local, size = entry
    if method != 0:
        raise ValueError("member is compressed; only stored members can be read by range")
    f.seek(local)
    head = f.read(30)
    if head[:4] != b"PK\x03\x04":
        raise ValueError("no local header")
    n, m = struct.unpack_from("<HH", head, 26)
    return local + 30 + n + m, size


def read_archive(uri: str, wanted: set | None = None):
    """Records of one archive, with offset and length, by range reads. Records
    that lie next to each other share a read of at most READ_BYTES."""
    fs, path = _open(uri)
    with fs.open_input_file(path) as f:
        members = directory(f, f.size())
        at, size = stored_range(f, members[INDEX])
        f.seek(at)
        lines = [json.loads(x) for x in f.read(size).decode().split("\n") if x]
        if wanted is not None:
            lines = [x for x in lines if x["id"] in wanted]
        base, total = stored_range(f, members[DATA])
        i = 0
        while i < len(lines):
            first, j, end = lines[i]["offset"], i, lines[i]["offset"] + lines[i]["length"]
            while j + 1 < len(lines) and lines[j + 1]["offset"] == end and end + lines[j + 1]["length"] - first <= READ_BYTES:
                j += 1
                end += lines[j]["length"]
            if end > total:
                raise ValueError("record beyond its member")
            f.seek(base + first)
            block = f.read(end - first)
            for x in lines[i:j + 1]:
                raw = zlib.decompress(block[x["offset"] - first:x["offset"] - first + x["length"]], 31)
                yield x["offset"], x["length"], parse_record(raw)
            i = j + 1


def _write(folder: str):
    def run(batches):
        made = []

        def rows():
            for b in batches:
                for i, u, p, r in zip(*(c.to_pylist() for c in b.columns)):
                    yield i, u or "", (p or "").encode("utf-8", "surrogatepass"), r
        each = rows()
        first = next(each, None)
        if first is not None:
            uri = f"{folder}/{uuid.uuid4().hex}.zip"
            made.append((uri, write_archive(_chain(first, each), uri)))
        yield pa.RecordBatch.from_arrays([pa.array([u for u, _ in made], pa.string()), pa.array([n for _, n in made], pa.int64())],
                                         ["path", "records"])
    return run


def _chain(first, rest):
    yield first
    yield from rest


def write_archives(pages: DataFrame, folder: str, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Write one record per row of pages(page_id, url, html), one archive per
    partition; returns the manifest (path, records), checkpointed."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", html.alias("html"))
    rows = rows.withColumn("_d", F.when(F.octet_length("html") >= min_bytes, F.sha1("html")))
    # partial aggregation leaves one row per payload and task before the shuffle
    twice = cut(rows.filter("_d is not null").groupBy("_d").agg(F.max("page_id").alias("_top"), F.count("*").alias("_n"))
                .filter("_n > 1").select("_d", "_top"))
    small = twice.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    joined = rows.join(F.broadcast(twice) if small else twice, "_d", "left")
    refers = F.when((F.col("_top") > F.col("page_id")) | (F.col("_top").isNotNull() & F.col("page_id").isNull()), F.col("_top"))
    return cut(joined.select("page_id", "url", "html", refers.alias("refers_to")).mapInArrow(_write(folder), MANIFEST))


def read_archives(manifest: DataFrame, page_ids: list[int] | None = None) -> DataFrame:
    """All records of the archives (or those of ``page_ids``), payloads included."""
    wanted = None if page_ids is None else set(page_ids)
    names = [x.split()[0] for x in RECORDS.split(", ")]
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def batch(out):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    def run(batches):
        for b in batches:
            for uri in b.column(0).to_pylist():
                out, size = [], 0
                for offset, length, r in read_archive(uri, wanted):
                    out.append((uri, offset, length, *(r[n] for n in names[3:])))
                    size += len(r["payload"] or b"")
                    if size > 4 << 20 or len(out) >= 1000:
                        yield batch(out)
                        out, size = [], 0
                if out:
                    yield batch(out)
    return manifest.select("path").mapInArrow(run, RECORDS)


def op3_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_archives(table(spark, sf_dir, "pages"), shared_folder(spark, "warc"))
    rows = read_archives(manifest)
    return rows.select("page_id", F.coalesce(F.octet_length("payload").cast("bigint"), "payload_bytes").alias("payload_bytes"),
                       F.coalesce(F.sha1("payload"), "payload_digest").alias("payload_digest"), "record_type", "refers_to")


OP3_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages),
t AS (SELECT html, max(page_id) AS top FROM p WHERE n >= 1000 GROUP BY html)
SELECT p.page_id, p.n::BIGINT AS payload_bytes, sha1(p.html) AS payload_digest,
  CASE WHEN t.top > p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN t.top > p.page_id THEN t.top END AS refers_to
FROM p LEFT JOIN t ON t.html = p.html AND p.n >= 1000
"""
