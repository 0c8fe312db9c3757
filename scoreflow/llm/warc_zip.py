"""WARC records in ZIP packages, written by Spark tasks and read back by byte ranges.

A package is a ZIP whose members are stored, not compressed: ``archive/data.warc.gz`` (one gzip member
per record) and ``indexes/index.cdxj`` (a JSON line per record with its offset and length).  The
reader opens a package at random positions only: end-of-central-directory record, ZIP64 locator and
record where fields overflow, central directory, the index, and then the records of one range per
task.  Nothing is extracted.

Equal payloads are found by SHA-1 in Spark; the record with the largest page_id holds the payload,
the others are ``revisit`` records that name it.  Tasks write packages under names of their own; the
manifest of the attempts that Spark committed says which packages exist, so a task that is run again
after a lost executor leaves no record twice.  Packages go to the shared folder, through pyarrow's file systems
(local or mounted paths, HDFS, S3); a task holds ``ARCHIVE_BYTES`` at most, or one record.

Defined results: a null payload is empty (0 bytes); a null id is kept, never the response of a group
that has an id; repeated rows with the largest id of their group are all responses; a null url gives
a record without target; line ends in a url are percent-encoded; an empty table writes no package and reads
back empty; only the named columns are read.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import struct
import uuid
import zipfile
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import shared_path, table, written

ARCHIVE_BYTES = 32 << 20
RANGE_BYTES = 4 << 20
LEVEL = 4
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
DATE = "2000-01-01T00:00:00Z"
ID = "<urn:page:{}>"
EMPTY_END = b"\r\n\r\n"


# ---------------------------------------------------------------- records
def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url: str | None, payload: bytes, refers_to=None, date: str = DATE) -> bytes:
    """One WARC/1.1 record, a revisit without payload if ``refers_to`` is given."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {ID.format(page_id)}", f"WARC-Date: {date}",
            f"WARC-Payload-Digest: sha1:{payload_digest(payload)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        head += [f"WARC-Refers-To: {ID.format(refers_to)}",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + EMPTY_END + block + EMPTY_END


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def _page(urn: str | None):
    """The id in a record's URN; ids are integers here, text otherwise."""
    if urn is None or urn == ID.format(None):
        return None
    x = urn[len("<urn:page:"):-1]
    return int(x) if x.lstrip("-").isdigit() else x


def parse_record(raw: bytes) -> dict:
    """Fields of one uncompressed record; payload is None for a revisit."""
    at = raw.index(EMPTY_END)
    f = _fields(raw[:at])
    block = raw[at + 4:at + 4 + int(f["content-length"])]
    http, _, payload = block.partition(EMPTY_END)
    kind = f["warc-type"]
    out = {"page_id": _page(f["warc-record-id"]), "url": f.get("warc-target-uri"), "record_type": kind,
           "refers_to": _page(f.get("warc-refers-to"))}
    if kind == "revisit":
        return out | {"payload": None, "payload_bytes": int(_fields(http)["content-length"]),
                      "payload_digest": f["warc-payload-digest"].partition(":")[2]}
    digest = payload_digest(payload)
    if f"sha1:{digest}" != f["warc-payload-digest"]:
        raise ValueError(f"payload of {f['warc-record-id']} does not match its digest")
    return out | {"payload": payload, "payload_bytes": len(payload), "payload_digest": digest}


# ---------------------------------------------------------------- ZIP
def _filesystem(uri: str):
    from pyarrow import fs

    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1) if uri.startswith("s3a://") else uri)


def _at(f, offset: int, n: int) -> bytes:
    f.seek(offset)
    got = f.read(n)
    if len(got) != n:
        raise ValueError("the package is cut off")
    return got


def directory(f, size: int) -> dict[str, tuple[int, int, int]]:
    """name -> (method, local header offset, compressed size), from the central directory."""
    tail_at = max(0, size - 65557)
    tail = _at(f, tail_at, size - tail_at)
    end = len(tail)
    while True:  # the comment may hold the signature: its length must fit
        end = tail.rfind(b"PK\5\6", 0, end)
        if end < 0:
            raise ValueError("not a ZIP package")
        if len(tail) - end >= 22 and end + 22 + struct.unpack_from("<H", tail, end + 20)[0] == len(tail):
            break
    count, length, start = struct.unpack_from("<HII", tail, end + 10)
    if count == 0xFFFF or length == 0xFFFFFFFF or start == 0xFFFFFFFF:
        sig, _, at64, _ = struct.unpack("<4sIQI", _at(f, tail_at + end - 20, 20))
        if sig != b"PK\6\7":
            raise ValueError("ZIP64 locator is missing")
        big = _at(f, at64, 56)
        if big[:4] != b"PK\6\6":
            raise ValueError("ZIP64 end record is missing")
        count, length, start = struct.unpack_from("<QQQ", big, 32)
    raw, at, out = _at(f, start, length), 0, {}
    for _ in range(count):
        if raw[at:at + 4] != b"PK\1\2":
            raise ValueError("central directory is damaged")
        method, = struct.unpack_from("<H", raw, at + 10)
        packed, plain = struct.unpack_from("<II", raw, at + 20)
        name_n, extra_n, note_n = struct.unpack_from("<HHH", raw, at + 28)
        offset, = struct.unpack_from("<I", raw, at + 42)
        name = raw[at + 46:at + 46 + name_n].decode()
        extra, i = raw[at + 46 + name_n:at + 46 + name_n + extra_n], 0
        while i + 4 <= len(extra):
            kind, n = struct.unpack_from("<HH", extra, i)
            if kind == 1:  # ZIP64: only the fields that overflow, in this order
                wide = iter(struct.unpack_from(f"<{n // 8}Q", extra, i + 4))
                plain = next(wide) if plain == 0xFFFFFFFF else plain
                packed = next(wide) if packed == 0xFFFFFFFF else packed
                offset = next(wide) if offset == 0xFFFFFFFF else offset
            i += 4 + n
        out[name] = (method, offset, packed)
        at += 46 + name_n + extra_n + note_n
    return out


def stored(f, members: dict, name: str) -> tuple[int, int]:
    """(first byte, size) of a stored member inside the package."""
    method, offset, size = members[name]
    if method:
        raise ValueError(f"{name} is compressed; only stored members can be read by range")
    head = _at(f, offset, 30)
    if head[:4] != b"PK\3\4":
        raise ValueError("local header is damaged")
    name_n, extra_n = struct.unpack_from("<HH", head, 26)
    return offset + 30 + name_n + extra_n, size


def package(records: list[tuple[object, bytes]]) -> bytes:
    """A package of (id, gzip member) records."""
    out, lines, at = io.BytesIO(), [], 0
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        with z.open(zipfile.ZipInfo(DATA), "w", force_zip64=True) as f:
            for key, raw in records:
                f.write(raw)
                lines.append(json.dumps({"id": key, "offset": at, "length": len(raw)}))
                at += len(raw)
        z.writestr(zipfile.ZipInfo(INDEX), "\n".join(lines))
    return out.getvalue()


def package_ranges(f, size: int, limit: int = RANGE_BYTES):
    """(first byte, lengths of the records) of runs of records of about ``limit`` bytes."""
    members = directory(f, size)
    base, _ = stored(f, members, DATA)
    at, n = stored(f, members, INDEX)
    start, lengths = 0, []
    for line in _at(f, at, n).decode().split("\n"):
        if line:
            x = json.loads(line)
            if lengths and (x["offset"] != start + sum(lengths) or sum(lengths) + x["length"] > limit):
                yield base + start, lengths
                start, lengths = x["offset"], []
            lengths.append(x["length"])
    if lengths:
        yield base + start, lengths


def gzip_member(raw: bytes, level: int = LEVEL) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


# ---------------------------------------------------------------- Spark
def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write every row as a record into packages under ``folder``; returns the manifest (path, records, bytes)."""
    body = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    p = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), body.alias("payload"))
    p = p.withColumn("sha1", F.sha1("payload"))
    groups = p.where(F.octet_length("payload") >= min_bytes).groupBy("sha1") \
        .agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).where("n > 1 and keeper is not null")
    revisits = written(p.select("page_id", "sha1").join(groups, "sha1")
                       .where("page_id is null or page_id <> keeper").distinct()
                       .select(F.col("page_id").alias("_id"), F.col("sha1").alias("_sha1"), "keeper"), "revisits")
    rows = p.join(revisits, F.expr("page_id <=> _id and sha1 = _sha1"), "left").select("page_id", "url", "payload", "keeper")

    def run(batches):
        fs, root = _filesystem(folder)
        fs.create_dir(root, recursive=True)
        held, size = [], 0

        def put():
            name = f"{uuid.uuid4().hex}.zip"
            whole = package(held)
            with fs.open_output_stream(f"{root}/{name}") as f:
                f.write(whole)
            return pa.record_batch({"path": pa.array([f"{folder}/{name}"]), "records": pa.array([len(held)], pa.int64()),
                                    "bytes": pa.array([len(whole)], pa.int64())})

        for b in batches:
            for key, url, payload, keeper in zip(*(b.column(c) for c in ("page_id", "url", "payload", "keeper"))):
                raw = gzip_member(record(key.as_py(), url.as_py(), payload.as_py(), keeper.as_py()))
                if held and size + len(raw) > archive_bytes:
                    yield put()
                    held, size = [], 0
                held.append((key.as_py(), raw))
                size += len(raw)
        if held:
            yield put()

    return written(rows.mapInArrow(run, "path string, records long, bytes long"), "manifest")


def read_archives(manifest: DataFrame, id_type: str = "long", payload: bool = True,
                  range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Every record of the manifest's packages: page_id, url, record_type, refers_to, payload_bytes,
    payload_digest and, if asked for, payload (null for a revisit)."""

    def plan(batches):
        for b in batches:
            for path in b.column("path").to_pylist():
                fs, where = _filesystem(path)
                with fs.open_input_file(where) as f:
                    found = list(package_ranges(f, f.size(), range_bytes))
                yield pa.record_batch({"path": pa.array([path] * len(found), pa.string()),
                                       "start": pa.array([s for s, _ in found], pa.int64()),
                                       "lengths": pa.array([n for _, n in found], pa.list_(pa.int64()))})

    ddl = f"page_id {id_type}, url string, record_type string, refers_to {id_type}, payload_bytes long, payload_digest string"
    names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest"] + ["payload"] * payload
    ids = pa.int64() if id_type == "long" else pa.string()
    kinds = [ids, pa.string(), pa.string(), ids, pa.int64(), pa.string()] + [pa.binary()] * payload

    def read(batches):
        for b in batches:
            for path, start, lengths in zip(*(b.column(c).to_pylist() for c in ("path", "start", "lengths"))):
                fs, where = _filesystem(path)
                with fs.open_input_file(where) as f:
                    raw = memoryview(_at(f, start, sum(lengths)))
                found, at = [], 0
                for n in lengths:
                    found.append(parse_record(zlib.decompress(raw[at:at + n], 31)))
                    at += n
                yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in found], t) for c, t in zip(names, kinds)], names=names)

    ranges = manifest.select("path").mapInArrow(plan, "path string, start long, lengths array<long>")
    # a given number, from the bytes that the ranges stand for: adaptive execution would see the rows of the plan only, and
    # read all archives in one task
    total = manifest.agg(F.sum("bytes")).first()[0] or 0
    tasks = max(1, -(-total // range_bytes))
    return ranges.repartition(tasks, "path", "start").mapInArrow(read, ddl + (", payload binary" if payload else ""))


def op6_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_archives(table(spark, sf_dir, "pages"), shared_path(spark, "warc"))
    return read_archives(manifest, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
