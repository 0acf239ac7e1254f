"""WARC files: a writer that turns equal payloads into revisits, and a splittable reader.

Each record is a gzip member of its own, holding an HTTP response. A reader task gets a byte range: it
looks for the gzip magic number, takes a candidate only if it decodes to a WARC header and a whole member
(its length and checksum are right, and it holds as many bytes as its Content-Length says), and owns the
records that start inside its range, reading past the range's end for the last of them. What follows a
member has no say in it, so every intact record is found, however damaged its neighbours are.

Damage: bytes that belong to no intact record (damaged, padded or cut archives) are counted, a file at a
time, as the file's size less its records' sizes. read_warc() raises on any by default, and returns the
intact records if asked to skip them; damage() lists the files. A payload may hold whole records that lie
in it uncompressed, and a range that starts there takes them for the file's own: so ranges report where all
members start and end, and those that start inside another member of the file are left out. A member is
held whole while it is checked: a task's memory follows the longest record.

Defined results: a null payload is an empty one; a null id sorts below all others and is written as
"null"; rows with the id of a payload's response are all responses; a null URL is left out; columns
other than those named are ignored; an empty table gives no files and no rows. Records that are neither
response nor revisit, or whose payload doesn't match its digest, count as damage.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumenfold.llm import shared

#: Fixed values of the format.
MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URN = "urn:page:"

PART_BYTES = 1 << 30
RANGE_BYTES = 8 << 20
CHUNK = 1 << 18

SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def make_record(page_id: int | None, url: str | None, payload: bytes, revisits: bool, refers_to: int | None, date: str) -> bytes:
    name = lambda i: f"<{URN}{'null' if i is None else i}>"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisits else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisits else 'response'}", f"WARC-Record-ID: {name(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~"))
    head.append(f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}")
    if revisits:
        head += [f"WARC-Refers-To: {name(refers_to)}", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 6) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _writer(path: str, date: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n, rows, done = TaskContext.get().partitionId(), 0, iter(()), []
        rows = (r for b in batches for r in zip(*[b.column(i) for i in range(5)]))
        row = next(rows, None)
        while row is not None:
            uri, size = f"{path}/part-{task:06d}-{n:04d}.warc.gz", 0
            with shared.publish(uri) as f:
                while row is not None and size < PART_BYTES:
                    page_id, url, html, revisits, keeper = (x.as_py() for x in row)
                    size += f.write(gzip_member(make_record(page_id, url, (html or "").encode(), revisits, keeper, date)))
                    row = next(rows, None)
            done.append((uri, size))
            n += 1
        shared.trim()
        yield pa.RecordBatch.from_arrays([pa.array([u for u, _ in done], pa.string()), pa.array([s for _, s in done], pa.int64())], ["uri", "size"])

    return write


def write_warc(spark: SparkSession, pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write a record for each row; returns (uri, size) of the files, written once to the shared folder.

    Of payloads of at least min_bytes that are equal, the one with the largest id is a response. The
    largest ids are aggregated before the shuffle; a payload with many copies is a skewed side of a
    sort-merge join, which adaptive execution splits."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(payload_col).cast("string").alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.coalesce("html", F.lit(""))))
    keepers = rows.groupBy("digest").agg(F.max("page_id").alias("keeper"))
    large = F.octet_length(F.coalesce("html", F.lit(""))) >= min_bytes
    joined = rows.join(keepers, "digest").select("page_id", "url", "html", (large & ~F.col("page_id").eqNullSafe(F.col("keeper"))).alias("revisits"), "keeper")
    return shared.write_table(spark, joined.mapInArrow(_writer(path, date), "uri string, size long"), "warc-files")


def _member(f, at: int) -> tuple[bytes, int] | None:
    """The content of the WARC member that starts at a position, and its end; None if there is none."""
    f.seek(at)
    unzip, out, end = zlib.decompressobj(31), [], at
    try:
        while not unzip.eof:
            data = f.read(CHUNK)
            if not data:
                return None
            out.append(unzip.decompress(data))
            end += len(data)
            if len(out) == 1 and not out[0].startswith(b"WARC/1.") and (len(out[0]) >= 7 or unzip.eof):
                return None
    except zlib.error:
        return None
    content = b"".join(out)
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = parse_fields(head)
    if not content.startswith(b"WARC/1.") or not fields.get("content-length", "").isdigit() or len(rest) < int(fields["content-length"]):
        return None
    return content, end - len(unzip.unused_data)


def parse_fields(head: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])}


def members(f, start: int, stop: int) -> Iterator[tuple[bytes, int, int]]:
    """The contents, starts and ends of the members that start in [start, stop), each after the last one's end."""
    at = start
    while at < stop:
        if found := _member(f, at):
            yield found[0], at, found[1]
            at = found[1]
        else:
            at = _magic(f, at + 1, stop)


def _magic(f, at: int, stop: int) -> int:
    """Where the next magic number starts, or stop."""
    while at < stop:
        f.seek(at)
        data = f.read(min(CHUNK, stop - at) + 2)
        if (found := data.find(MAGIC)) >= 0 and at + found < stop:
            return at + found
        at += CHUNK
    return stop


def parse_record(content: bytes) -> dict | None:
    """The fields of a record; None if it is of another type or its payload isn't what its digest says."""
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = parse_fields(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind, digest = fields.get("warc-type"), fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind not in ("response", "revisit") or kind == "response" and base32_sha1(payload) != digest:
        return None
    number = lambda x: int(x[1 + len(URN) : -1]) if re.fullmatch(f"<{URN}-?[0-9]+>", x) else None
    size = len(payload) if kind == "response" else int(parse_fields(http).get("content-length", 0))
    return {"page_id": number(fields.get("warc-record-id", "")), "url": fields.get("warc-target-uri"), "record_type": kind, "payload_digest": digest, "payload_bytes": size, "refers_to": number(fields.get("warc-refers-to", "")) if kind == "revisit" else None, "payload": payload if kind == "response" else None}


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "uri", "start", "stop"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    for batch in batches:
        for part in batch.to_pylist():
            rows: list[dict] = []
            with shared.open_read(part["uri"]) as f:
                for content, start, stop in members(f, part["start"], min(part["start"] + part["step"], part["size"])):
                    record = parse_record(content) or dict.fromkeys(names[:5])
                    rows.append({n: record[n] for n in names[:5]} | {"uri": part["uri"], "start": start, "stop": stop})
                    if len(rows) == 4096:
                        yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in zip(names, types)], names)
                        rows = []
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in zip(names, types)], names)
    shared.trim()


def read_records(spark: SparkSession, files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row for each intact record of the files (uri, size), read by byte ranges: its fields, the file and its size there.

    Members of a file lie one after another or in each other, so one that starts before the furthest end of
    those that start before it lies in another. The window is over a file's members, without their contents."""
    ranges = files.where("size > 0").select("uri", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(range_bytes).cast("long"))).alias("start"), F.lit(range_bytes).cast("long").alias("step"))
    dealt = ranges.repartition(shared.partitions(spark), F.xxhash64("uri", "start"))
    found = shared.write_table(spark, dealt.mapInArrow(_reader, f"{SCHEMA}, uri string, start long, stop long"), "warc-records")
    before = F.max("stop").over(Window.partitionBy("uri").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    own = found.withColumn("before", before).where("before IS NULL OR before <= start").where("record_type IS NOT NULL")
    return own.withColumn("member_bytes", F.col("stop") - F.col("start")).drop("start", "stop", "before")


def damage(files: DataFrame, records: DataFrame) -> DataFrame:
    """(uri, bytes that belong to no intact record) of the files that have any."""
    sizes = records.groupBy("uri").agg(F.sum("member_bytes").alias("found"))
    return files.join(sizes, "uri", "left").select("uri", (F.col("size") - F.coalesce("found", F.lit(0))).alias("lost_bytes")).where("lost_bytes > 0")


def read_warc(spark: SparkSession, files: DataFrame, range_bytes: int = RANGE_BYTES, on_damage: str = "raise") -> DataFrame:
    """One row for each intact record of the files. on_damage: "raise" if any byte belongs to none, or "skip" such bytes."""
    if on_damage not in ("raise", "skip"):
        raise ValueError("on_damage is raise or skip")
    records = read_records(spark, files, range_bytes)
    if on_damage == "raise" and (bad := damage(files, records).agg(F.count(F.lit(1)), F.sum("lost_bytes"), F.min("uri")).first())[0]:
        raise ValueError(f"{bad[1]} bytes of {bad[0]} archives belong to no intact record, the first is {bad[2]}")
    return records.drop("uri", "member_bytes")
