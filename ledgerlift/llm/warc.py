"""WARC archives as a Python data source: ``spark.read.format("warc")`` and ``df.write.format("warc")``.

Reading: files are packed into partitions by size; record types and headers are filtered before a payload
is touched; a record's headers are inflated first, the payload only of records that pass, and not at all
with ``payload=false``. Every record is its own gzip member, and members written here carry the skip-length
field ("sl") of the WARC standard's gzip annex, so that an unwanted record is stepped over by a seek.

Writing: each task writes files of bounded size under a name of its own attempt, and the commit lists the
files of the successful attempts in a manifest. A reader of a folder with a manifest reads only those, so
lost executors and repeated or speculative tasks leave no double records.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    StringStartsWith,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from ledgerlift.llm.common import staging_path

READ_SCHEMA = (
    "file string, offset bigint, record_type string, record_id string, target_uri string, date string, "
    "payload_digest string, refers_to string, content_type string, content_length bigint, "
    "headers map<string,string>, http_headers map<string,string>, payload binary"
)
WRITE_COLUMNS = ("record_type", "record_id", "target_uri", "payload_digest", "payload_bytes", "refers_to", "payload")

# The named fields behind the columns that can be filtered on, and the profile of a revisit.
FIELDS = {
    "record_type": "warc-type",
    "record_id": "warc-record-id",
    "target_uri": "warc-target-uri",
    "date": "warc-date",
    "payload_digest": "warc-payload-digest",
    "refers_to": "warc-refers-to",
    "content_type": "content-type",
}
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "_warc_manifest.json"
BREAK = b"\r\n\r\n"
MOST_HEADER = 1 << 20
CHUNK = 1 << 16


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI that driver and executors share."""
    return fs.FileSystem.from_uri(path) if re.match(r"[a-z][a-z0-9+.-]*:", path) else (fs.LocalFileSystem(), path)


def listed_files(store: fs.FileSystem, root: str) -> set[str] | None:
    """The files a folder's manifest names, or None without a manifest."""
    if store.get_file_info(f"{root}/{MANIFEST}").type == fs.FileType.NotFound:
        return None
    with store.open_input_stream(f"{root}/{MANIFEST}") as f:
        return set(json.loads(f.read()))


def header_lines(raw: bytes) -> dict[str, str]:
    """Named fields, lower-case names; continuation lines are joined, the first of repeated names stays."""
    out: dict[str, str] = {}
    last = None
    for line in raw.split(b"\r\n")[1:]:
        if line[:1] in (b" ", b"\t") and last:
            out[last] += " " + line.strip().decode("utf-8", "replace")
        elif b":" in line:
            name, value = line.split(b":", 1)
            last = name.strip().decode("utf-8", "replace").lower()
            out.setdefault(last, value.strip().decode("utf-8", "replace"))
    return out


class Bytes:
    """Reads at any place of a file, one buffered chunk at a time."""

    def __init__(self, file, size: int):
        self.file, self.size, self.start, self.held = file, size, 0, b""

    def at(self, offset: int, length: int) -> bytes:
        if not (self.start <= offset and offset + length <= self.start + len(self.held)):
            self.file.seek(offset)
            self.start, self.held = offset, self.file.read(max(length, CHUNK))
        return self.held[offset - self.start : offset - self.start + length]


class Member:
    """One record: of a gzip member, or plain. ``until`` inflates no more than is asked for."""

    def __init__(self, source: Bytes, offset: int, gzipped: bool):
        self.source, self.offset, self.gzipped = source, offset, gzipped
        self.ready, self.next, self.inflater = b"", None, None
        self.place = offset
        if gzipped:
            flags = source.at(offset, 12)
            if flags[:3] != b"\x1f\x8b\x08":
                raise ValueError(f"no gzip member at byte {offset}")
            self.place = offset + 10
            if flags[3] & 4:
                (size,) = struct.unpack("<H", source.at(self.place, 2))
                extra = source.at(self.place + 2, size)
                self.place += 2 + size
                while len(extra) >= 4:
                    (length,) = struct.unpack("<H", extra[2:4])
                    if extra[:2] == b"sl" and length == 8:
                        self.next = offset + struct.unpack("<I", extra[4:8])[0]
                    extra = extra[4 + length :]
            for flag in (8, 16):
                if flags[3] & flag:
                    while source.at(self.place, 1) not in (b"\0", b""):
                        self.place += 1
                    self.place += 1
            self.place += 2 * bool(flags[3] & 2)
            self.inflater = zlib.decompressobj(-15)

    def more(self, size: int = 4096) -> bool:
        """Make more bytes ready; whether there were any."""
        if self.gzipped:
            while not self.inflater.eof:
                raw = self.inflater.unconsumed_tail or self.source.at(self.place, CHUNK)
                if not raw:
                    raise ValueError(f"the gzip member at byte {self.offset} ends too early")
                if not self.inflater.unconsumed_tail:
                    self.place += len(raw)
                out = self.inflater.decompress(raw, size)
                if self.inflater.eof and self.next is None:
                    self.next = self.place - len(self.inflater.unused_data) + 8
                if out:
                    self.ready += out
                    return True
            return False
        out = self.source.at(self.place, size)
        self.place += len(out)
        self.ready += out
        return bool(out)

    def head(self, start: int) -> int:
        """The end of the header block that starts at ``start``."""
        found = self.ready.find(BREAK, start)
        while found < 0:
            if len(self.ready) - start > MOST_HEADER or not self.more():
                raise ValueError(f"no end of headers in the record at byte {self.offset}")
            found = self.ready.find(BREAK, max(start, len(self.ready) - 4096 - 3))
        return found + 4

    def block(self, start: int, length: int) -> bytes:
        parts, have = [self.ready[start:]], len(self.ready) - start
        while have < length:
            self.ready = b""
            if not self.more(max(CHUNK, length - have)):
                raise ValueError(f"the record at byte {self.offset} is shorter than it says")
            parts.append(self.ready)
            have += len(self.ready)
        return b"".join(parts)[:length]

    def end(self, after: int, length: int) -> int:
        """Where the next record starts."""
        if not self.gzipped:
            return self.offset + after + length + 4
        while self.next is None:
            self.ready = b""
            self.more(CHUNK)
        return self.next


@dataclass
class Files(InputPartition):
    paths: list[tuple[str, int]]


class WarcReader(DataSourceReader):
    """Options: path; payload (true), bytes_per_partition (64 MB)."""

    def __init__(self, options: dict):
        self.path = options["path"]
        self.payload = options.get("payload", "true").lower() != "false"
        self.target = int(options.get("bytes_per_partition", 64 << 20))
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            name = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else None
            if name in FIELDS and isinstance(f, EqualTo):
                self.tests.append((name, "in", (f.value,)))
            elif name in FIELDS and isinstance(f, In):
                self.tests.append((name, "in", tuple(f.value)))
            elif name in FIELDS and isinstance(f, StringStartsWith):
                self.tests.append((name, "starts", f.value))
            elif name in FIELDS and isinstance(f, IsNotNull):
                self.tests.append((name, "there", None))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        store, root = filesystem(self.path)
        info = store.get_file_info(root)
        if info.type == fs.FileType.File:
            found = [info]
        else:
            listed = [i for i in store.get_file_info(fs.FileSelector(root, recursive=True)) if i.type == fs.FileType.File]
            kept = listed_files(store, root)
            found = [
                i
                for i in listed
                if i.base_name.endswith((".warc", ".warc.gz")) and (kept is None or i.base_name in kept)
            ]
        parts: list[InputPartition] = []
        held, size = [], 0
        for i in sorted(found, key=lambda i: i.path):
            if held and size + i.size > self.target:
                parts.append(Files(held))
                held, size = [], 0
            held.append((i.path, i.size))
            size += i.size
        return [*parts, Files(held)] if held or not parts else parts

    def passes(self, fields: dict[str, str]) -> bool:
        for name, how, value in self.tests:
            have = fields.get(FIELDS[name])
            if have is None or how == "in" and have not in value or how == "starts" and not have.startswith(value):
                return False
        return True

    def read(self, partition: Files) -> Iterator[tuple]:
        store, _ = filesystem(self.path)
        for path, size in partition.paths:
            with store.open_input_file(path) as file:
                source, offset, gzipped = Bytes(file, size), 0, path.endswith(".gz")
                while offset < size:
                    member = Member(source, offset, gzipped)
                    after = member.head(0)
                    fields = header_lines(member.ready[: after - 4])
                    length = int(fields.get("content-length", 0))
                    if self.passes(fields):
                        yield self.row(path, member, after, fields, length)
                    offset = member.end(after, length)

    def row(self, path: str, member: Member, after: int, fields: dict[str, str], length: int) -> tuple:
        http: dict[str, str] = {}
        start = after
        if fields.get("content-type", "").startswith("application/http") and length:
            start = member.head(after)
            http = header_lines(member.ready[after : start - 4])
        payload = None
        if self.payload and fields.get("warc-type") != "revisit":
            payload = member.block(start, length - (start - after))
        columns = [fields.get(FIELDS[c]) for c in FIELDS]
        return (path, member.offset, *columns, length, fields, http, payload)


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


def one_line(value: str) -> str:
    """A header value: control characters and blanks as %XX, since a line break would end the field."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record(row: dict, date: str, level: int) -> bytes:
    """One record as a gzip member with a skip length."""
    payload = row["payload"] or b""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {row['payload_bytes']}\r\n\r\n"
    ).encode()
    block = http if row["record_type"] == "revisit" else http + payload
    fields = [
        ("WARC-Type", row["record_type"]),
        ("WARC-Record-ID", row["record_id"]),
        ("WARC-Date", date),
        ("WARC-Target-URI", row["target_uri"]),
        ("WARC-Payload-Digest", row["payload_digest"]),
        ("WARC-Refers-To", row["refers_to"]),
        ("WARC-Profile", IDENTICAL if row["record_type"] == "revisit" else None),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {one_line(v) if k == 'WARC-Target-URI' else v}\r\n" for k, v in fields if v is not None)
    plain = head.encode() + b"\r\n" + block + BREAK
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(plain) + packer.flush()
    size = 10 + 2 + 12 + len(body) + 8
    tail = struct.pack("<II", zlib.crc32(plain), len(plain) & 0xFFFFFFFF)
    if size >= 1 << 32 or len(plain) >= 1 << 32:
        return b"\x1f\x8b\x08\x00\0\0\0\0\0\xff" + body + tail
    extra = b"sl" + struct.pack("<HII", 8, size, len(plain))
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + body + tail


class WarcWriter(DataSourceArrowWriter):
    """Options: path; max_file_bytes (256 MB), date (1970-01-01T00:00:00Z), level (6)."""

    def __init__(self, options: dict, overwrite: bool):
        self.path = options["path"]
        self.overwrite = overwrite
        self.most = int(options.get("max_file_bytes", 256 << 20))
        self.date = options.get("date", "1970-01-01T00:00:00Z")
        self.level = int(options.get("level", 6))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = filesystem(self.path)
        store.create_dir(root, recursive=True)
        files, out, size = [], None, 0
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    if out is None or size >= self.most:
                        if out:
                            out.close()
                        files.append(f"part-{uuid.uuid4().hex}.warc.gz")
                        out, size = store.open_output_stream(f"{root}/{files[-1]}", compression=None), 0
                    data = record(row, self.date, self.level)
                    out.write(data)
                    size += len(data)
        finally:
            if out:
                out.close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        store, root = filesystem(self.path)
        store.create_dir(root, recursive=True)
        before = set() if self.overwrite else listed_files(store, root) or set()
        names = before.union(*(m.files for m in messages if m))
        with store.open_output_stream(f"{root}/{MANIFEST}") as f:
            f.write(json.dumps(sorted(names)).encode())


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return READ_SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to the session and let it take filters."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def write_pages(pages: DataFrame, path: str, least: int = 100) -> None:
    """Write one record per page; of equal payloads of ``least`` bytes or more all but one are revisits.

    The page with the smallest page_id is the response. A null html is an empty payload, a null url leaves
    the target out. Rows that repeat the smallest page_id are responses too. Pages without a page_id get a
    record id without a number; they revisit a numbered page with the same payload, or else are responses.
    Other columns are not looked at. An empty table makes an archive without records.
    """
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("target_uri"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    )
    rows = rows.withColumns(
        {"digest": F.sha2("payload", 256), "payload_bytes": F.octet_length("payload").cast("bigint")}
    )
    # Map-side minima: a payload that a third of all pages share is one row per task here, and one row
    # on the right of the join, whose hot left partition the adaptive join splits.
    first = (
        rows.where(F.col("payload_bytes") >= least)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and first is not null")
        .select("digest", "first")
    )
    revisit = F.col("first").isNotNull() & (F.col("payload_bytes") >= least) & ~F.col("page_id").eqNullSafe(F.col("first"))

    def urn(number) -> F.Column:
        return F.concat(F.lit("<urn:page:"), number.cast("string"), F.lit(">"))

    out = rows.join(first, "digest", "left").select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.coalesce(urn(F.col("page_id")), F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">"))).alias("record_id"),
        "target_uri",
        F.concat(F.lit("sha256:"), "digest").alias("payload_digest"),
        "payload_bytes",
        F.when(revisit, urn(F.col("first"))).alias("refers_to"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )
    register(pages.sparkSession)
    out.write.format("warc").mode("append").save(path)


def page_number(column: str) -> F.Column:
    digits = F.regexp_extract(column, r"^<urn:page:(-?[0-9]+)>$", 1)
    return F.when(digits != "", digits).cast("bigint")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """One row per page record of an archive written by ``write_pages``.

    Responses are read with their payloads, which are counted and digested anew; revisits are read by
    their headers alone. Each of the two scans steps over the records of the other.
    """
    register(spark)
    load = spark.read.format("warc").load
    responses = load(path).where("record_type = 'response'").select(
        page_number("record_id").alias("page_id"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
        "record_type",
        F.lit(None).cast("bigint").alias("refers_to"),
        "target_uri",
    )
    revisits = load(path, payload="false").where("record_type = 'revisit'").select(
        page_number("record_id").alias("page_id"),
        F.col("http_headers")["content-length"].cast("bigint").alias("payload_bytes"),
        F.regexp_replace("payload_digest", "^sha256:", "").alias("payload_digest"),
        "record_type",
        page_number("refers_to").alias("refers_to"),
        "target_uri",
    )
    return responses.unionByName(revisits)


def warc_round_trip(pages: DataFrame) -> DataFrame:
    """Write an archive of the pages to the shared folder and read it back."""
    path = staging_path(pages.sparkSession, "warc")
    write_pages(pages, path)
    return read_pages(pages.sparkSession, path)
