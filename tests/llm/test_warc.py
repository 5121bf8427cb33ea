"""WARC archives: exact round trips, predicates and skipped payloads."""

import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ledgerlift.llm import warc
from ledgerlift.llm.common import staging_path
from ledgerlift.llm.warc import Bytes, Member, WarcReader, read_pages, register, warc_round_trip, write_pages

SCHEMA = "page_id bigint, url string, html string"


def brute(rows):
    firsts = {}
    for page, _, html in rows:
        if len((html or "").encode()) >= 100 and page is not None:
            firsts[html] = min(page, firsts.get(html, page))
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        first = firsts.get(html) if len(raw) >= 100 else None
        again = first is not None and page != first and sum(h == html for _, _, h in rows) > 1
        out.append((page, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r)[:5] for r in df.collect()), key=str)


def test_round_trip_of_odd_pages(spark):
    long = "é<p>WARC/1.1\r\n\r\n" * 20000
    rows = [
        (5, "http://a/\r\nX: y z", "x" * 100),
        (3, None, "x" * 100),
        (9, "u", "x" * 100),
        (3, "again", "x" * 100),
        (1, "u", "x" * 99),
        (2, "u", "x" * 99),
        (None, None, None),
        (None, "q", "x" * 100),
        (None, "q", "y" * 200),
        (None, "q", "y" * 200),
        (4, "", ""),
        (6, "l", long),
        (7, "l", long),
    ]
    assert rows_of(warc_round_trip(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_empty_table_and_extra_columns(spark):
    assert warc_round_trip(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, "u", "h", "x", 3), (2, "u", None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA + ", digest string, first int")
    assert rows_of(warc_round_trip(df)) == brute([r[:3] for r in rows])


def test_filters_and_skips(spark, monkeypatch):
    rnd = random.Random(1)
    rows = [(i, f"http://h{i % 3}/{i}", "".join(rnd.choice("abc<> é") for _ in range(rnd.randrange(3000))) if i % 4 else "z" * 150) for i in range(200)]
    path = staging_path(spark, "t")
    write_pages(spark.createDataFrame(rows, SCHEMA), path)
    register(spark)
    load = spark.read.format("warc").load(path)
    assert load.count() == 200
    assert load.where("record_type = 'revisit'").count() == 49
    assert load.where(F.col("target_uri").startswith("http://h1/")).count() == sum(i % 3 == 1 for i in range(200))
    assert load.where(F.col("record_id").isin("<urn:page:7>", "<urn:page:8>")).count() == 2
    assert spark.read.format("warc").load(path, payload="false").where("payload is not null").count() == 0

    def decoded(reader):
        taken = []
        block = Member.block
        monkeypatch.setattr(Member, "block", lambda self, start, n: taken.append(n) or block(self, start, n))
        out = [r for p in reader.partitions() for r in reader.read(p)]
        monkeypatch.setattr(Member, "block", block)
        return len(out), len(taken)

    reader = WarcReader({"path": path})
    left = list(reader.pushFilters([warc.EqualTo(("record_type",), "revisit"), warc.EqualTo(("offset",), 3)]))
    assert len(left) == 1
    assert decoded(reader) == (49, 0)
    assert decoded(WarcReader({"path": path})) == (200, 151)
    write_pages(spark.createDataFrame([(1000, "u", "more")], SCHEMA), path)
    assert load.sparkSession.read.format("warc").load(path).count() == 201
    assert len(WarcReader({"path": path, "bytes_per_partition": "1"}).partitions()) >= 2


def test_archives_of_others(spark, tmp_path):
    def rec(kind, body):
        return f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:x>\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"

    records = [rec("warcinfo", b"a: b\r\n\r\n"), rec("resource", b"x" * 200000), rec("metadata", b"")]
    (tmp_path / "a.warc").write_bytes(b"".join(records))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in records))
    register(spark)
    got = spark.read.format("warc").load(str(tmp_path)).selectExpr("record_type", "length(payload) n").collect()
    assert sorted(map(tuple, got)) == sorted([("warcinfo", 8), ("resource", 200000), ("metadata", 0)] * 2)


def test_only_committed_files_count(spark):
    path = staging_path(spark, "t")
    write_pages(spark.createDataFrame([(1, "u", "h")], SCHEMA), path)
    store, root = warc.filesystem(path)
    with store.open_output_stream(f"{root}/part-lost.warc.gz", compression=None) as f:
        f.write(b"half a record")
    assert read_pages(spark, path).count() == 1


def test_broken_member():
    import io

    data = b"\x1f\x8b\x08\0\0\0\0\0\0\xff" + b"\x03"
    with pytest.raises(ValueError):
        Member(Bytes(io.BytesIO(data), len(data)), 0, True).head(0)
