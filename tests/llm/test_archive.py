"""op2: records, headers, digests and files."""

import gzip
import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from llm.shared import rows
from tallyline.llm import warc
from tallyline.session import run_dir

LONG = "<p>" + "x" * 200 + "</p>"
PAGES = [(3, "http://c/", LONG), (1, "http://a/", LONG), (1, "http://a/", LONG), (2, None, "short"), (4, "http://d/\r\nX: y", "short"),
         (5, "http://e/", None), (None, "http://n/", LONG), (None, None, "é" * 60), (7, "http://g/", "WARC/1.1\r\n\r\n" * 20)]


def archive(spark, pages):
    path = run_dir(spark, "test-archive")
    df = spark.createDataFrame([(*p, "extra") for p in pages], "page_id long, url string, html string, digest string")
    warc.write_archive(df, path)
    return path


def test_records(spark):
    path = archive(spark, PAGES)
    got = warc.read_archive(spark, path)
    digest = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    want = []
    for i, (page, _, html) in enumerate(PAGES):
        size = len((html or "").encode())
        first = i == 1 or size < 100 or html != LONG
        want.append((page, size, digest(html), "response" if first else "revisit", None if first else 1))
    assert rows(got, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == sorted(want, key=repr)
    assert spark.read.parquet(f"{path}/payloads").count() == len({p[2] or "" for p in PAGES})
    for r in got.collect():
        head, _, body = bytes(r.record).partition(b"\r\n\r\n")
        assert body == (bytes(r.payload) if r.record_type == "response" else b"") + b"\r\n\r\n"
        assert f"Content-Length: {len(body) - 4}".encode() in head and b"\r\nX: y" not in head
    refers = {r.refers_to_record for r in got.collect()} - {None}
    assert refers <= {r.record_id for r in got.collect() if r.record_type == "response"}


def test_files_hold_the_records(spark):
    records = warc.read_archive(spark, archive(spark, PAGES))
    out = run_dir(spark, "test-warc")
    warc.write_warc_files(records, out)
    whole = b"".join(gzip.decompress(p.read_bytes()) for p in sorted(Path(out).glob("*.gz")))
    assert len(whole) == sum(len(r.record) for r in records.collect())
    assert all(bytes(r.record) in whole for r in records.collect())


def test_damage_is_found(spark):
    path = archive(spark, PAGES)
    bad = spark.read.parquet(f"{path}/payloads").withColumn("payload", F.concat("payload", F.lit(b"!")))
    other = run_dir(spark, "test-archive")
    bad.write.parquet(f"{other}/payloads")
    spark.read.parquet(f"{path}/headers").write.parquet(f"{other}/headers")
    with pytest.raises(Exception, match="does not have its digest"):
        warc.read_archive(spark, other).collect()


ODD = ["http://a/\u2028X-Page-Id: 777", "http://a/\u2029x\u0085y", "", None, "http://a/%0D%25 b", "\r\nX-Page-Id: 5\r\n\r\nWARC/1.1", "http://é/\x00\x1f\x7f%E2%80%A8",
       "\nWARC-Payload-Digest: sha256:" + "0" * 64, "http://plain/%41"]


def test_no_address_forges_a_field(spark):
    path = archive(spark, [(i, url, f"page {i}" if i % 2 else LONG) for i, url in enumerate(ODD)])
    for got in (warc.read_archive(spark, path), warc.parse_records(warc.read_archive(spark, path))):
        assert rows(got, "page_id", "url") == sorted(enumerate(ODD), key=repr)
        assert rows(got.where("record_type = 'revisit'"), "page_id", "refers_to") == [(i, 0) for i in (2, 4, 6, 8)]
    heads = [bytes(r.record).partition(b"\r\n\r\n")[0].decode() for r in warc.read_archive(spark, path).collect()]
    assert all(len(h.split("\r\n")) == len(h.splitlines()) for h in heads)
    assert any("WARC-Target-URI: http://plain/%41\r\n" in h for h in heads)


def test_fields_come_from_the_bytes(spark):
    records = warc.read_archive(spark, archive(spark, PAGES))
    parsed = warc.parse_records(records.withColumns({c: F.lit(None) for c in ("page_id", "url", "record_type", "refers_to")}))
    columns = ["page_id", "record_type", "refers_to", "payload_digest", "payload_bytes"]
    assert rows(parsed, *columns) == rows(records, *columns)
    assert rows(parsed.where("record_type = 'revisit'").select("body_bytes").distinct(), "body_bytes") == [(0,)]
    spoiled = records.withColumn("record", F.expr("concat(substring(record, 1, octet_length(record) - 5), X'21', X'0D0A0D0A')"))
    with pytest.raises(Exception, match="does not have the body"):
        warc.parse_records(spoiled).select("payload_digest").collect()


def test_no_pages(spark):
    assert warc.read_archive(spark, archive(spark, [])).count() == 0
