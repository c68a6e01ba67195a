import base64
import hashlib
from collections import Counter

import pytest
from larkspur.llm import warc
from pyspark.sql import functions as F

ROWS = [(1, "http://a/1", "<p>same</p>"), (2, "http://a/2", "<p>same</p>"), (3, None, None),
        (4, "http://a/4\r\nX-Page-Id: 99", ""), (5, "http://é/5", "ü\r\n\r\nWARC-Type: x"),
        (2, "http://a/2", "<p>same</p>"), (None, "http://n", "<p>no id</p>"), (6, "u", "x" * 200000),
        (7, "u", "x" * 200000)]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame(ROWS, "page_id long, url string, html string").repartition(3)


def test_digest_by_definition(spark, pages):
    got = warc.record_digest(spark, pages).collect()
    assert len(got) == len(ROWS)
    largest = {}
    for i, _, html in ROWS:
        largest[html or ""] = max(largest.get(html or "", -1), -1 if i is None else i)
    for r in got:
        payload = next(h or "" for i, _, h in ROWS if i == r.page_id)
        assert r.payload_bytes == len(payload.encode())
        assert r.payload_digest == base64.b32encode(hashlib.sha1(payload.encode()).digest()).decode()
        if r.record_type == "revisit":
            assert r.refers_to == largest[payload]
        else:
            assert r.refers_to is None
            assert (-1 if r.page_id is None else r.page_id) == largest[payload]
    # One response of each payload, also among equal rows.
    assert sum(r.record_type == "response" for r in got) == len(largest)


def test_round_trip_through_files(spark, pages, tmp_path):
    warc.write(pages, str(tmp_path / "archive"))
    archive = warc.read(spark, str(tmp_path / "archive"))
    assert archive.payloads.count() == len({h or "" for _, _, h in ROWS})
    expected = Counter((i, u and u.replace("\r", "%0D").replace("\n", "%0A"), h or "")
                       for i, u, h in ROWS)
    assert Counter(map(tuple, warc.pages_of(archive).collect())) == expected


def test_records_are_well_formed(pages):
    rows = warc.records(warc.build(pages)).collect()
    assert len(rows) == len(ROWS) == len({r.record_id for r in rows})
    for r in rows:
        head, rest = bytes(r.record).split(b"\r\n\r\n", 1)
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n") and rest.endswith(b"\r\n\r\n")
        assert int(fields[b"Content-Length"]) == len(rest) - 4
        assert (b"WARC-Refers-To" in fields) == (fields[b"WARC-Type"] == b"revisit")
    named = {r.record_id for r in rows}
    for r in rows:
        for line in bytes(r.record).split(b"\r\n"):
            if line.startswith(b"WARC-Refers-To: "):
                assert line[16:].decode() in named


def test_damage_is_noticed(pages):
    archive = warc.build(pages)
    bad = archive.payloads.selectExpr("sha256", "CAST('other' AS BINARY) AS payload")
    with pytest.raises(Exception, match="damaged payload"):
        warc.pages_of(warc.Archive(archive.headers, bad)).collect()


def test_reading_a_record_finds_its_parts_and_a_wrong_length(pages):
    archive = warc.build(pages)
    built = {r.record_id: bytes(r.header) for r in archive.headers.collect()}
    whole = warc.records(archive)
    for r in whole.select("record_id", "record", warc.read_record(F.col("record")).alias("r")
                          ).collect():
        assert bytes(r.r.header) == built[r.record_id]
        assert bytes(r.record) == bytes(r.r.header) + bytes(r.r.payload) + b"\r\n\r\n"
    cut = F.expr("substring(record, 1, octet_length(record) - 5)")
    for bad in (cut, F.concat(F.col("record"), F.lit("\r\n\r\n").cast("binary"))):
        with pytest.raises(Exception, match="does not have its length"):
            whole.select(warc.read_record(bad).alias("r")).collect()


def test_small_payloads_are_all_responses_and_empty_tables_pass(spark, pages):
    kinds = warc.build(pages, least_bytes=100).headers.select(
        warc.header_field("WARC-Type").alias("kind")).groupBy("kind").count().collect()
    assert {r.kind: r["count"] for r in kinds} == {"response": len(ROWS) - 1, "revisit": 1}
    assert warc.record_digest(spark, pages.filter("false")).collect() == []
