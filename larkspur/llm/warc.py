"""A content-addressed WARC archive in two tables.

``payloads`` holds the bytes of every distinct payload once, under their SHA-256. ``headers``
holds a row per record with the exact bytes before the payload (WARC header block and HTTP
header), the digest, and what the record is about. The first of equal payloads (the one with the
largest page id) is a ``response`` record; the others are ``revisit`` records, which refer to it
and have no payload of their own. Records are rebuilt by joining the two tables; a payload whose
bytes do not have the digest they are stored under raises an error.
"""

from __future__ import annotations

import base64
import uuid
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from larkspur.session import shared_folder, stored

LEAST_BYTES = 0
DATE = "2024-01-01T00:00:00Z"
#: Fixed value of the WARC 1.1 standard: the profile of revisits by equal payload.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_LINE = "\r\n"


@dataclass(frozen=True)
class Archive:
    headers: DataFrame
    payloads: DataFrame


@F.pandas_udf(StringType())
def base32(digests: pd.Series) -> pd.Series:
    """Upper-case base32 of binary values."""
    return digests.map(lambda d: base64.b32encode(d).decode())


def _record_id(page: Column, url: Column, copy: Column, sha: Column) -> Column:
    """A URN that follows from the record: page, place among equal rows, payload."""
    h = F.md5(F.concat_ws("/", F.coalesce(page.cast("string"), F.lit("-")),
                          copy.cast("string"), sha, F.coalesce(url, F.lit("-"))))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _field(name: str, value: Column) -> Column:
    """One header line; nothing for a null. Line breaks in a value are percent-encoded."""
    text = F.replace(F.replace(value.cast("string"), F.lit("\r"), F.lit("%0D")),
                     F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), text, F.lit(_LINE)), F.lit(""))


def build(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> Archive:
    """The two tables for ``pages`` (``page_id``, ``url``, ``html``), not yet written.

    A null html is an empty payload, a null url leaves out the target field, and a null page id
    is smaller than all others. Every row is a record: rows equal in everything get records of
    their own, one of which is the response. Payloads under ``least_bytes`` are all responses.
    """
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url",
                        F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    about = rows.select("page_id", "url", F.sha2("payload", 256).alias("sha256"),
                        F.unhex(F.sha1("payload")).alias("sha1"),
                        F.octet_length("payload").cast("bigint").alias("bytes"))
    # Equal rows are counted before the shuffle and told apart afterwards.
    counted = about.groupBy(*about.columns).agg(F.count(F.lit(1)).alias("n"))
    place = F.struct(F.col("page_id").isNotNull().alias("has"), "page_id",
                     F.col("url").isNotNull().alias("named"), "url")
    first = counted.filter(F.col("bytes") >= least_bytes).groupBy("sha256").agg(
        F.max(place).alias("first"))
    records = (counted.join(first, "sha256", "left")
               .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n")))))
    is_first = F.col("first").isNull() | (place.eqNullSafe(F.col("first")) & (F.col("copy") == 1))
    records = (records.withColumn("is_response", is_first)
               .withColumn("record_id", _record_id(F.col("page_id"), F.col("url"),
                                                   F.col("copy"), F.col("sha256")))
               .withColumn("digest", base32("sha1")))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{_LINE}Content-Type: text/html; charset=utf-8{_LINE}"
                          "Content-Length: "), F.col("bytes").cast("string"),
                    F.lit(_LINE + _LINE))
    length = F.octet_length(http) + F.when(F.col("is_response"), F.col("bytes")).otherwise(0)
    kind = F.when(F.col("is_response"), "response").otherwise("revisit")
    revisit = ~F.col("is_response")
    header = F.concat(
        F.lit(f"WARC/1.1{_LINE}"), _field("WARC-Type", kind),
        _field("WARC-Record-ID", F.col("record_id")), _field("WARC-Date", F.lit(DATE)),
        _field("WARC-Target-URI", F.col("url")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        _field("WARC-Profile", F.when(revisit, REVISIT_PROFILE)),
        _field("WARC-Refers-To", F.when(revisit, _record_id(
            F.col("first.page_id"), F.col("first.url"), F.lit(1), F.col("sha256")))),
        _field("WARC-Refers-To-Target-URI", F.when(revisit, F.col("first.url"))),
        _field("X-Page-Id", F.col("page_id")),
        _field("X-Refers-To-Page-Id", F.when(revisit, F.col("first.page_id"))),
        _field("Content-Type", F.lit("application/http; msgtype=response")),
        _field("Content-Length", length), F.lit(_LINE), http)
    headers = records.select("record_id", header.cast("binary").alias("header"), "sha256")
    # One row of each payload writes it: one with its smallest page id and url. They are found
    # by the page, so equal payloads do not meet in one task. Only where that row itself is
    # repeated do its payloads have to meet.
    writers = counted.groupBy("sha256").agg(F.min(F.struct(place.alias("p"), "n")).alias("w"))
    writers = writers.select("sha256", F.col("w.p.page_id").alias("page_id"),
                             F.col("w.p.url").alias("url"), "w.n")
    own = rows.withColumn("sha256", F.sha2("payload", 256))
    kept = own.join(
        writers.hint("shuffle_hash"), own["page_id"].eqNullSafe(writers["page_id"])
        & own["url"].eqNullSafe(writers["url"]) & (own["sha256"] == writers["sha256"])
    ).select(own["sha256"], "payload", "n")
    payloads = kept.filter("n = 1").drop("n").union(
        kept.filter("n > 1").drop("n").dropDuplicates(["sha256"]))
    return Archive(headers, payloads)


def write(pages: DataFrame, folder: str, least_bytes: int = LEAST_BYTES) -> None:
    """Write both tables below ``folder``."""
    archive = build(pages, least_bytes)
    archive.headers.write.parquet(f"{folder}/headers")
    archive.payloads.write.option("compression", "zstd").parquet(f"{folder}/payloads")


def read(spark: SparkSession, folder: str) -> Archive:
    return Archive(spark.read.parquet(f"{folder}/headers"),
                   spark.read.parquet(f"{folder}/payloads"))


def verified(payloads: DataFrame) -> DataFrame:
    """``payloads`` after comparing every payload with the digest it is stored under."""
    fits = F.sha2("payload", 256) == F.col("sha256")
    return payloads.withColumn("sha256", F.when(fits, F.col("sha256")).otherwise(
        F.raise_error(F.concat(F.lit("damaged payload "), "sha256")).cast("string")))


def header_field(name: str) -> Column:
    """The value of a field of the WARC header block, which ends at the first empty line; null
    where the field is missing."""
    block = F.substring_index(F.decode("header", "utf-8"), _LINE + _LINE, 1)
    value = F.regexp_extract(block, rf"\r\n{name}: ([^\r\n]*)", 1)
    return F.when(F.contains(block, F.lit(f"{_LINE}{name}: ")), value)


def records(archive: Archive) -> DataFrame:
    """``record_id`` and ``record``: the exact bytes of every record, ready to be put one after
    another in a WARC file. A revisit ends after its HTTP header."""
    end = F.lit(_LINE + _LINE).cast("binary")
    response = header_field("WARC-Type") == "response"
    full = archive.headers.filter(response).join(verified(archive.payloads), "sha256").select(
        "record_id", F.concat("header", "payload", end).alias("record"))
    return full.union(archive.headers.filter(~response).select(
        "record_id", F.concat("header", end).alias("record")))


def pages_of(archive: Archive) -> DataFrame:
    """``page_id``, ``url`` and ``html`` of every record: revisits get their payload back."""
    return archive.headers.join(verified(archive.payloads), "sha256").select(
        header_field("X-Page-Id").cast("bigint").alias("page_id"),
        header_field("WARC-Target-URI").alias("url"),
        F.decode("payload", "utf-8").alias("html"))


def read_record(record: Column) -> Column:
    """What a reader finds in the bytes of one record: a struct of ``header`` (the bytes of the
    WARC header block with its empty line and the HTTP header) and ``payload`` (the bytes after
    them, without the record's end). A record whose ``Content-Length`` is not the number of bytes
    that follow its header block raises an error.
    """
    size = len(_LINE + _LINE)
    as_text = record.cast("string")
    block = F.octet_length(F.substring_index(as_text, _LINE + _LINE, 1)) + size
    head = F.octet_length(F.substring_index(as_text, _LINE + _LINE, 2)) + size
    total = F.octet_length(record)
    named = F.regexp_extract(F.substring_index(as_text, _LINE + _LINE, 1),
                             r"\r\nContent-Length: ([0-9]+)", 1).try_cast("bigint")
    whole = F.coalesce(named == total - block - size, F.lit(False)) & (
        F.right(as_text, F.lit(size)) == _LINE + _LINE)
    header = F.when(whole, F.substring(record, F.lit(1), head)).otherwise(
        F.raise_error(F.lit("a record does not have its length")).cast("binary"))
    return F.struct(header.alias("header"), F.substring(
        record, head + 1, total - head - size).alias("payload"))


def record_digest(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write the archive, read it back, rebuild every record, and describe it from its bytes.

    Payload size and digest of a response are those of the payload found in the record; a revisit
    has those of the record it refers to. Only sizes and digests, not bytes, meet the revisits, so
    a payload with many records is rebuilt once. A digest other than the one in the record's
    header, a wrong length and a revisit whose response is missing raise an error. Without a shared
    folder nothing can be written for all tasks; the records are then built from the two tables
    of the plan.
    """
    folder = shared_folder(spark)
    if folder:
        path = f"{folder.rstrip('/')}/warc-{uuid.uuid4().hex}"
        write(pages, path)
        archive = read(spark, path)
    else:
        archive = build(pages)
    # The records' bytes are read once, where they are rebuilt.
    parsed = records(archive).select("record_id", read_record(F.col("record")).alias("r"))
    about = parsed.select("record_id", "r.header", F.sha1("r.payload").alias("sha1"),
                          F.octet_length("r.payload").cast("bigint").alias("payload_bytes"))
    described = about.select(
        "record_id", "payload_bytes", base32(F.unhex("sha1")).alias("found"),
        header_field("WARC-Payload-Digest").alias("named"),
        header_field("WARC-Type").alias("record_type"),
        header_field("X-Page-Id").cast("bigint").alias("page_id"),
        header_field("WARC-Refers-To").alias("target"),
        header_field("X-Refers-To-Page-Id").cast("bigint").alias("refers_to"))
    described = stored(described)
    agreed = F.col("named") == F.concat(F.lit("sha1:"), "found")
    responses = described.filter("record_type = 'response'").select(
        "record_id", "page_id", "payload_bytes",
        F.when(agreed, F.col("found")).otherwise(F.raise_error(F.concat(
            F.lit("wrong digest in "), "record_id")).cast("string")).alias("payload_digest"))
    of = responses.select(F.col("record_id").alias("target"),
                          F.col("payload_bytes").alias("bytes"), "payload_digest")
    digest = F.when(F.col("named") == F.concat(F.lit("sha1:"), "payload_digest"),
                    F.col("payload_digest")).otherwise(F.raise_error(F.concat(
                        F.lit("nothing to refer to for "), "record_id")).cast("string"))
    revisits = described.filter("record_type = 'revisit'").drop("payload_bytes").join(
        of, "target", "left").select(
            "page_id", F.col("bytes").alias("payload_bytes"), digest.alias("payload_digest"),
            "record_type", "refers_to")
    return responses.select(
        "page_id", "payload_bytes", "payload_digest", F.lit("response").alias("record_type"),
        F.lit(None).cast("bigint").alias("refers_to")).union(revisits)
