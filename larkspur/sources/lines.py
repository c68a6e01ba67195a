"""Text-line sources and the routing of parsed, header and failed lines."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from larkspur.session import materialised, release

PARSED, HEADER = 1, 0
SCAN_PARTITIONS = "spark.larkspur.scan.partitions"


def number_range(spark: SparkSession, stop: int, start: int = 0) -> DataFrame:
    """Whole numbers from ``start`` up to but excluding ``stop``, column ``id``."""
    return spark.range(start, stop)


def literal_rows(spark: SparkSession, rows: Iterable[Sequence], schema: str,
                 partitions: int | None = None) -> DataFrame:
    """Rows written in the program."""
    df = spark.createDataFrame(list(rows), schema)
    return df if partitions is None else df.repartition(partitions)


def read_lines(spark: SparkSession, path: str | list[str],
               partitions: int | None = None) -> DataFrame:
    """One row per line, column ``value``; ``.gz`` is decompressed by its extension.

    Plain files are split by size. A compressed file is read by one task, so pass the
    least number of ``partitions`` to spread the work after it.
    """
    lines = spark.read.text(path)
    return lines if partitions is None else spread(lines, partitions)


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Bring a scan to at least ``partitions``, or to as many as the session names in
    ``SCAN_PARTITIONS``, as one small or unsplittable file needs. Where neither is given, and
    for a larger scan, the frame comes back unchanged, without a shuffle."""
    wanted = partitions or int(df.sparkSession.conf.get(SCAN_PARTITIONS, "0"))
    return df.repartition(wanted) if wanted and df.rdd.getNumPartitions() < wanted else df


def captured(line: Column, pattern: str, groups: int) -> Column:
    """The captured parts of a line as one array, from a single match; an array of
    another size when the pattern does not fit. No part may be able to hold a line feed,
    which separates them."""
    joined = "\n".join(f"${i}" for i in range(1, groups + 1))
    return F.split(F.regexp_replace(line, rf"(?d){pattern}[\s\S]*", joined), "\n")


def with_parts(lines: DataFrame, parts: Column) -> DataFrame:
    """``value`` and ``part``, the array of a line's parts, worked out once per line.

    Exploding a one-element array keeps later filters from being pushed below this step,
    which would work the parts out again for every field a filter looks at.
    """
    return lines.select("value", F.explode(F.array(parts)).alias("part"))


def fits(groups: int) -> Column:
    """Whether :func:`captured` found a match in a proper line."""
    return (F.size("part") == groups) & ~F.contains("value", F.lit("\n"))


def part(i: int) -> Column:
    """The i-th captured part, counted from 1; NULL when there are fewer."""
    return F.get("part", F.lit(i - 1))


def read_words(spark: SparkSession, path: str) -> DataFrame:
    """A word list, one word per line, as distinct values of column ``word``."""
    return spark.read.text(path).select(F.col("value").alias("word")).distinct()


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("status") == PARSED).drop("value", "status")


def rejected(parsed: DataFrame, status: int) -> DataFrame:
    return parsed.filter(F.col("status") == status).select("value")


def ingest_counts(parsed: DataFrame, failed_status: int) -> DataFrame:
    """One row: lines read, parsed, header lines and failed lines, from a single pass."""
    header = F.lit(0).cast("bigint") if failed_status == HEADER else (
        F.count_if(F.col("status") == HEADER))
    return parsed.agg(
        F.count(F.lit(1)).alias("lines_read"),
        F.count_if(F.col("status") == PARSED).alias("lines_parsed"),
        header.alias("header_lines"),
        F.count_if(F.col("status") == failed_status).alias("lines_failed"))


def rejected_sample(parsed: DataFrame, status: int, k: int) -> DataFrame:
    """The first ``k`` failed lines in text order, for a report."""
    return rejected(parsed, status).orderBy("value").limit(k)


@dataclass(frozen=True)
class Ingest:
    """The parsed rows of one read, and the lines met in it: ``counts`` has ``lines_read``,
    ``lines_parsed``, ``header_lines`` and ``lines_failed``."""

    rows: DataFrame
    counts: dict[str, int]


def ingest_once(parsed: DataFrame, failed_status: int) -> Ingest:
    """Keep the parsed rows and count all lines while they pass by, in a single read of the input.

    The counts are metrics of the scan itself, so neither a count ahead of it nor a second read
    is needed. A task that is run again counts once.
    """
    seen = Observation()
    status = F.col("status")
    header = F.lit(0).cast("bigint") if failed_status == HEADER else F.count_if(status == HEADER)
    observed = parsed.observe(
        seen, F.count(F.lit(1)).alias("lines_read"),
        F.count_if(status == PARSED).alias("lines_parsed"), header.alias("header_lines"),
        F.count_if(status == failed_status).alias("lines_failed"))
    rows = materialised(accepted(observed))
    return Ingest(rows, seen.get)


def check_ingest(parsed: DataFrame, failed_status: int, headers: int = 0) -> DataFrame:
    """Return the parsed rows after checking that no line failed and that exactly
    ``headers`` header lines were seen; raise ``ValueError`` otherwise. Reads the input once."""
    done = ingest_once(parsed, failed_status)
    counts = done.counts
    if counts["lines_failed"] or counts["lines_read"] != counts["lines_parsed"] + headers:
        release(done.rows)
        raise ValueError(f"unexpected lines in input: {counts}")
    return done.rows
