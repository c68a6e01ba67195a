"""Named datasets: from a path to parsed rows, or to parsed and rejected lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from larkspur.sources import ratings, records
from larkspur.sources.lines import accepted, check_ingest, read_lines
from larkspur.sources.weblog import parse_log_lines


def load_log(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """All lines with their ``status``; see ``accepted``, ``rejected``, ``ingest_counts``."""
    return parse_log_lines(read_lines(spark, path), strict)


def load_products(spark: SparkSession, path: str) -> DataFrame:
    """Product records of a file with exactly one header line and no bad line."""
    return check_ingest(records.parse_product_lines(read_lines(spark, path)),
                        records.FAILED, headers=1)


def load_matches(spark: SparkSession, path: str) -> DataFrame:
    """Known matches of a file with exactly one header line and no bad line."""
    return check_ingest(records.parse_match_lines(read_lines(spark, path)),
                        records.FAILED, headers=1)


def load_ratings(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    return accepted(ratings.parse_rating_lines(read_lines(spark, path, partitions)))


def load_movies(spark: SparkSession, path: str) -> DataFrame:
    return accepted(ratings.parse_movie_lines(read_lines(spark, path)))
