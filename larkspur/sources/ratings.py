"""Rating and movie lines with ``::`` between fields."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.sources.lines import PARSED, part, with_parts

FAILED = 0
FIELD_SEPARATOR = "::"


def _fields(lines: DataFrame) -> DataFrame:
    return with_parts(lines, F.split("value", FIELD_SEPARATOR))


def _with_status(df: DataFrame, *required: str) -> DataFrame:
    complete = F.lit(True)
    for name in required:
        complete = complete & F.col(name).isNotNull()
    return df.withColumn("status", F.when(complete, PARSED).otherwise(FAILED))


def parse_rating_lines(lines: DataFrame) -> DataFrame:
    """``user``, ``movie``, ``rating`` from user::movie::rating::time. Status 1 or 0."""
    fields = _fields(lines).select("value", part(1).try_cast("int").alias("user"),
                                   part(2).try_cast("int").alias("movie"),
                                   part(3).try_cast("double").alias("rating"))
    return _with_status(fields, "user", "movie", "rating")


def parse_movie_lines(lines: DataFrame) -> DataFrame:
    """``movie``, ``title`` from movie::title::genres. Status 1 or 0."""
    fields = _fields(lines).select("value", part(1).try_cast("int").alias("movie"),
                                   part(2).alias("title"))
    return _with_status(fields, "movie", "title")
