"""Product records and lists of known matches, both as loosely quoted CSV lines.

Splitting follows greedy patterns rather than CSV quoting, so ``spark.read.csv`` would
cut differently at embedded commas and quotes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.functions.text import remove_quotes
from larkspur.sources.lines import HEADER, PARSED, captured, fits, part, with_parts

FAILED = -1
# Line shapes and the first field of each header line.
PRODUCT_LINE = '^(.+),"(.+)",(.*),(.*),(.*)'
MATCH_LINE = "^(.+),(.+)"
PRODUCT_HEADER = '"id"'
MATCH_HEADER = '"idAmazon"'


def _parse(lines: DataFrame, pattern: str, groups: int, header: str) -> DataFrame:
    parts = with_parts(lines, captured(F.col("value"), pattern, groups))
    status = (F.when(~fits(groups), F.lit(FAILED))
              .when(part(1) == header, F.lit(HEADER))
              .otherwise(F.lit(PARSED)))
    return parts.withColumn("status", status)


def parse_product_lines(lines: DataFrame, header: str = PRODUCT_HEADER) -> DataFrame:
    """``id`` without quotes and ``product`` = title, description, manufacturer joined
    by blanks (their own quotes kept, price dropped). Status 1, 0 header, -1 failed."""
    return _parse(lines, PRODUCT_LINE, 5, header).select(
        "value", "status", remove_quotes(part(1)).alias("id"),
        F.concat_ws(" ", part(2), part(3), part(4)).alias("product"))


def parse_match_lines(lines: DataFrame, header: str = MATCH_HEADER) -> DataFrame:
    """Pairs of ids, cut at the last comma, quotes removed. Status as above."""
    return _parse(lines, MATCH_LINE, 2, header).select(
        "value", "status", remove_quotes(part(1)).alias("left_id"),
        remove_quotes(part(2)).alias("right_id"))
