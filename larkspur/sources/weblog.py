"""Access-log lines in the common log format."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.functions.numbers import log_time
from larkspur.sources.lines import captured, fits, part, with_parts

# The shape of a log line. The first form demands a third request field,
# the second takes any request, which is then cut at its blanks.
_CLIENT_AND_TIME = r'^(\S+) (\S+) (\S+).*\[([\w:/]+\s[+\-]\d{4})\] '
_CODE_AND_SIZE = r' (\d{3}) (\S+)'
STRICT_LINE = _CLIENT_AND_TIME + r'"(\S+) (\S*) (\S* *)"' + _CODE_AND_SIZE
ANY_REQUEST_LINE = _CLIENT_AND_TIME + r'"(\S+) ([ \S]*)"' + _CODE_AND_SIZE


def parse_log_lines(lines: DataFrame, strict: bool = False) -> DataFrame:
    """Add the log fields to text lines; ``status`` is 1 when parsed and 0 when not.

    A line fails when the pattern does not fit, the time is no time, or the size is
    neither ``-`` (taken as 0) nor a whole number.
    """
    groups = 9 if strict else 8
    pattern = STRICT_LINE if strict else ANY_REQUEST_LINE
    parts = with_parts(lines, captured(F.col("value"), pattern, groups))
    if strict:
        endpoint, protocol = part(6), F.rtrim(part(7))
    else:
        request = F.split(F.trim(part(6)), " +")
        endpoint = F.get(request, F.lit(0))
        protocol = F.when(F.size(request) > 1, F.element_at(request, -1))
    size = F.when(part(groups) == "-", F.lit(0)).otherwise(part(groups).try_cast("bigint"))
    fields = parts.select(
        "value",
        fits(groups).alias("fits"),
        part(1).alias("host"),
        part(2).alias("client_identd"),
        part(3).alias("user_id"),
        log_time(part(4)).alias("date_time"),
        part(5).alias("method"),
        endpoint.alias("endpoint"),
        F.nullif(protocol, F.lit("")).alias("protocol"),
        part(groups - 1).try_cast("int").alias("response_code"),
        size.alias("content_size"))
    parsed = (F.col("fits") & F.col("date_time").isNotNull()
              & F.col("content_size").isNotNull())
    return (fields
            .withColumn("status", F.coalesce(parsed, F.lit(False)).cast("int"))
            .drop("fits"))
