"""Reports over parsed access-log rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.functions.numbers import percent_label, whole_ratio
from larkspur.operators.counting import count_by, top, top_by_count, with_share

# The response codes the reports treat apart.
OK, NOT_FOUND = 200, 404


def content_size_stats(logs: DataFrame) -> DataFrame:
    """Whole-number mean, minimum and maximum size in bytes."""
    stats = logs.agg(F.sum("content_size").alias("total"), F.count("content_size").alias("n"),
                     F.min("content_size").alias("min_size"),
                     F.max("content_size").alias("max_size"))
    return stats.select(whole_ratio(F.col("total"), F.col("n")).alias("avg_size"),
                        "min_size", "max_size")


def response_code_share(logs: DataFrame) -> DataFrame:
    """Requests, share of all requests and chart label for every response code."""
    shares = with_share(count_by(logs, "response_code"))
    return shares.withColumn("label", percent_label(F.col("share") * 100))


def frequent_hosts(logs: DataFrame, more_than: int = 10, k: int | None = 20) -> DataFrame:
    """Hosts with more than ``more_than`` requests, the first ``k`` by name or all."""
    hosts = count_by(logs, "host").filter(F.col("n") > more_than)
    return hosts if k is None else hosts.orderBy("host").limit(k)


def endpoint_hits(logs: DataFrame) -> DataFrame:
    return count_by(logs, "endpoint")


def top_endpoints(logs: DataFrame, k: int = 10) -> DataFrame:
    return top_by_count(logs, "endpoint", k)


def failed(logs: DataFrame) -> DataFrame:
    """Requests that were not answered with 200."""
    return logs.filter(F.col("response_code") != OK)


def not_found(logs: DataFrame) -> DataFrame:
    return logs.filter(F.col("response_code") == NOT_FOUND)


def by_day(logs: DataFrame, full_date: bool = False) -> DataFrame:
    """Add ``day``: the day of the month (months fall together) or the full date."""
    day = F.to_date("date_time") if full_date else F.dayofmonth("date_time")
    return logs.withColumn("day", day)


def by_hour(logs: DataFrame) -> DataFrame:
    return logs.withColumn("hour", F.hour("date_time"))


def daily_hosts(logs: DataFrame, full_date: bool = False) -> DataFrame:
    """Requests, distinct hosts and whole requests per host for every day.

    Requests are first counted per (day, host), which shuffles on that pair after a
    partial count; a busy day is therefore spread over all its hosts.
    """
    per_host = count_by(by_day(logs, full_date), "day", "host")
    daily = per_host.groupBy("day").agg(F.sum("n").alias("requests"),
                                        F.count("host").alias("hosts"))
    return daily.withColumn("requests_per_host",
                            whole_ratio(F.col("requests"), F.col("hosts")))


def first_days(daily: DataFrame, k: int | None = None) -> DataFrame:
    """A per-day report in day order: all days, or the first ``k``."""
    ordered = daily.orderBy("day")
    return ordered if k is None else ordered.limit(k)


def requests_by_day(logs: DataFrame, full_date: bool = False) -> DataFrame:
    return count_by(by_day(logs, full_date), "day").orderBy("day")


def requests_by_hour(logs: DataFrame) -> DataFrame:
    return count_by(by_hour(logs), "hour").orderBy("hour")


def busiest_days(logs: DataFrame, k: int = 5) -> DataFrame:
    return top_by_count(by_day(logs), "day", k)


def series_bounds(series: DataFrame, key: str, value: str) -> DataFrame:
    """First and last key and the largest value of a chart series."""
    return series.agg(F.min(key).alias("first_key"), F.max(key).alias("last_key"),
                      F.max(value).alias("max_value"))


def distinct_endpoints(logs: DataFrame) -> DataFrame:
    return logs.select("endpoint").distinct()


def some_endpoints(logs: DataFrame, k: int = 40) -> DataFrame:
    """``k`` distinct endpoints, the first by name."""
    return top(distinct_endpoints(logs), [F.asc("endpoint")], k, rank=None)
