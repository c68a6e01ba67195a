import datetime

import pytest

from larkspur.plans import traffic


@pytest.fixture(scope="module")
def logs(spark):
    rows = []
    for month, day, hour, host, endpoint, code, size in [
            (8, 1, 0, "a", "/x", 200, 10), (8, 1, 1, "a", "/x", 200, 11),
            (8, 1, 1, "b", "/y", 404, 0), (9, 1, 5, "a", "/y", 404, 0),
            (8, 3, 5, "c", "/z", 500, 4)]:
        rows.append((host, datetime.datetime(1995, month, day, hour), endpoint, code, size))
    return spark.createDataFrame(
        rows, "host string, date_time timestamp_ntz, endpoint string, response_code int,"
              " content_size bigint").cache()


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_sizes_use_whole_division(logs):
    assert rows(traffic.content_size_stats(logs)) == [(5, 0, 11)]


def test_empty_log_has_no_mean(logs):
    assert rows(traffic.content_size_stats(logs.limit(0))) == [(None, None, None)]


def test_response_codes(logs):
    got = {r.response_code: (r.n, r.share, r.label)
           for r in traffic.response_code_share(logs).collect()}
    assert got == {200: (2, 0.4, "40.0"), 404: (2, 0.4, "40.0"), 500: (1, 0.2, "20.0")}


def test_hosts(logs):
    assert rows(traffic.frequent_hosts(logs, 2)) == [("a", 3)]
    assert sorted(rows(traffic.frequent_hosts(logs, 0, None))) == [("a", 3), ("b", 1), ("c", 1)]


def test_days_by_month_day_and_by_date(logs):
    assert sorted(rows(traffic.daily_hosts(logs))) == [(1, 4, 2, 2), (3, 1, 1, 1)]
    assert rows(traffic.first_days(traffic.daily_hosts(logs), 1)) == [(1, 4, 2, 2)]
    dates = sorted(rows(traffic.daily_hosts(logs, full_date=True)))
    assert [d[0].isoformat() for d in dates] == ["1995-08-01", "1995-08-03", "1995-09-01"]


def test_not_found(logs):
    missing = traffic.not_found(logs)
    assert rows(traffic.requests_by_day(missing)) == [(1, 2)]
    assert rows(traffic.requests_by_hour(missing)) == [(1, 1), (5, 1)]
    assert rows(traffic.some_endpoints(missing)) == [("/y",)]
    assert rows(traffic.busiest_days(missing)) == [(1, 2, 1)]
    assert rows(traffic.top_endpoints(traffic.failed(logs), 1)) == [("/y", 2, 1)]
    assert rows(traffic.series_bounds(traffic.requests_by_hour(missing), "hour", "n")) == [
        (1, 5, 1)]


def test_a_month_of_31_days_keeps_them_all(spark):
    rows = [("h", datetime.datetime(1995, 7, d, 1), "/", 200, 1) for d in range(1, 32)]
    month = spark.createDataFrame(rows, "host string, date_time timestamp_ntz, endpoint string, "
                                        "response_code int, content_size bigint")
    days = traffic.first_days(traffic.daily_hosts(month)).collect()
    assert [r.day for r in days] == list(range(1, 32))
