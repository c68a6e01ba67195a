"""Counting, ranking, distinct values and set comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def count_by(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    """Rows per key. Partial counts are combined before the shuffle, so a hot key
    sends one row per task."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def total_rows(df: DataFrame) -> Column:
    """The row count of ``df`` as a scalar to use inside another DataFrame."""
    return df.agg(F.count(F.lit(1)).alias("n")).scalar()


def top(df: DataFrame, order: Sequence[Column], k: int, rank: str | None = "rank") -> DataFrame:
    """The first ``k`` rows in a total order, with their rank.

    The limit is taken first (per-task heaps), so the ranking window sees k rows.
    """
    best = df.orderBy(*order).limit(k)
    if rank is None:
        return best
    return best.withColumn(rank, F.row_number().over(Window.orderBy(*order)))


def top_by_count(df: DataFrame, key: str, k: int, name: str = "n") -> DataFrame:
    """The ``k`` most frequent values of ``key``; ties are broken by the key itself."""
    return top(count_by(df, key, name=name), [F.desc(name), F.asc(key)], k)


def distinct_count(df: DataFrame, column: str, name: str) -> DataFrame:
    """Exact number of distinct non-null values."""
    return df.agg(F.count_distinct(column).alias(name))


def with_share(counts: DataFrame, count: str = "n", share: str = "share") -> DataFrame:
    """Each count as a fraction of the sum of all counts."""
    whole = counts.agg(F.sum(count).alias("whole")).scalar()
    return counts.withColumn(share, F.col(count).cast("double") / whole)


def exclude_words(df: DataFrame, column: str, words: DataFrame) -> DataFrame:
    """Rows whose ``column`` is not in the one-column frame ``words``."""
    word = words.columns[0]
    listed = words.select(F.col(word).alias(column)).distinct()
    return df.join(listed, column, "left_anti")


def grouped_values(df: DataFrame, key: str, value: str, within: str) -> DataFrame:
    """All values of a key, as one array per (key, within).

    ``within`` is a column that bounds the size of an array (the document or day a
    value comes from). A key that holds a large part of all rows is thereby spread
    over many rows and tasks instead of being gathered into one.

    Equal values (as grouping compares them) are counted first; a list then has an entry for each
    different value, which is repeated when the array is made. Where ``df`` is placed by
    ``within``, neither step shuffles.
    """
    counted = df.groupBy(key, within, value).agg(F.count(value).alias("value_times"))
    entries = F.array_sort(F.collect_list(F.struct(
        F.col(value).alias("value"), F.col("value_times").cast("int").alias("times"))))
    repeated = F.transform(entries, lambda e: F.array_repeat(e.value, e.times))
    return counted.groupBy(key, within).agg(F.flatten(repeated).alias("values"))


def sum_grouped_values(grouped: DataFrame, key: str) -> DataFrame:
    """Sum of the values in every array of :func:`grouped_values`, per key."""
    inner = F.aggregate("values", F.lit(0).cast("bigint"), lambda total, v: total + v)
    return grouped.groupBy(key).agg(F.sum(inner).alias("total"))


def multiset_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows by which two frames differ: value, and copies on the left minus copies on
    the right. Empty when the two hold the same rows the same number of times."""
    columns = left.columns
    counted = (left.withColumn("surplus", F.lit(1))
               .unionByName(right.withColumn("surplus", F.lit(-1))))
    return (counted.groupBy(*columns).agg(F.sum("surplus").alias("surplus"))
            .filter(F.col("surplus") != 0))


def equal_width_histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Counts in ``bins`` equal slices between minimum and maximum, the last one closed.

    Columns: ``bin`` (from 0), ``n``. Empty bins are left out; nulls count as the lowest value.

    Equal values are counted first. Bounds and bins are then both taken from these counts, so
    ``df`` itself is worked out once, and what the second pass reads has a row per distinct value.
    """
    counts = count_by(df.select(F.col(column).alias("v")), "v")
    # Naming the count keeps it in this aggregate, which makes its shuffle the same as the one below.
    seen = F.when(F.col("n") > 0, F.col("v"))
    bounds = counts.agg(F.struct(F.min(seen).alias("low"), F.max(seen).alias("high"))).scalar()
    low, high = bounds.getField("low"), bounds.getField("high")
    place = F.floor(F.try_divide(F.col("v") - low, high - low) * bins)
    bin_number = F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)).cast("int")
    return (counts.select(bin_number.alias("bin"), "n").groupBy("bin")
            .agg(F.sum("n").alias("n")))
