"""Rating statistics, deterministic splitting and error measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rating_stats(ratings: DataFrame) -> DataFrame:
    """Number and mean of ratings per movie."""
    return ratings.groupBy("movie").agg(F.count("rating").alias("n"),
                                        F.avg("rating").alias("avg_rating"))


def titled_stats(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Rating statistics with titles; movies without ratings drop out.

    Aggregated before the join, so each movie meets at most one statistics row.
    """
    return (rating_stats(ratings).join(movies, "movie")
            .select("movie", "avg_rating", "title", "n"))


def _fraction(keys: Sequence[str], seed: int) -> Column:
    digest = F.md5(F.concat_ws("::", F.lit(str(seed)), *(F.col(k).cast("string") for k in keys)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(float(1 << 32))


def split_rows(df: DataFrame, weights: Sequence[float], keys: Sequence[str],
               seed: int = 0, name: str = "part") -> DataFrame:
    """Number the rows with the part (from 0) they belong to, in proportion to ``weights``.

    The part is a function of the key values and the seed alone, so it does not change
    with partitioning or when a task runs again.
    """
    place = _fraction(keys, seed)
    total, reached = float(sum(weights)), 0.0
    part = F.lit(len(weights) - 1)
    bounds = []
    for weight in weights[:-1]:
        reached += weight / total
        bounds.append(reached)
    for i in reversed(range(len(bounds))):
        part = F.when(place < bounds[i], F.lit(i)).otherwise(part)
    return df.withColumn(name, part)


def random_parts(df: DataFrame, weights: Sequence[float], seed: int = 0) -> list[DataFrame]:
    """Spark's own seeded random split; membership depends on the partitioning."""
    return df.randomSplit([float(w) for w in weights], seed)


def rmse(predicted: DataFrame, actual: DataFrame, keys: Sequence[str] = ("user", "movie"),
         value: str = "rating") -> DataFrame:
    """Root mean squared error over the inner join on ``keys``: ``n``, ``rmse``.

    Repeated keys count once per joined pair. Instead of building those pairs, each side
    is reduced to count, mean and spread per key; for n values p and m values a of one
    key, the squared differences add up to n*m*(mean p - mean a)^2 + m*SS(p) + n*SS(a).
    NULL when nothing joins.
    """
    def reduced(df: DataFrame, tag: str) -> DataFrame:
        return df.groupBy(*keys).agg(
            F.count(value).alias(f"n_{tag}"), F.avg(value).alias(f"mean_{tag}"),
            (F.var_pop(value) * F.count(value)).alias(f"ss_{tag}"))

    both = reduced(predicted, "p").join(reduced(actual, "a"), list(keys))
    n_p, n_a = F.col("n_p"), F.col("n_a")
    gap = F.col("mean_p") - F.col("mean_a")
    squared = n_p * n_a * gap * gap + n_a * F.col("ss_p") + n_p * F.col("ss_a")
    pairs = F.coalesce(F.sum(n_p * n_a), F.lit(0))
    return both.agg(pairs.alias("n"), F.sqrt(F.try_divide(F.sum(squared), pairs)).alias("rmse"))


def mean_rating(ratings: DataFrame) -> Column:
    """The overall mean as a scalar to use inside another DataFrame."""
    return ratings.agg(F.avg("rating").alias("mean")).scalar()


def mean_baseline(train: DataFrame, test: DataFrame) -> DataFrame:
    """Error of predicting the training mean for every test row: ``mean``, ``n``, ``rmse``."""
    mean = mean_rating(train)
    error = F.col("rating") - mean
    return test.agg(F.count("rating").alias("n"), F.sqrt(F.avg(error * error)).alias("rmse")
                    ).withColumn("mean", mean)
