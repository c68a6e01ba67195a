import math
import random
import time
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from larkspur.operators import ratings as rate
from larkspur.operators.lines import number_rows
from larkspur.functions.text import text_sort_key
from larkspur.plans import movies as film, tables
from larkspur.plans.registry import QUERIES

SCHEMA = "user int, movie int, rating double"
PREDICTED = [(1, 1, 5.), (1, 2, 3.), (1, 3, 4.), (2, 1, 3.), (2, 2, 2.), (2, 3, 4.)]
ACTUAL = [(1, 2, 3.), (1, 3, 5.), (2, 1, 5.), (2, 2, 1.)]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("predicted, expected", [
    (PREDICTED, 1.22474487139), ([(2, 2, 5.), (1, 2, 5.)], 3.16227766017), (ACTUAL, 0.0)])
def test_rmse(spark, predicted, expected):
    actual = frame(spark, ACTUAL)
    for a, b in ((frame(spark, predicted), actual), (actual, frame(spark, predicted))):
        assert abs(rate.rmse(a, b).first().rmse - expected) < 1e-8


def test_rmse_of_repeated_keys_counts_joined_pairs(spark):
    rng = random.Random(3)
    p = [(rng.randint(0, 3), 0, rng.random() * 5) for _ in range(40)]
    a = [(rng.randint(0, 3), 0, rng.random() * 5) for _ in range(30)]
    squares = [(x[2] - y[2]) ** 2 for x in p for y in a if x[:2] == y[:2]]
    row = rate.rmse(frame(spark, p), frame(spark, a)).first()
    assert row.n == len(squares)
    assert abs(row.rmse - math.sqrt(sum(squares) / len(squares))) < 1e-12


def test_rmse_without_a_common_key(spark):
    assert tuple(rate.rmse(frame(spark, ACTUAL), frame(spark, [(9, 9, 1.)])).first()) == (0, None)


def test_counts_and_means(spark):
    rows = ([(0, 1, float(r)) for r in (1, 2, 3, 4)] + [(0, 100, r) for r in (10., 20., 30.)]
            + [(0, 110, float(r)) for r in range(20)])
    stats = rate.rating_stats(frame(spark, rows))
    assert {r.movie: (r.n, r.avg_rating) for r in stats.collect()} == {
        1: (4, 2.5), 100: (3, 20.0), 110: (20, 9.5)}
    movies = spark.createDataFrame([(1, "x"), (100, "y"), (7, "z")], "movie int, title string")
    assert sorted(r.title for r in rate.titled_stats(frame(spark, rows), movies).collect()
                  ) == ["x", "y"]


def test_sorting_with_ties(spark):
    one = [(1, "alpha"), (2, "alpha"), (2, "beta"), (3, "alpha"), (1, "epsilon"), (1, "delta")]
    two = [(1, "delta"), (2, "alpha"), (2, "beta"), (3, "alpha"), (1, "epsilon"), (1, "alpha")]
    orders = []
    for rows in (one, two):
        df = spark.createDataFrame(rows, "k int, v string")
        keyed = df.withColumn("sort_key", text_sort_key(F.col("k"), F.col("v")))
        numbered = number_rows(keyed, [F.col("sort_key")], "position").orderBy("position")
        orders.append([(r.k, r.v) for r in numbered.collect()])
    assert orders[0] == orders[1] == sorted(one)


def test_popular_lists(spark):
    rows = [(u, m, r) for m, r, n in ((1, 5., 3), (2, 4., 4), (3, 4., 4), (4, 1., 9))
            for u, r in enumerate([r] * n)]
    movies = spark.createDataFrame([(m, t) for m, t in zip((1, 2, 3, 4), "abcd")],
                                   "movie int, title string")
    rated = frame(spark, rows)
    popular = film.popular_movies(rated, movies, more_than=3).orderBy("rank").collect()
    assert [r.title for r in popular] == ["c", "b", "d"]
    by_text = film.popular_by_text_key(rated, movies, more_than=3).orderBy("rank").collect()
    assert [r.sort_key for r in by_text] == ["4.0 c", "4.0 b", "1.0 d"]
    lowest = film.lowest_rated(rated, movies, 2).orderBy("rank").collect()
    assert [r.title for r in lowest] == ["d", "b"]


def test_split_depends_on_keys_only(spark):
    df = spark.range(20_000).select(F.col("id").cast("int").alias("user"),
                                    (F.col("id") % 7).cast("int").alias("movie"),
                                    F.lit(1.0).alias("rating"))
    parts = rate.split_rows(df, (6, 2, 2), ("user", "movie"))
    sizes = {r.part: r["count"] for r in parts.groupBy("part").count().collect()}
    assert sum(sizes.values()) == 20_000
    for part, share in ((0, .6), (1, .2), (2, .2)):
        assert abs(sizes[part] / 20_000 - share) < .02
    again = rate.split_rows(df.repartition(13), (6, 2, 2), ("user", "movie"))
    assert parts.exceptAll(again).isEmpty()
    assert not parts.exceptAll(rate.split_rows(df, (6, 2, 2), ("user", "movie"), 1)).isEmpty()
    assert sum(p.count() for p in rate.random_parts(df, [6, 2, 2], 0)) == 20_000


def test_mean_baseline(spark):
    row = rate.mean_baseline(frame(spark, [(1, 1, 2.), (1, 2, 4.)]),
                             frame(spark, [(2, 1, 3.), (2, 2, 5.)])).first()
    assert (row.mean, row.n) == (3.0, 2) and abs(row.rmse - math.sqrt(2)) < 1e-12


@pytest.fixture(scope="module")
def taste(spark):
    """Two groups of users with opposite taste."""
    rows = [(u, m, 5. if u % 2 == m % 2 else 1.) for u in range(40) for m in range(30)
            if (u * 7 + m * 3) % 5]
    return frame(spark, rows).cache()


def test_recommender(spark, taste):
    parts = rate.split_rows(taste, (6, 2, 2), ("user", "movie"))
    train, validation, test = (parts.filter(F.col("part") == i).drop("part") for i in range(3))
    chosen = film.select_rank(train, validation, (2, 4))
    errors = {r["rank"]: r.rmse for r in chosen.errors.collect()}
    assert errors[chosen.best_rank] == min(errors.values())
    error = film.model_error(chosen.best_model, test).first()
    assert error.n == test.count()
    assert error.rmse < rate.mean_baseline(train, test).first().rmse
    joined = rate.rmse(film.predict(chosen.best_model, test), test).first()
    assert abs(joined.rmse - error.rmse) < 1e-9


def test_recovery_tells_a_model_from_the_mean(spark, taste):
    parts = rate.split_rows(taste, (6, 2, 2), ("user", "movie"))
    train, validation, test = (parts.filter(F.col("part") == i).drop("part") for i in range(3))
    known = test.select("user", "movie", F.col("rating").alias("known"))
    row = film.recovery(train, validation, known, (2, 4)).first()
    assert row.n == test.count() and row.smallest_chosen
    assert row.model_rmse < row.mean_rmse / 2
    assert abs(row.mean_rmse - rate.mean_baseline(train, test).first().rmse) < 1e-9
    # Ratings without a structure: the known values are not found.
    blank = train.withColumn("rating", F.lit(3.0))
    assert film.recovery(blank, validation, known, (2,)).first().model_rmse > 1.5


def test_blocks_grow_with_the_ratings(spark, taste, monkeypatch):
    made, als = [], film.ALS
    monkeypatch.setattr(film, "ALS", lambda **settings: made.append(settings) or als(**settings))
    film.fit(taste, 2)
    monkeypatch.setattr(film, "BLOCK_RATINGS", 40)
    model = film.fit(taste, 2)
    film.fit(taste, 2, blocks=3)
    assert [x["numUserBlocks"] for x in made] == [film.BLOCKS, 24, 3]
    assert [x["numItemBlocks"] for x in made] == [film.BLOCKS, 24, 3]
    assert taste.count() == 24 * 40
    error = film.model_error(model, taste).first()
    assert error.n == taste.count() and error.rmse < .5


@pytest.mark.parametrize("block_ratings, at_once", [(1000, 3), (64, 2), (40, 1)])
def test_fits_hold_a_bounded_number_of_blocks(spark, taste, monkeypatch, block_ratings, at_once):
    running, most, fit = [], [], film.fit

    def counted(*parts, **settings):
        running.append(1)
        most.append(len(running))
        time.sleep(.5)
        model = fit(*parts, **settings)
        running.pop()
        return model

    monkeypatch.setattr(film, "fit", counted)
    monkeypatch.setattr(film, "BLOCK_RATINGS", block_ratings)
    chosen = film.select_rank(taste, taste, (1, 2, 3), iterations=1)
    assert max(most) == at_once
    assert [r["rank"] for r in chosen.errors.collect()] == [1, 2, 3]


def test_unknown_ids_get_no_prediction(spark, taste):
    model = film.fit(taste, 2)
    pairs = spark.createDataFrame([(0, 0), (0, 999), (999, 0)], "user int, movie int")
    assert [(r.user, r.movie) for r in film.predict(model, pairs).collect()] == [(0, 0)]


def test_recommendations_for_a_new_user(spark, taste):
    new = frame(spark, [(-1, m, 5. if m % 2 == 0 else 1.) for m in range(8)])
    both = film.with_new_user(taste, new)
    assert both.count() == taste.count() + 8
    movies = spark.range(31).select(F.col("id").cast("int").alias("movie"),
                                    F.concat(F.lit("m"), F.col("id")).alias("title"))
    listed = film.recommendations(film.fit(both, 4), -1, new, taste, movies, 10, 5)
    rows = listed.orderBy("rank").collect()
    assert len(rows) == 5
    assert all(r.movie >= 8 and r.movie % 2 == 0 and r.n > 10 for r in rows)
    assert [r.prediction for r in rows] == sorted((r.prediction for r in rows), reverse=True)


def test_new_user_jobs_write_the_ratings_once(spark, smallest_tables, monkeypatch):
    made, lines = [], tables.rating_lines
    monkeypatch.setattr(tables, "rating_lines", lambda *where: made.append(where) or lines(*where))
    monkeypatch.setattr(film, "select_rank", lambda *parts: SimpleNamespace(best_rank=2))
    for name in ("training_with_new_user", "new_user_test_rmse", "new_user_list_check"):
        made.clear()
        assert QUERIES[name](spark, smallest_tables).first() is not None
        assert len(made) == 1, name
