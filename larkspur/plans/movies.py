"""Movie reports and the recommender."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from larkspur.functions.text import text_sort_key
from larkspur.operators.counting import top
from larkspur.operators.ratings import mean_rating, rating_stats, titled_stats
from larkspur.session import shared_folder

# Factorisation settings and the thresholds of the two movie lists.
RANKS, ITERATIONS, REGULARISATION, SEED = (4, 8, 12), 5, 0.1, 5
POPULAR_ABOVE, RECOMMENDED_ABOVE = 500, 75

#: Blocks of users and of movies, and ratings that a block takes on average before there are more
#: blocks. Factors start per block, so the result depends on the number of blocks; it follows from
#: the ratings alone, and is never taken from the cluster.
BLOCKS, BLOCK_RATINGS = 10, 5_000_000

#: Rounds after which the factors are written to the shared folder, where one is named.
CHECKPOINT_EVERY = 2


def popular_movies(ratings: DataFrame, movies: DataFrame, more_than: int = POPULAR_ABOVE,
                   k: int = 20) -> DataFrame:
    """Best-rated movies among those with more than ``more_than`` ratings."""
    often = titled_stats(ratings, movies).filter(F.col("n") > more_than)
    return top(often, [F.desc("avg_rating"), F.desc("title"), F.desc("movie")], k)


def lowest_rated(ratings: DataFrame, movies: DataFrame, k: int = 3) -> DataFrame:
    """The first movies in ascending order of mean rating, title and count."""
    return top(titled_stats(ratings, movies),
               [F.asc("avg_rating"), F.asc("title"), F.asc("n"), F.asc("movie")], k)


def popular_by_text_key(ratings: DataFrame, movies: DataFrame, more_than: int = POPULAR_ABOVE,
                        k: int = 20) -> DataFrame:
    """As :func:`popular_movies`, but ordered by the text ``rating title``."""
    often = titled_stats(ratings, movies).filter(F.col("n") > more_than)
    keyed = often.withColumn("sort_key", text_sort_key(F.col("avg_rating"), F.col("title"), True))
    return top(keyed, [F.desc("sort_key"), F.desc("movie")], k)


def rating_blocks(train: DataFrame) -> int:
    """Into how many blocks users and movies are cut, so that no block has many more than
    ``BLOCK_RATINGS`` ratings: ``BLOCKS`` at least. The rows are counted in a read of their own."""
    return max(BLOCKS, -(-train.count() // BLOCK_RATINGS))


def fit(train: DataFrame, rank: int, iterations: int = ITERATIONS,
        regularisation: float = REGULARISATION, seed: int = SEED,
        blocks: int | None = None) -> ALSModel:
    """Alternating least squares on explicit ratings; unknown ids get no prediction.

    Users and movies are cut into ``blocks`` each, and every user block exchanges factors with
    every movie block. A task holds the ratings of one block and the factors they meet, so there
    are more for more ratings (:func:`rating_blocks`) where no number is given; the same number
    gives the same model.
    Every ``CHECKPOINT_EVERY`` rounds the factors are cut off from the rounds before them, so a
    lost executor repeats few of them.
    """
    blocks = blocks or rating_blocks(train)
    every = CHECKPOINT_EVERY if shared_folder(train.sparkSession) else -1
    return ALS(rank=rank, maxIter=iterations, regParam=regularisation, seed=seed,
               numUserBlocks=blocks, numItemBlocks=blocks, checkpointInterval=every,
               userCol="user", itemCol="movie", ratingCol="rating", implicitPrefs=False,
               coldStartStrategy="drop").fit(train)


def predict(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """``user``, ``movie``, ``rating`` for every pair whose ids the model knows."""
    scored = model.transform(pairs.select("user", "movie"))
    return scored.select("user", "movie", F.col("prediction").cast("double").alias("rating"))


def model_error(model: ALSModel, actual: DataFrame) -> DataFrame:
    """Error of the model on rated pairs: ``n``, ``rmse``. The prediction is added to the
    rated row itself, so nothing has to be joined back."""
    error = F.col("prediction").cast("double") - F.col("rating")
    return model.transform(actual).agg(F.count("prediction").alias("n"),
                                       F.sqrt(F.avg(error * error)).alias("rmse"))


@dataclass(frozen=True)
class Selection:
    """Validation errors per rank, and the rank and model with the smallest one."""

    errors: DataFrame
    best_rank: int
    best_model: ALSModel


def select_rank(train: DataFrame, validation: DataFrame,
                ranks: Sequence[int] = RANKS, **settings) -> Selection:
    """Fit one model per rank and compare validation errors; the first minimum wins.

    The fits do not depend on each other and are submitted side by side, but fewer at a time the
    more blocks each has: what they keep of the ratings is bounded then, and one fit has tasks
    enough. Their inputs are kept until all are done. Only one error value per rank reaches the
    driver. ``settings`` are those of :func:`fit`.
    """
    spark = train.sparkSession
    train, validation = train.persist(), validation.persist()
    blocks = settings.pop("blocks", None)

    def evaluate(rank: int) -> tuple[ALSModel, Row]:
        model = fit(train, rank, blocks=blocks, **settings)
        return model, model_error(model, validation).first()

    try:
        blocks = blocks or rating_blocks(train)
        validation.count()
        with ThreadPool(max(1, len(ranks) * BLOCKS // max(BLOCKS, blocks))) as pool:
            results = pool.map(inheritable_thread_target(spark)(evaluate), ranks, chunksize=1)
    finally:
        train.unpersist()
        validation.unpersist()
    scored = [(error.rmse, position) for position, (_, error) in enumerate(results)
              if error.rmse is not None]
    if not scored:
        raise ValueError("no validation row could be predicted")
    best = min(scored)[1]
    rows = [(rank, error.n, error.rmse) for rank, (_, error) in zip(ranks, results)]
    errors = spark.createDataFrame(rows, "rank int, n bigint, rmse double")
    return Selection(errors, ranks[best], results[best][0])


def recovery(train: DataFrame, validation: DataFrame, held_out: DataFrame,
             ranks: Sequence[int] = RANKS, **settings) -> DataFrame:
    """How well a model fitted on noisy ratings finds known values behind them.

    The rank is chosen on ``validation``. ``held_out`` has ``user``, ``movie`` and ``known``; its
    pairs are in neither other part. One row: ``n``, the pairs with a prediction; ``model_rmse``
    and ``mean_rmse``, the errors of the model and of the mean of ``train`` against ``known`` over
    those pairs; ``smallest_chosen``, whether no rank has a smaller validation error.
    """
    chosen = select_rank(train, validation, ranks, **settings)
    own = F.max(F.when(F.col("rank") == chosen.best_rank, F.col("rmse")))
    smallest = chosen.errors.agg((own <= F.min("rmse")).alias("smallest")).scalar()
    off = F.col("prediction").cast("double") - F.col("known")
    by_mean = mean_rating(train) - F.col("known")
    return chosen.best_model.transform(held_out).agg(
        F.count("prediction").alias("n"), F.sqrt(F.avg(off * off)).alias("model_rmse"),
        F.sqrt(F.avg(by_mean * by_mean)).alias("mean_rmse")
    ).withColumn("smallest_chosen", smallest)


def with_new_user(train: DataFrame, new_ratings: DataFrame) -> DataFrame:
    """Training rows plus a new user's ratings, as a bag."""
    return train.select("user", "movie", "rating").unionByName(
        new_ratings.select(F.col("user").cast("int"), F.col("movie").cast("int"),
                           F.col("rating").cast("double")))


def recommendable(rated: DataFrame, ratings: DataFrame, movies: DataFrame,
                  more_than: int = RECOMMENDED_ABOVE) -> DataFrame:
    """Movies outside ``rated`` with more than ``more_than`` ratings, and their number ``n``."""
    seen = rated.select("movie").distinct()
    # The count filter goes first: it is the smaller side of every later step.
    often = rating_stats(ratings).filter(F.col("n") > more_than).select("movie", "n")
    return movies.join(often, "movie").join(seen, "movie", "left_anti")


def recommendations(model: ALSModel, user: int, rated: DataFrame, ratings: DataFrame,
                    movies: DataFrame, more_than: int = RECOMMENDED_ABOVE,
                    k: int = 20) -> DataFrame:
    """Best predictions for ``user`` among movies they have not rated and that have more
    than ``more_than`` ratings: ``rank``, ``movie``, ``prediction``, ``title``, ``n``."""
    unrated = recommendable(rated, ratings, movies, more_than)
    predicted = model.transform(unrated.withColumn("user", F.lit(user).cast("int")))
    listed = predicted.select("movie", F.col("prediction").cast("double").alias("prediction"),
                              "title", "n")
    return top(listed, [F.desc("prediction"), F.asc("movie")], k)
