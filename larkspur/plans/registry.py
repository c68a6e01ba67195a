"""Every operator as a query over the given tables: name -> (session, folder) -> rows.

Floating-point results are rounded here, and only here, so that they can be compared.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larkspur.functions import vectors
from larkspur.functions.numbers import log_of_square
from larkspur.functions.text import (
    clean_text, numbered_line, pluralise, remove_quotes, sha1_of, text_sort_key, tokens)
from larkspur.operators import counting, quality, ratings as rate, similarity as sim
from larkspur.operators.lines import number_rows
from larkspur.plans import matching, movies as film, tables as t, traffic, words
from larkspur.session import stored
from larkspur.sources import ratings as rating_source, records as record_source
from larkspur.sources.lines import (
    accepted, ingest_counts, ingest_once, rejected, rejected_sample)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
# The given tables hold about 30 ratings per part, so the lists use lower thresholds.
POPULAR_ABOVE, RECOMMENDED_ABOVE, NEW_USER = 30, 25, -1
# The planted values have rank three.
PLANTED_RANKS = (2, 3, 4)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def doc_words(spark: SparkSession, folder: str, placed: bool = False) -> DataFrame:
    lines = words.cleaned_lines(t.document_lines(spark, folder, placed))
    return words.words_of(lines, carry=("doc_id",))


# -- numbers and lines ------------------------------------------------------------------

@query
def key_sums(spark, folder):
    """Sum of a whole-number column, and of its multiples of 7."""
    key = F.col("l_orderkey")
    sums = t.table(spark, folder, "lineitem").agg(
        F.sum(key).alias("total"), F.sum(F.when(key % 7 == 0, key)).alias("sevens"))
    return sums.select(F.inline(F.array(
        F.struct(F.lit("all").alias("which"), F.col("total").alias("total")),
        F.struct(F.lit("sevens").alias("which"), F.col("sevens").alias("total")))))


@query
def log_value_series(spark, folder):
    x = F.col("p_partkey") + 1
    return rounded(t.table(spark, folder, "part").select(
        x.alias("x"), log_of_square(x).alias("y")), "y")


@query
def value_digests(spark, folder):
    return t.table(spark, folder, "part").select(
        "p_partkey", sha1_of(F.col("p_partkey")).alias("digest"))


@query
def line_count(spark, folder):
    lines = F.size(F.split("text", "\n"))
    return t.documents(spark, folder).agg(
        F.sum(lines).cast("bigint").alias("lines"))


@query
def line_index(spark, folder):
    lines = t.document_lines(spark, folder)
    numbered = number_rows(lines, [F.col("doc_id"), F.col("line_no")])
    return numbered.select("index", "doc_id",
                           numbered_line(F.col("index"), F.col("value")).alias("line"))


@query
def clean_lines(spark, folder):
    return t.document_lines(spark, folder).select(
        "doc_id", "line_no", clean_text(F.col("value")).alias("cleaned"))


@query
def unquoted_text(spark, folder):
    return t.table(spark, folder, "pages").select(
        "page_id", remove_quotes(F.col("html")).alias("unquoted"))


# -- words ------------------------------------------------------------------------------

@query
def word_totals(spark, folder):
    return words.word_totals(words.cleaned_lines(t.document_lines(spark, folder)))


@query
def top_words(spark, folder):
    return words.top_words(t.document_lines(spark, folder), 15)


@query
def word_counts(spark, folder):
    return counting.count_by(doc_words(spark, folder), "word")


@query
def last_words(spark, folder):
    return words.last_words(t.document_lines(spark, folder), 5)


@query
def plural_words(spark, folder):
    """Distinct words, their plural and its length."""
    plural = doc_words(spark, folder).select("word").distinct().withColumn(
        "plural", pluralise(F.col("word")))
    return plural.withColumn("plural_length", F.length("plural"))


@query
def unique_words(spark, folder):
    return counting.distinct_count(doc_words(spark, folder), "word", "unique_words")


@query
def mean_count_per_word(spark, folder):
    return words.mean_count_per_word(doc_words(spark, folder))


def _grouped_words(spark, folder):
    ones = doc_words(spark, folder, placed=True).withColumn("one", F.lit(1))
    return counting.grouped_values(ones, "word", "one", within="doc_id")


@query
def words_grouped(spark, folder):
    return _grouped_words(spark, folder).select(
        "word", "doc_id", F.array_join("values", ",").alias("ones"))


@query
def word_group_sums(spark, folder):
    return counting.sum_grouped_values(_grouped_words(spark, folder), "word")


# -- access log -------------------------------------------------------------------------

@query
def log_parse(spark, folder):
    return t.logs(spark, folder)


@query
def log_rejects(spark, folder):
    return rejected(t.parsed_log(spark, folder), 0)


@query
def log_reject_sample(spark, folder):
    return rejected_sample(t.parsed_log(spark, folder), 0, 20)


@query
def log_strict_rejects(spark, folder):
    return rejected(t.parsed_log(spark, folder, strict=True), 0)


@query
def log_status_counts(spark, folder):
    return ingest_counts(t.parsed_log(spark, folder), failed_status=0)


@query
def log_ingest_metrics(spark, folder):
    """Lines counted while the log was read once, beside the rows that this read kept."""
    done = ingest_once(t.parsed_log(spark, folder), failed_status=0)
    return done.rows.agg(F.count(F.lit(1)).alias("rows_kept")).select(
        "rows_kept", *(F.lit(n).cast("bigint").alias(name) for name, n in done.counts.items()))


@query
def content_size_stats(spark, folder):
    return traffic.content_size_stats(t.logs(spark, folder))


@query
def response_code_share(spark, folder):
    return rounded(traffic.response_code_share(t.logs(spark, folder)), "share").drop("label")


@query
def response_code_labels(spark, folder):
    return traffic.response_code_share(t.logs(spark, folder)).select(
        "response_code", (F.col("label") != "").alias("labelled"),
        F.round(F.nullif("label", F.lit("")).cast("double"), 6).alias("percent"))


@query
def frequent_hosts(spark, folder):
    return traffic.frequent_hosts(t.logs(spark, folder), 10, 20)


@query
def endpoint_hits(spark, folder):
    return traffic.endpoint_hits(t.logs(spark, folder))


@query
def endpoint_series_bounds(spark, folder):
    return traffic.series_bounds(traffic.endpoint_hits(t.logs(spark, folder)), "endpoint", "n")


@query
def top_endpoints(spark, folder):
    return traffic.top_endpoints(t.logs(spark, folder), 10)


@query
def top_failed_endpoints(spark, folder):
    return traffic.top_endpoints(traffic.failed(t.logs(spark, folder)), 10)


@query
def failed_endpoint_count(spark, folder):
    return counting.distinct_count(traffic.failed(t.logs(spark, folder)), "endpoint", "endpoints")


@query
def unique_hosts(spark, folder):
    return counting.distinct_count(t.logs(spark, folder), "host", "hosts")


@query
def daily_unique_hosts(spark, folder):
    return traffic.first_days(traffic.daily_hosts(t.logs(spark, folder)).select("day", "hosts"))


@query
def avg_requests_per_host(spark, folder):
    daily = traffic.daily_hosts(t.logs(spark, folder))
    return traffic.first_days(daily.select("day", "requests_per_host"))


@query
def daily_hosts_by_date(spark, folder):
    return traffic.daily_hosts(t.logs(spark, folder), full_date=True)


@query
def not_found_count(spark, folder):
    return traffic.not_found(t.logs(spark, folder)).agg(F.count(F.lit(1)).alias("requests"))


@query
def not_found_endpoints(spark, folder):
    return traffic.some_endpoints(traffic.not_found(t.logs(spark, folder)), 40)


@query
def top_not_found_endpoints(spark, folder):
    return counting.top_by_count(traffic.not_found(t.logs(spark, folder)), "endpoint", 20)


@query
def top_not_found_hosts(spark, folder):
    return counting.top_by_count(traffic.not_found(t.logs(spark, folder)), "host", 25)


@query
def not_found_by_day(spark, folder):
    return traffic.requests_by_day(traffic.not_found(t.logs(spark, folder)))


@query
def top_not_found_days(spark, folder):
    return traffic.busiest_days(traffic.not_found(t.logs(spark, folder)), 5)


@query
def not_found_by_hour(spark, folder):
    return traffic.requests_by_hour(traffic.not_found(t.logs(spark, folder)))


# -- records, tokens and weights --------------------------------------------------------

@query
def product_ingest(spark, folder):
    return accepted(t.parsed_products(spark, folder))


@query
def product_status_counts(spark, folder):
    return ingest_counts(t.parsed_products(spark, folder), record_source.FAILED)


@query
def product_rejects(spark, folder):
    return rejected(t.parsed_products(spark, folder), record_source.FAILED)


@query
def gold_ingest(spark, folder):
    return accepted(t.parsed_matches(spark, folder))


@query
def gold_status_counts(spark, folder):
    return ingest_counts(t.parsed_matches(spark, folder), record_source.FAILED)


def _corpus(spark, folder):
    return matching.both_sides(t.left_records(spark, folder), t.right_records(spark, folder))


def _idf(spark, folder):
    return matching.token_idf(t.left_records(spark, folder), t.right_records(spark, folder),
                              t.STOPWORDS)


@query
def simple_tokens(spark, folder):
    return t.right_records(spark, folder).select(
        "id", F.array_join(tokens(F.col("text")), " ").alias("tokens"))


@query
def tokens_no_stop(spark, folder):
    return sim.record_tokens(t.right_records(spark, folder), t.STOPWORDS).select(
        "id", F.array_join("tokens", " ").alias("tokens"))


@query
def words_not_listed(spark, folder):
    """Counts of tokens that are not in a word list kept as a table (here: product words)."""
    listed = t.table(spark, folder, "part").select(
        F.explode(tokens(F.col("p_name"))).alias("word"))
    found = _corpus(spark, folder).select(F.explode(tokens(F.col("text"))).alias("token"))
    return counting.exclude_words(counting.count_by(found, "token"), "token", listed)


@query
def token_total(spark, folder):
    return sim.token_total(_corpus(spark, folder).withColumn("id", F.lit(0)), t.STOPWORDS)


@query
def biggest_record(spark, folder):
    return sim.biggest_record(t.right_records(spark, folder), t.STOPWORDS)


@query
def term_frequency(spark, folder):
    return rounded(sim.term_frequencies(t.right_records(spark, folder), t.STOPWORDS), "tf")


@query
def idf(spark, folder):
    return rounded(_idf(spark, folder), "idf")


@query
def lowest_idf(spark, folder):
    return rounded(matching.lowest_idf(_idf(spark, folder), 11), "idf")


@query
def idf_histogram(spark, folder):
    return matching.idf_histogram(_idf(spark, folder), 50)


def _weights(spark, folder):
    return sim.weights(sim.term_frequencies(t.right_records(spark, folder), t.STOPWORDS),
                       _idf(spark, folder))


@query
def tfidf_weights(spark, folder):
    return rounded(_weights(spark, folder), "weight")


@query
def vector_norms(spark, folder):
    return rounded(sim.norms(_weights(spark, folder)), "norm")


@query
def vector_maps(spark, folder):
    """Number of tokens and norm of every vector, worked out on its map."""
    return rounded(sim.vector_maps(_weights(spark, folder)).select(
        "id", F.size("vector").alias("tokens"), vectors.norm(F.col("vector")).alias("norm")), "norm")


@query
def posting_counts(spark, folder):
    """Length of every posting list of the inverted index."""
    return counting.count_by(sim.postings(_weights(spark, folder)), "token")


# -- matching ---------------------------------------------------------------------------

def _sides(spark, folder):
    return t.left_records(spark, folder), t.right_records(spark, folder)


def _vectors(spark, folder):
    return sim.build_vectors(*_sides(spark, folder), t.STOPWORDS)


@query
def inverted_similarity(spark, folder):
    """Distinct-text pairs that reach the first score bin, with their copies."""
    return rounded(sim.similar_pairs(_vectors(spark, folder), 0.01), "score")


@query
def record_copies(spark, folder):
    """Which vector stands for which record."""
    return sim.record_ids(t.right_records(spark, folder))


@query
def candidate_pairs(spark, folder):
    return sim.candidate_count(_vectors(spark, folder))


@query
def cartesian_summary(spark, folder):
    """Mean similarity over all left-right pairs."""
    return rounded(sim.records_summary(*_sides(spark, folder), t.STOPWORDS),
                   "sum_score", "mean_score")


def _assigned_pairs(spark, folder):
    """Every document with one passage, in turn."""
    left, right = _sides(spark, folder)
    return right.select((F.col("id") % counting.total_rows(left)).alias("left_id"),
                        F.col("id").alias("right_id"))


@query
def pair_similarity(spark, folder):
    scores = sim.pair_scores(_assigned_pairs(spark, folder), _vectors(spark, folder))
    return rounded(scores.drop("times"), "score")


@query
def pair_lookup(spark, folder):
    return rounded(sim.score_of(*_sides(spark, folder), 0, 0, t.STOPWORDS), "score")


@query
def text_pair_similarity(spark, folder):
    """Cosine of the two texts of every known match."""
    left, right = _sides(spark, folder)
    pairs = (t.gold(spark, folder)
             .join(left.select(F.col("id").alias("left_id"), F.col("text").alias("left_text")),
                   "left_id")
             .join(right.select(F.col("id").alias("right_id"), F.col("text").alias("right_text")),
                   "right_id")
             .withColumn("key", F.concat_ws(" ", F.col("left_id").cast("string"),
                                            F.col("right_id").cast("string"))))
    return rounded(sim.text_pair_scores(pairs, _idf(spark, folder), t.STOPWORDS), "score")


@query
def dup_similarity_avg(spark, folder):
    averages = quality.duplicate_averages(_vectors(spark, folder), *_sides(spark, folder),
                                          t.gold(spark, folder))
    return rounded(averages, "mean_score")


@query
def gold_scores(spark, folder):
    scores = matching.gold_scores(*_sides(spark, folder), t.gold(spark, folder), t.STOPWORDS)
    return rounded(scores.drop("times"), "score")


@query
def score_histogram(spark, folder):
    return matching.matching_quality(*_sides(spark, folder), t.gold(spark, folder),
                                     t.STOPWORDS)[0]


@query
def quality_curve(spark, folder):
    curve = matching.matching_quality(*_sides(spark, folder), t.gold(spark, folder),
                                      t.STOPWORDS)[1]
    return rounded(curve, "threshold", "precision", "recall", "f")


# -- ratings ----------------------------------------------------------------------------

@query
def ratings_ingest(spark, folder):
    return t.ratings(spark, folder)


@query
def rating_status_counts(spark, folder):
    parsed = rating_source.parse_rating_lines(t.rating_lines(spark, folder))
    return ingest_counts(parsed, rating_source.FAILED)


@query
def movies_ingest(spark, folder):
    return t.movies(spark, folder)


@query
def movies_with_title(spark, folder):
    """How many movies carry each title, for an equality filter on one of them."""
    return t.movies(spark, folder).filter(F.col("title") == "red widget").agg(
        F.count(F.lit(1)).alias("n"))


@query
def first_rating(spark, folder):
    """The first rating in movie order."""
    order = [F.asc("movie"), F.asc("user"), F.asc("rating")]
    return counting.top(t.ratings(spark, folder), order, 1, rank=None)


@query
def sort_by_key(spark, folder):
    """Position of every part in the order of its size."""
    parts = t.table(spark, folder, "part").select("p_size", "p_name", "p_partkey")
    return number_rows(parts, [F.col("p_size"), F.col("p_name"), F.col("p_partkey")], "position")


@query
def sort_by_text_key(spark, folder):
    """Position of every part in the text order of ``size name``."""
    parts = t.table(spark, folder, "part").select(
        "p_partkey", text_sort_key(F.col("p_size"), F.col("p_name")).alias("sort_key"))
    return number_rows(parts, [F.col("sort_key"), F.col("p_partkey")], "position")


@query
def movie_stats(spark, folder):
    return rounded(rate.rating_stats(t.ratings(spark, folder)), "avg_rating")


@query
def titled_movie_stats(spark, folder):
    stats = rate.titled_stats(t.ratings(spark, folder), t.movies(spark, folder))
    return rounded(stats.orderBy("title", "movie"), "avg_rating")


@query
def lowest_rated(spark, folder):
    return rounded(film.lowest_rated(t.ratings(spark, folder), t.movies(spark, folder), 3),
                   "avg_rating")


@query
def popular_movies(spark, folder):
    return rounded(film.popular_movies(t.ratings(spark, folder), t.movies(spark, folder),
                                       POPULAR_ABOVE, 20), "avg_rating")


@query
def popular_by_text_key(spark, folder):
    return film.popular_by_text_key(t.ratings(spark, folder), t.movies(spark, folder),
                                    POPULAR_ABOVE, 20).select("rank", "movie", "n")


@query
def rating_split(spark, folder):
    return t.rating_parts(spark, folder)


@query
def rating_split_sizes(spark, folder):
    return counting.count_by(t.rating_parts(spark, folder), "part")


def _parted(spark, folder) -> tuple[DataFrame, list[DataFrame]]:
    """All ratings, and of them the training, validation and test rows; written once, as each is
    read several times."""
    rows = stored(t.rating_parts(spark, folder))
    return rows.drop("part"), [rows.filter(F.col("part") == i).drop("part") for i in range(3)]


def _parts(spark, folder) -> list[DataFrame]:
    return _parted(spark, folder)[1]


def _predicted_by_mean(spark, folder):
    train, _, test = _parts(spark, folder)
    means = rate.rating_stats(train).select("movie", F.col("avg_rating").alias("rating"))
    return test.select("user", "movie").join(means, "movie"), test


@query
def rmse(spark, folder):
    """Error of predicting every test rating by the movie's training mean."""
    predicted, test = _predicted_by_mean(spark, folder)
    return rounded(rate.rmse(predicted, test), "rmse")


@query
def mean_baseline_rmse(spark, folder):
    train, _, test = _parts(spark, folder)
    return rounded(rate.mean_baseline(train, test), "mean", "rmse")


@query
def result_set_difference(spark, folder):
    """Parts and customers compared as bags of (key, brand or segment)."""
    parts = t.table(spark, folder, "part").select(
        F.col("p_size").cast("bigint").alias("k"), F.col("p_type").alias("v"))
    customers = t.table(spark, folder, "customer").select(
        F.col("c_nationkey").cast("bigint").alias("k"), F.lit("ECONOMY").alias("v"))
    return counting.multiset_difference(parts, customers)


# -- recommender ------------------------------------------------------------------------

@query
def als_rank_selection(spark, folder):
    train, validation, _ = _parts(spark, folder)
    return rounded(film.select_rank(train, validation).errors, "rmse")


@query
def als_test_rmse(spark, folder):
    train, validation, test = _parts(spark, folder)
    chosen = film.select_rank(train, validation)
    return rounded(film.model_error(chosen.best_model, test), "rmse").withColumn(
        "rank", F.lit(chosen.best_rank))


@query
def als_planted_recovery(spark, folder):
    """Models fitted on ratings with known values behind them: held-out pairs with a prediction,
    the mean's error, and whether the chosen rank has the smallest validation error and its
    model comes at least twice as near to the known values as the mean."""
    planted = stored(rate.split_rows(t.planted_ratings(spark, folder), (6, 2, 2),
                                     ("user", "movie"), seed=0))
    train, validation, held_out = (planted.filter(F.col("part") == i) for i in range(3))
    checked = film.recovery(train, validation, held_out.select("user", "movie", "known"),
                            PLANTED_RANKS, iterations=10, regularisation=0.01)
    return rounded(checked.select(
        "n", "mean_rmse", "smallest_chosen",
        (F.col("model_rmse") <= F.col("mean_rmse") / 2).alias("recovered")), "mean_rmse")


@query
def als_predicted_counts(spark, folder):
    """For every rank, how many validation rows the model has a prediction for."""
    train, validation, _ = _parts(spark, folder)
    return film.select_rank(train, validation).errors.select("rank", "n")


def _rated_by_new_user(ratings: DataFrame) -> DataFrame:
    often = counting.top_by_count(ratings, "movie", 10)
    return often.select(F.lit(NEW_USER).alias("user"), "movie",
                        (F.col("movie") % 5 + 1).cast("double").alias("rating"))


@query
def new_user_ratings(spark, folder):
    """The new user rates the ten most rated movies; the rating follows from the movie's key."""
    return _rated_by_new_user(t.ratings(spark, folder))


@query
def training_with_new_user(spark, folder):
    """Ratings per user of the training rows, the new user's ones included."""
    ratings, (train, _, _) = _parted(spark, folder)
    return counting.count_by(film.with_new_user(train, _rated_by_new_user(ratings)), "user")


@query
def recommendable_movies(spark, folder):
    """What may be recommended to the new user."""
    return film.recommendable(new_user_ratings(spark, folder), t.ratings(spark, folder),
                              t.movies(spark, folder), RECOMMENDED_ABOVE)


def _new_user_model(spark, folder):
    """The model with the new user in it, their ratings, all others and the test rows. The new
    user's ratings are few, but follow from all others, so they are written once, too."""
    ratings, (train, validation, test) = _parted(spark, folder)
    new = stored(_rated_by_new_user(ratings))
    rank = film.select_rank(train, validation).best_rank
    return film.fit(film.with_new_user(train, new), rank), new, ratings, test


@query
def new_user_test_rmse(spark, folder):
    model, _, _, test = _new_user_model(spark, folder)
    return rounded(film.model_error(model, test), "rmse")


def _new_user_list(spark, folder):
    model, new, ratings, _ = _new_user_model(spark, folder)
    return film.recommendations(model, NEW_USER, new, ratings,
                                t.movies(spark, folder), RECOMMENDED_ABOVE, 20), new


@query
def new_user_recommendations(spark, folder):
    return rounded(_new_user_list(spark, folder)[0], "prediction")


@query
def new_user_list_check(spark, folder):
    """Length of the new user's list, and how many of its movies are out of order, rated by
    the user or rated too seldom."""
    listed, new = _new_user_list(spark, folder)
    before = F.lag("prediction").over(Window.orderBy("rank"))
    rated = new.select("movie", F.lit(True).alias("rated"))
    return listed.withColumn("before", before).join(rated, "movie", "left").agg(
        F.count(F.lit(1)).alias("movies"),
        F.count_if(F.col("before") < F.col("prediction")).alias("out_of_order"),
        F.count_if("rated").alias("rated"),
        F.count_if(F.col("n") <= RECOMMENDED_ABOVE).alias("seldom"))
