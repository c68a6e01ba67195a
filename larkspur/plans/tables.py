"""The given tables as inputs of the jobs: lines of text, log lines, records, ratings.

Log, product, match and rating lines are first written out as text from the tables and
then go through the parsers, so parsing is part of every job that uses them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.functions.numbers import month_names
from larkspur.operators.ratings import split_rows
from larkspur.session import dealt
from larkspur.sources.lines import accepted, spread
from larkspur.sources.ratings import parse_movie_lines, parse_rating_lines
from larkspur.sources.records import parse_match_lines, parse_product_lines
from larkspur.sources.weblog import parse_log_lines

STOPWORDS = ("a", "an", "and", "are", "as", "at", "be", "being", "by", "for", "from", "in",
             "is", "it", "of", "on", "over", "that", "the", "this", "to", "was", "why", "with")

# How an event becomes a request. Plain SQL, so that a check can use the same rules on the
# events themselves, without writing and parsing lines.
HOST = "'host' || user_id || '.example.net'"
METHOD = "CASE WHEN event_type IN ('signup', 'purchase') THEN 'POST' ELSE 'GET' END"
ENDPOINT = ("CASE event_type WHEN 'view' THEN '/item/' || (user_id % 25)"
            " WHEN 'click' THEN '/go/' || (user_id % 40) WHEN 'signup' THEN '/join'"
            " WHEN 'purchase' THEN '/buy/' || (user_id % 10)"
            " ELSE '/old/' || (event_id % 60) END")
CODE = ("CASE WHEN event_type = 'error' AND event_id % 9 = 0 THEN 500"
        " WHEN event_type = 'error' THEN 404"
        " WHEN event_type = 'click' AND event_id % 4 = 0 THEN 304"
        " WHEN event_type = 'signup' THEN 302 ELSE 200 END")
BYTES = "CAST(floor(value * 100) AS BIGINT)"
WITHOUT_PROTOCOL = "event_id % 13 = 5"
BROKEN = "event_id % 50 = 7"

BROKEN_PART = "p_partkey % 97 = 3"
BROKEN_RATING = "l_linenumber = 7 AND l_orderkey % 40 = 0"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "documents").select("doc_id", "text"))


def document_lines(spark: SparkSession, folder: str, placed: bool = False) -> DataFrame:
    """``doc_id``, ``line_no`` (from 0), ``value``; ``placed`` by document, in partitions of bounded
    size, for steps that group by it."""
    docs = documents(spark, folder)
    return (dealt(docs, "doc_id", "text") if placed else docs).select(
        "doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "value"))


def log_lines(spark: SparkSession, folder: str) -> DataFrame:
    def two(part):
        return F.lpad(part.cast("string"), 2, "0")

    ts = F.col("ts")
    month = F.get(month_names(), F.month(ts) - 1)
    time = F.concat(two(F.dayofmonth(ts)), F.lit("/"), month, F.lit("/"),
                    F.year(ts).cast("string"), F.lit(":"), two(F.hour(ts)), F.lit(":"),
                    two(F.minute(ts)), F.lit(":"), two(F.second(ts)))
    protocol = F.when(F.expr(WITHOUT_PROTOCOL), F.lit("")).otherwise(F.lit(" HTTP/1.0"))
    quote = F.when(F.expr(BROKEN), F.lit("")).otherwise(F.lit('"'))
    size = F.when(F.expr(f"{CODE} = 304"), F.lit("-")).otherwise(F.expr(BYTES).cast("string"))
    events = table(spark, folder, "events").select("event_id", "ts", "user_id", "event_type",
                                                   "value")
    return spread(events).select(F.concat(
        F.expr(HOST), F.lit(" - - ["), time, F.lit(" -0400] "), quote, F.expr(METHOD),
        F.lit(" "), F.expr(ENDPOINT), protocol, F.lit('" '),
        F.expr(CODE).cast("string"), F.lit(" "), size).alias("value"))


def parsed_log(spark: SparkSession, folder: str, strict: bool = False) -> DataFrame:
    return parse_log_lines(log_lines(spark, folder), strict)


def logs(spark: SparkSession, folder: str) -> DataFrame:
    return accepted(parsed_log(spark, folder))


def _with_header(lines: DataFrame, header: str) -> DataFrame:
    return lines.unionByName(
        lines.sparkSession.range(1).select(F.lit(header).alias("value")))


def product_lines(spark: SparkSession, folder: str) -> DataFrame:
    quote = F.when(F.expr(BROKEN_PART), F.lit("")).otherwise(F.lit('"'))
    lines = table(spark, folder, "part").select(F.concat(
        F.lit('"'), F.col("p_partkey").cast("string"), F.lit('",'), quote, F.col("p_name"),
        F.lit(", size "), F.col("p_size").cast("string"), quote, F.lit(","), F.col("p_type"),
        F.lit(',"'), F.col("p_brand"), F.lit('",'), F.col("p_retailprice").cast("string")
    ).alias("value"))
    return _with_header(lines, '"id","title",description,manufacturer,price')


def parsed_products(spark: SparkSession, folder: str) -> DataFrame:
    return parse_product_lines(product_lines(spark, folder))


def left_records(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "benchmark").select(F.col("item_id").alias("id"), "text")


def right_records(spark: SparkSession, folder: str) -> DataFrame:
    return documents(spark, folder).select(F.col("doc_id").alias("id"), "text")


def match_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Known matches as CSV lines: a document matches the first passage that has one of
    its lines. A line belongs to one passage, so a common line adds one row per document."""
    def lines_of(records: DataFrame) -> DataFrame:
        return records.select("id", F.explode(F.split("text", "\n")).alias("line")
                              ).filter("line <> ''")

    passages = lines_of(left_records(spark, folder)).groupBy("line").agg(F.min("id").alias("l"))
    shared = (lines_of(right_records(spark, folder)).join(passages, "line")
              .select("l", F.col("id").alias("r")).distinct())
    lines = shared.select(F.format_string('"%d","%d"', "l", "r").alias("value"))
    return _with_header(lines, '"idAmazon","idGoogleBase"')


def parsed_matches(spark: SparkSession, folder: str) -> DataFrame:
    return parse_match_lines(match_lines(spark, folder))


def gold(spark: SparkSession, folder: str) -> DataFrame:
    pairs = accepted(parsed_matches(spark, folder))
    return pairs.select(F.col("left_id").try_cast("bigint").alias("left_id"),
                        F.col("right_id").try_cast("bigint").alias("right_id"))


def rating_lines(spark: SparkSession, folder: str) -> DataFrame:
    """A customer rates a part they ordered; the rating follows from the quantity."""
    items = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    rating = F.col("l_quantity").cast("int") % 5 + 1
    separator = F.when(F.expr(BROKEN_RATING), F.lit(";")).otherwise(F.lit("::"))
    return items.join(orders, "l_orderkey").select(F.concat(
        F.col("o_custkey").cast("string"), separator, F.col("l_partkey").cast("string"),
        separator, rating.cast("string"), separator, F.col("l_orderkey").cast("string")
    ).alias("value"))


def movie_lines(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.concat_ws("::", F.col("p_partkey").cast("string"), "p_name", "p_type").alias("value"))


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    return accepted(parse_rating_lines(rating_lines(spark, folder)))


def movies(spark: SparkSession, folder: str) -> DataFrame:
    return accepted(parse_movie_lines(movie_lines(spark, folder)))


def planted_ratings(spark: SparkSession, folder: str) -> DataFrame:
    """Every customer with every part they ordered, once: ``known``, a value of rank three that
    follows from the keys, and ``rating``, the same with an error of up to 0.2."""
    pairs = ratings(spark, folder).select("user", "movie").distinct()
    user, movie = F.col("user").cast("bigint"), F.col("movie").cast("bigint")
    known = (F.lit(1.0) + 2 * (user * 37 % 101 / 100) * (movie * 29 % 97 / 96)
             + 2 * (user * 53 % 89 / 88) * (movie * 71 % 83 / 82))
    return pairs.select("user", "movie", known.alias("known"),
                        (known + ((user * 131 + movie * 17) % 21 - 10) / 50).alias("rating"))


def rating_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Ratings with ``part``: 0 training, 1 validation, 2 test, as 6:2:2."""
    return split_rows(ratings(spark, folder), (6, 2, 2), ("user", "movie"), seed=0)
