"""Word statistics over lines of text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.functions.text import clean_text, split_on_blank
from larkspur.operators.counting import count_by, top, top_by_count


def cleaned_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    return lines.withColumn(column, clean_text(F.col(column)))


def words_of(cleaned: DataFrame, column: str = "value", keep_empty: bool = False,
             carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per piece between blanks; empty pieces only on request."""
    words = cleaned.select(*carry, F.explode(split_on_blank(F.col(column))).alias("word"))
    return words if keep_empty else words.filter(F.col("word") != "")


def word_totals(cleaned: DataFrame, column: str = "value") -> DataFrame:
    """Number of pieces with and without the empty ones, without making them rows."""
    split = cleaned.select(split_on_blank(F.col(column)).alias("pieces"))
    return split.agg(
        F.sum(F.size("pieces")).cast("bigint").alias("pieces"),
        F.sum(F.size(F.filter("pieces", lambda w: w != ""))).cast("bigint").alias("words"))


def top_words(lines: DataFrame, k: int = 15, column: str = "value") -> DataFrame:
    """The most frequent words of cleaned lines."""
    return top_by_count(words_of(cleaned_lines(lines, column), column), "word", k)


def last_words(lines: DataFrame, k: int = 5, column: str = "value") -> DataFrame:
    """The alphabetically last words, repeats kept."""
    words = words_of(cleaned_lines(lines, column), column, keep_empty=True)
    return top(words, [F.desc("word")], k)


def mean_count_per_word(words: DataFrame, column: str = "word") -> DataFrame:
    """Rows per distinct word: one row with ``words``, ``unique_words``, ``mean_count``."""
    counts = count_by(words, column)
    return counts.agg(
        F.sum("n").alias("words"),
        F.count(F.lit(1)).alias("unique_words"),
        F.round(F.avg("n"), 2).alias("mean_count"))
