"""Record matching from raw records to the quality curve."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.operators.counting import equal_width_histogram, top
from larkspur.operators.quality import quality_curve, score_histogram
from larkspur.operators.similarity import build_vectors, inverse_frequencies, pair_scores
from larkspur.session import stored


def both_sides(left: DataFrame, right: DataFrame) -> DataFrame:
    """The two record sets as one corpus, repeats kept. Ids are not compared across sides."""
    return left.select("text").unionByName(right.select("text"))


def token_idf(left: DataFrame, right: DataFrame, stopwords: Iterable[str] = ()) -> DataFrame:
    return inverse_frequencies(both_sides(left, right), stopwords)


def lowest_idf(idf: DataFrame, k: int = 11) -> DataFrame:
    return top(idf.select("token", "idf"), [F.asc("idf"), F.asc("token")], k)


def idf_histogram(idf: DataFrame, bins: int = 50) -> DataFrame:
    return equal_width_histogram(idf, "idf", bins)


def gold_scores(left: DataFrame, right: DataFrame, gold: DataFrame,
                stopwords: Iterable[str] = ()) -> DataFrame:
    """Score of every known match, 0 where the two share no token."""
    return pair_scores(gold, build_vectors(left, right, stopwords), keep_unknown=True)


def matching_quality(left: DataFrame, right: DataFrame, gold: DataFrame,
                     stopwords: Iterable[str] = ()) -> tuple[DataFrame, DataFrame]:
    """The score histogram and the quality curve of one matching task."""
    vectors = build_vectors(left, right, stopwords)
    scores = stored(pair_scores(gold, vectors, keep_unknown=True))
    histogram = score_histogram(vectors, scores)
    return histogram, quality_curve(histogram, scores)
