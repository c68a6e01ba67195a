"""Score histogram and the precision/recall sweep against known matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.operators.similarity import (
    EDGE_DECIMALS, Vectors, all_pairs_summary, candidate_count, pair_scores, similar_pairs)

# Number of thresholds, and of histogram bins (the last one is score 1).
THRESHOLDS, BINS = 100, 101


def steady(score: Column) -> Column:
    """A score as it is compared with the edges of bins and with thresholds: the order in which a
    sum was taken must not move it over one."""
    return F.round(score, EDGE_DECIMALS)


def score_bin(score: Column) -> Column:
    """Truncated hundredths of a score."""
    return (steady(score) * THRESHOLDS).cast("int")


def duplicate_averages(vectors: Vectors, left: DataFrame, right: DataFrame,
                       gold: DataFrame) -> DataFrame:
    """Number and mean score of known matches and of all other record pairs:
    two rows ``is_match``, ``pairs``, ``mean_score``.

    The other pairs are all pairs minus the matches, so they are not enumerated. A match
    given twice counts twice among the matches and is taken off the others once.
    """
    score, times = F.col("score"), F.col("times")
    everything = all_pairs_summary(vectors, left, right).select(
        F.struct("pairs", "sum_score")).scalar()
    known = pair_scores(gold, vectors).agg(
        F.coalesce(F.sum(times), F.lit(0)).alias("given"),
        F.sum(score * times).alias("given_score"),
        F.count(score).alias("distinct"),
        F.coalesce(F.sum(score), F.lit(0.0)).alias("distinct_score"))

    def row(is_match: bool, pairs: Column, total: Column) -> Column:
        return F.struct(F.lit(is_match).alias("is_match"), pairs.alias("pairs"),
                        F.try_divide(total, pairs).alias("mean_score"))

    other_pairs = everything.getField("pairs") - F.col("distinct")
    other_score = everything.getField("sum_score") - F.col("distinct_score")
    return known.select(F.inline(F.array(
        row(True, F.col("given"), F.col("given_score")),
        row(False, other_pairs, other_score))))


def score_histogram(vectors: Vectors, gold_scores: DataFrame) -> DataFrame:
    """``bin``, ``n``: candidate pairs per score bin, minus one for every known match.

    Pairs that reach bin 1 are listed by the similarity search; those in bin 0 are all
    candidates less the listed ones. A known match without a shared token counts as
    score 0 although it is no candidate.
    """
    listed = similar_pairs(vectors, 1.0 / THRESHOLDS).select(
        score_bin(F.col("score")).alias("bin"),
        (F.col("left_copies") * F.col("right_copies")).alias("n"))
    upper = listed.groupBy("bin").agg(F.sum("n").alias("n")).filter("bin > 0")
    # Each listed pair also leaves bin 0, to which all candidates are first assigned.
    moved = upper.unionByName(upper.select(F.lit(0).alias("bin"), (-F.col("n")).alias("n")))
    everything = candidate_count(vectors).select(
        F.lit(0).alias("bin"), F.col("candidate_pairs").alias("n"))
    known = gold_scores.select(score_bin(F.col("score")).alias("bin"), (-F.col("times")).alias("n"))
    return (moved.unionByName(everything).unionByName(known)
            .filter(F.col("bin").between(0, BINS - 1))
            .groupBy("bin").agg(F.sum("n").alias("n")).filter("n <> 0"))


def missed_from(score: Column) -> Column:
    """The smallest n for which ``score < n/100`` holds in floating point."""
    guess = F.floor(score * THRESHOLDS)
    return (F.when(score < (guess - 1) / F.lit(float(THRESHOLDS)), guess - 1)
            .when(score < guess / F.lit(float(THRESHOLDS)), guess)
            .when(score < (guess + 1) / F.lit(float(THRESHOLDS)), guess + 1)
            .otherwise(guess + 2).cast("int"))


def quality_curve(histogram: DataFrame, gold_scores: DataFrame) -> DataFrame:
    """Per threshold 0.00 to 0.99: tp, fp, fn, precision, recall, f.

    False positives use the truncated bins, false negatives the exact score, each for
    all thresholds in one aggregate; the running sums then go over a hundred rows.
    """
    spark = histogram.sparkSession
    missed = gold_scores.groupBy(missed_from(steady(F.col("score"))).alias("step")).agg(
        F.sum("times").alias("missed"))
    matches = gold_scores.agg(F.coalesce(F.sum("times"), F.lit(0)).alias("n")).scalar()
    steps = (spark.range(BINS).select(F.col("id").cast("int").alias("step"))
             .join(histogram.select(F.col("bin").alias("step"), "n"), "step", "left")
             .join(missed, "step", "left")
             .select("step", F.coalesce("n", F.lit(0)).alias("n"),
                     F.coalesce("missed", F.lit(0)).alias("missed")))
    up = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    down = Window.orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, 0)
    counts = (steps.withColumn("fp", F.sum("n").over(down))
              .withColumn("fn", F.sum("missed").over(up))
              .withColumn("tp", matches - F.col("fn"))
              .filter(F.col("step") < THRESHOLDS))
    rates = counts.select(
        (F.col("step") / F.lit(float(THRESHOLDS))).alias("threshold"), "tp", "fp", "fn",
        F.try_divide("tp", F.col("tp") + F.col("fp")).alias("precision"),
        F.try_divide("tp", F.col("tp") + F.col("fn")).alias("recall"))
    both = F.col("precision") * F.col("recall") * 2
    return rates.withColumn("f", F.try_divide(both, F.col("precision") + F.col("recall")))
