"""Connected components of a graph whose links never leave Spark's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.session import stored

MOST_ROUNDS = 60


def _large_star(links: DataFrame) -> DataFrame:
    """Every node's larger neighbours are linked to the smallest of it and its neighbours."""
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    smallest = both.groupBy("u").agg(F.min("v").alias("m"))
    return (both.join(smallest, "u").filter("v > u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).filter("u <> v"))


def _small_star(links: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    smallest = down.groupBy("u").agg(F.min("v").alias("m"))
    others = (down.join(smallest, "u").filter("v <> m")
              .select(F.col("v").alias("u"), F.col("m").alias("v")))
    return others.union(smallest.select("u", F.col("m").alias("v"))).distinct()


def component_roots(links: DataFrame) -> DataFrame:
    """``u`` and ``v``, the smallest node reachable, for every node that is not that one.

    ``links`` has columns ``u`` and ``v`` of one ordered type, without nulls. Alternating star
    steps (Kiveris et al., "Connected components in MapReduce and beyond", 2014) end when every
    link leads to a smallest node; the rounds needed grow with the logarithm of the longest
    path. Each round is written once. A node with many links only ever meets one row, its
    minimum, so large groups are split like any skewed join.
    """
    links = stored(links.filter("u <> v").distinct())
    last = None
    for _ in range(MOST_ROUNDS):
        links = stored(_small_star(_large_star(links)))
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
                        ).first()
        if now == last or not now[0]:
            return links
        last = now
    raise RuntimeError("the components did not settle")
