"""What several of these operators share."""

from __future__ import annotations

import os
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: The ASCII white space characters that separate words in most of the contracts.
BLANKS = "\t\n\x0b\x0c\r "

GENERATED = "_llm_"


def share_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, as they do not know
    the driver's search path."""
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))


#: Texts go to Python workers a few at a time: a batch is in memory several times over, on both
#: sides, and the largest texts decide how large it gets.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
           "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


def prepare(spark: SparkSession) -> None:
    """What the session needs before texts are worked on in Python."""
    share_package(spark)
    for name, value in BATCHES.items():
        spark.conf.set(name, value)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text; an empty one for null."""
    return F.coalesce(F.col(column), F.lit(""))


def identity(key: str = "doc_id", text: str = "text") -> list[Column]:
    """Columns that tell rows apart by key and text: the key and a 128-bit digest.

    Two rows that agree here have the same text, so what is found out about one holds for
    the other.
    """
    return [F.col(key).alias(f"{GENERATED}key"), digest(F.col(text)).alias(f"{GENERATED}text")]


def digest(value: Column) -> Column:
    """16 bytes of SHA-256; null for null."""
    return F.unhex(F.substring(F.sha2(value, 256), 1, 32))


def same(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    """Equality in all the columns, where null equals null."""
    condition = F.lit(True)
    for name in columns:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


def hash_bounds(rows: DataFrame, group: str, hashed: str, most: int) -> dict[object, int]:
    """Per group (few of them), a bound for a 64-bit hash that about ``1.25 * most`` of the
    group's distinct hashes do not exceed, or all where there are fewer.

    Hashes are uniform, so the bound follows from how many there are; that count is a small
    sketch per task, and no group's rows meet in one task. A margin of a quarter is five times
    the sketch's usual error. The bound does not depend on partitions or order.
    """
    counts = rows.groupBy(group).agg(F.approx_count_distinct(hashed, 0.05).alias("n")).collect()
    top = 1 << 63
    return {r[0]: min(top - 1, int((1 << 64) * 1.25 * most / max(1, r["n"])) - top)
            for r in counts}


def numbered(rows: DataFrame, key: Sequence[str], groups: Sequence[str] = (),
             name: str = "number", buckets: int = 4096) -> DataFrame:
    """Number rows from 0 without gaps, within each group; a function of the rows alone.

    Rows are dealt to ``buckets`` by a hash of ``key`` and all their columns, ordered there,
    and shifted by the rows of the earlier buckets, so no task sorts a whole group. Rows
    equal in every column count as one row with a number of copies until the end: they are
    combined before the shuffle and cannot crowd a bucket. Neither the number of partitions
    nor a repeated task changes a number (up to exchanging equal rows).
    """
    columns = rows.columns
    copies, bucket, start = (f"{GENERATED}{x}" for x in ("copies", "bucket", "start"))
    order = [*key, *(c for c in columns if c not in key)]
    distinct = (rows.groupBy(*columns).agg(F.count(F.lit(1)).alias(copies))
                .withColumn(bucket, F.pmod(F.xxhash64(*order), F.lit(buckets))))
    sizes = distinct.groupBy(*groups, bucket).agg(F.sum(copies).alias(start))
    earlier = Window.partitionBy(*groups).orderBy(bucket).rowsBetween(
        Window.unboundedPreceding, -1)
    starts = sizes.withColumn(start, F.coalesce(F.sum(start).over(earlier), F.lit(0)))
    within = Window.partitionBy(*groups, bucket).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1)
    first = F.col(start) + F.coalesce(F.sum(copies).over(within), F.lit(0))
    joined = (distinct.join(starts, [*groups, bucket])
              .withColumn(start, first))
    return joined.select(
        *columns,
        F.explode(F.sequence(F.col(start), F.col(start) + F.col(copies) - 1)).alias(name))
