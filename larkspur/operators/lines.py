"""Consecutive numbering of rows without pulling them into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.session import stable

# monotonically_increasing_id keeps the position inside a partition in its low 33 bits.
POSITION_BITS = 33
# Block offsets are sent to every task up to this many rows, and joined by shuffle beyond.
MOST_BROADCAST_ROWS = 500_000


def _offsets(counts: DataFrame, order: Sequence[str], within: Sequence[str] = (),
             name: str = "offset") -> DataFrame:
    """Exclusive running sum of ``rows``; one row per partition or file block, so small."""
    earlier = Window.partitionBy(*within).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(name, F.coalesce(F.sum("rows").over(earlier), F.lit(0)))


def number_rows(df: DataFrame, order: Sequence[Column], name: str = "index") -> DataFrame:
    """Number rows from 0 in the given order.

    ``order`` should end in a unique column: the rows are range-partitioned by it, so
    a repeated leading key can still be spread over many tasks. The sorted rows are
    written once, since the positions must be the same in both passes over them.
    """
    ordered = stable(df.repartitionByRange(*order).sortWithinPartitions(*order))
    placed = (ordered
              .withColumn("_row", F.monotonically_increasing_id())
              .withColumn("_part", F.shiftrightunsigned("_row", POSITION_BITS).cast("int")))
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("rows"))
    offsets = _offsets(counts, ["_part"]).select("_part", "offset")
    # One row per partition, so the broadcast does not grow with the rows.
    return (placed.join(F.broadcast(offsets), "_part")
            .withColumn(name, F.col("offset")
                        + F.col("_row").bitwiseAND((1 << POSITION_BITS) - 1))
            .drop("_part", "_row", "offset"))


def number_text_lines(lines: DataFrame, name: str = "index",
                      per_file: bool = False) -> DataFrame:
    """Number the lines of text files from 0, in file order, without sorting them.

    ``lines`` is the direct output of ``spark.read.text`` over any number of files, plain and
    compressed together. Files follow one another by their full path as text; ``per_file`` starts
    again at 0 in each and adds the column ``file``. A file that is given twice is read as two
    runs of lines by Spark and must not be. Lines of one file block (all of a compressed file) are
    read by one task in order, so a block's offset plus the position in the block is
    enough: one counting pass and one numbering pass. The text is not shuffled as long as
    there are at most ``MOST_BROADCAST_ROWS`` blocks (of 128 MB: 64 TB).
    """
    placed = lines.select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_row"))
    blocks = placed.groupBy("_file", "_start").agg(
        F.count(F.lit(1)).alias("rows"), F.min("_row").alias("_first"))
    within = ["_file"] if per_file else []
    offsets = stable(_offsets(blocks, ["_file", "_start"], within).drop("rows"))
    if offsets.count() <= MOST_BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    file = [F.col("_file").alias("file")] if per_file else []
    return placed.join(offsets, ["_file", "_start"]).select(
        *file, (F.col("offset") + F.col("_row") - F.col("_first")).alias(name), "value")
