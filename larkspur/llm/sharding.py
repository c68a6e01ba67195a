"""Shards by a keyed permutation of row numbers.

Rows get gapless global numbers; a Feistel network on just enough bits, repeated until the
value falls below the number of rows (cycle walking), permutes them. Row ``p`` of the
permuted order belongs to shard ``p % shards`` in slot ``p // shards``. So shard sizes differ
by one row at most, slots have no gaps, and both directions can be computed for a single row
from the number of rows and the seed alone.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import identity, numbered, same, whole_text
from larkspur.session import stored

ROUNDS = 6


def _mixed(values: np.ndarray) -> np.ndarray:
    """The finishing steps of the public splitmix64 generator."""
    values = values + np.uint64(0x9E3779B97F4A7C15)
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _once(values: np.ndarray, half: int, seed: int, inverse: bool) -> np.ndarray:
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    left, right = values >> shift, values & mask
    keys = _mixed(np.arange(ROUNDS, dtype=np.uint64) + np.uint64(seed % 2**63) * np.uint64(ROUNDS))
    for key in keys[::-1] if inverse else keys:
        if inverse:
            left, right = right ^ (_mixed(left ^ key) & mask), left
        else:
            left, right = right, left ^ (_mixed(right ^ key) & mask)
    return (left << shift) | right


def permuted(numbers: np.ndarray, rows: int, seed: int, inverse: bool = False) -> np.ndarray:
    """A permutation of 0 .. rows - 1, or its inverse, at ``numbers``.

    The network works on fewer than ``4 * rows`` values, so a number is walked on four times
    on average at most.
    """
    half = max(1, (max(rows - 1, 1).bit_length() + 1) // 2)
    with np.errstate(over="ignore"):
        values = _once(np.asarray(numbers, dtype=np.uint64), half, seed, inverse)
        outside = values >= rows
        while outside.any():
            values[outside] = _once(values[outside], half, seed, inverse)
            outside = values >= rows
    return values.astype(np.int64)


def place(number: int, rows: int, shards: int, seed: int) -> tuple[int, int]:
    """Shard and slot of a row number."""
    p = int(permuted(np.array([number]), rows, seed)[0])
    return p % shards, p // shards


def row_number(shard: int, slot: int, rows: int, shards: int, seed: int) -> int:
    """The row number that has this shard and slot."""
    return int(permuted(np.array([slot * shards + shard]), rows, seed, inverse=True)[0])


def assign_shards(rows: DataFrame, key: Sequence[str], shards: int, seed: int = 0) -> DataFrame:
    """``rows`` with ``number``, ``shard`` and ``slot`` (all long but ``shard``).

    Numbers follow from the rows' contents, whatever their order and partitions; nulls are
    values like others, equal rows get places of their own, and no row gives no row. Give few
    and small columns here and join large ones afterwards, as :func:`shard_documents` does.
    ``rows`` is read more than once.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    clash = {"number", "shard", "slot"} & set(rows.columns)
    if clash:
        raise ValueError(f"columns with these names are added here: {sorted(clash)}")
    total = rows.count()

    @F.pandas_udf("bigint")
    def position(numbers: pd.Series) -> pd.Series:
        return pd.Series(permuted(numbers.to_numpy(), total, seed))

    placed = numbered(rows, key).withColumn("_p", position("number"))
    return placed.select(*rows.columns, "number",
                         F.expr(f"CAST(_p % {shards} AS INT)").alias("shard"),
                         F.expr(f"_p DIV {shards}").alias("slot"))


def shard_documents(docs: DataFrame, shards: int, seed: int = 0, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``shard`` and ``slot``, ready to be written by shard.

    Only key and digest are numbered; the texts meet their places in one join. Rows with
    equal key and text are told apart by number only, and take their other columns from one
    of them.
    """
    names = ["_llm_key", "_llm_text"]
    slim = stored(docs.select(*identity(key, text)))
    places = assign_shards(slim, names, shards, seed).drop("number")
    own = docs.withColumns(dict(zip(names, identity(key, text), strict=True))).dropDuplicates(names)
    return (own.join(places, same(own, places, names))
            .select(*(own[c] for c in docs.columns), "shard", "slot"))


def shard_digest(docs: DataFrame, shards: int = 24, seed: int = 24) -> DataFrame:
    """The digest of every document's place: one row per row of ``docs``.

    A null text has no bytes (size 8, CRC 0). ``grown_shard`` is null, since this law does
    not keep rows in place when a shard is added.
    """
    slim = stored(docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("bigint").alias("size"),
        F.crc32(whole_text().cast("binary")).alias("text_crc32")))
    return assign_shards(slim, ["doc_id"], shards, seed).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "number")
