"""Near-duplicates by SimHash fingerprints and covering locality-sensitive hashing.

A fingerprint has 64 bits; two link when they differ in ``radius`` bits or fewer. To find all
such pairs, every bit is given one of the ``2^(r+1) - 1`` non-zero vectors of r + 1 bits, in
turn. Table ``m`` looks only at the bits whose vector has an odd number of ones in common with
``m``. For any r bits there is an ``m`` that is even with all of their vectors, so two
fingerprints that differ just there agree in that table (Pagh, "CoveringLSH", 2016): no pair is
missed. With r = 3 there are 15 tables, each of which looks at about half of the bits.

Documents with equal fingerprints are one node. Within a bucket, nodes are compared and only a
spanning forest of their links leaves it, so a bucket gives fewer links than it has nodes.
Buckets above ``bucket_nodes`` are never gathered: their nodes go on to all points within r // 2
bits and within r - r // 2 bits of them (in the bits that the table does not look at), and
those that meet at a point are linked to the smallest there. Two fingerprints differ in r bits
at most exactly if they meet so, hence this finds the same components from counts and minima.

``keep_one``, a stage of the pipeline, keeps one row of each component that these links make.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import digest, whole_text
from larkspur.llm.components import component_roots
from larkspur.session import stored

BITS = 64
RADIUS = 3
SHINGLE_WORDS = 3
SEED = 42
BUCKET_NODES = 512
#: Shingles whose bits are counted at a time.
BLOCK = 1 << 16

_ID, _FP, _TEXT = "_llm_id", "_llm_fp", "_llm_text"


def _shingle_hashes(text: str, words: int) -> Iterator[np.ndarray]:
    """Hashes of a text's shingles (big-endian), ``BLOCK`` at a time; none without words."""
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return
    joined = memoryview(b" ".join(parts))
    lengths = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    n = max(1, len(parts) - words + 1)
    last = min(words, len(parts)) - 1
    hashed = xxhash.xxh64_intdigest
    for i in range(0, n, BLOCK):
        a, b = starts[i:min(i + BLOCK, n)].tolist(), ends[i + last:min(i + BLOCK, n) + last].tolist()
        yield np.array([hashed(joined[x:y], SEED) for x, y in zip(a, b, strict=True)], dtype=">u8")


def fingerprint(text: str, words: int = SHINGLE_WORDS) -> int:
    """The fingerprint of a text as an unsigned number; 0 without words.

    Words are separated by ASCII white space, A-Z is lower-cased, a shingle is ``words`` words
    joined by a blank (or all of fewer), and a bit is set if it is in over half of the hashes.
    """
    counts, n = np.zeros(BITS, dtype=np.int64), 0
    for hashes in _shingle_hashes(text, words):
        counts += np.unpackbits(hashes.view(np.uint8)).reshape(-1, BITS).sum(0, dtype=np.int64)
        n += len(hashes)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def masks(radius: int = RADIUS) -> np.ndarray:
    """The bits that each table looks at."""
    vectors = [i % (2 ** (radius + 1) - 1) + 1 for i in range(BITS)]
    return np.array([sum(1 << i for i, v in enumerate(vectors) if (v & m).bit_count() % 2)
                     for m in range(1, 2 ** (radius + 1))], dtype=np.uint64)


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >= 1 << (BITS - 1) else value


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """``_llm_id``, ``_llm_fp`` (signed) and ``_llm_text``, a digest of the text, of every row."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [v.as_py() for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0),
                 pa.array([_signed(fingerprint(t, words)) for t in texts], pa.int64()),
                 batch.column(2)], [_ID, _FP, _TEXT])

    return docs.select(F.col(key).cast("bigint"), whole_text(text),
                       digest(whole_text(text))).mapInArrow(
        hashed, f"{_ID} long, {_FP} long, {_TEXT} binary")


def _forest(nodes: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among a bucket's nodes, a bounded number of them."""
    left, links = np.sort(nodes), []
    while len(left) > 1:
        # Grow one tree from the smallest node that is left.
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            near = np.bitwise_count(left[:, None] ^ front[None, :]) <= radius
            reached = near.any(axis=1)
            links += zip(left[reached].tolist(), front[near[reached].argmax(axis=1)].tolist(),
                         strict=True)
            front, left = left[reached], left[~reached]
    return links


def _within(nodes: DataFrame, radius: int) -> DataFrame:
    """Links of the buckets that may be gathered; ``nodes`` is an array per bucket."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links: list[tuple[int, int]] = []
            for bucket in batch.column(0):
                links += _forest(np.asarray(bucket.values).view(np.uint64), radius)
            ends = np.array(links, dtype=np.uint64).reshape(-1, 2).view(np.int64).T
            yield pa.RecordBatch.from_arrays([pa.array(e, pa.int64()) for e in ends], ["u", "v"])

    return nodes.mapInArrow(compare, "u long, v long")


def _across(nodes: DataFrame, free: list[list[int]], radius: int) -> DataFrame:
    """Links of the other buckets, by the points where their nodes meet."""
    near, far = radius // 2, radius - radius // 2
    steps = [([sum(1 << b for b in c) for k in range(far + 1) for c in combinations(bits, k)],
              sum(1 for k in range(near + 1) for _ in combinations(bits, k))) for bits in free]
    flips = [np.array(f, dtype=np.uint64) for f, _ in steps]

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for t, fp in frame.itertuples(index=False):
                points = (np.uint64(fp % (1 << BITS)) ^ flips[t]).view(np.int64)
                yield pd.DataFrame({"t": t, "point": points, "fp": fp,
                                    "near": np.arange(len(points)) < steps[t][1]})

    points = nodes.select("t", "fp").mapInPandas(spread, "t int, point long, fp long, near boolean")
    centres = points.groupBy("t", "point").agg(
        F.min(F.when(F.col("near"), F.col("fp"))).alias("centre"), F.count(F.lit(1)).alias("n"),
    ).filter("centre IS NOT NULL AND n > 1").drop("n")
    return (points.join(centres, ["t", "point"]).filter("fp <> centre")
            .select(F.col("fp").alias("u"), F.col("centre").alias("v")).distinct())


def links(nodes: DataFrame, radius: int = RADIUS, bucket_nodes: int = BUCKET_NODES) -> DataFrame:
    """``u`` and ``v``: links that connect all fingerprints (column ``fp``, distinct) that are
    linked directly or through others. The number of links is at most the number of tables
    times the number of nodes."""
    looked = masks(radius)
    keys = F.array(*(F.col("fp").bitwiseAND(F.lit(_signed(int(m)))) for m in looked))
    tables = nodes.select("fp", F.posexplode(keys).alias("t", "key"))
    crowded = stored(tables.groupBy("t", "key").count().filter(F.col("count") > bucket_nodes)
                     .select("t", "key"))
    small = (tables.join(crowded, ["t", "key"], "left_anti")
             .groupBy("t", "key").agg(F.collect_list("fp").alias("fps"))
             .filter(F.size("fps") > 1).select("fps"))
    found = _within(small, radius)
    if not crowded.isEmpty():
        free = [[b for b in range(BITS) if not int(m) >> b & 1] for m in looked]
        found = found.union(_across(tables.join(crowded, ["t", "key"]), free, radius))
    return found.distinct()


def _grouped(docs: DataFrame, radius: int, words: int, bucket_nodes: int, key: str,
             text: str) -> DataFrame:
    """``fingerprints`` with ``root``, a fingerprint that stands for the row's component, and
    ``least``, the component's smallest key."""
    marked = stored(fingerprints(docs, words, key, text))
    nodes = stored(marked.groupBy(F.col(_FP).alias("fp")).agg(F.min(_ID).alias("least")))
    roots = component_roots(links(nodes.select("fp"), radius, bucket_nodes))
    rooted = stored(nodes.join(roots, nodes["fp"] == roots["u"], "left")
                    .select("fp", "least", F.coalesce("v", "fp").alias("root")))
    # Most nodes are alone: only the roots of links need their component's smallest key.
    linked = rooted.join(roots.select(F.col("v").alias("root")).distinct(), "root", "left_semi")
    smallest = linked.groupBy("root").agg(F.min("least").alias("smallest"))
    ids = (rooted.join(smallest, "root", "left")
           .select("fp", "root", F.coalesce("smallest", "least").alias("least")))
    return marked.join(ids, F.col(_FP) == F.col("fp"))


def near_duplicates(docs: DataFrame, radius: int = RADIUS, words: int = SHINGLE_WORDS,
                    bucket_nodes: int = BUCKET_NODES, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """``key``, ``fingerprint`` (16 hexadecimal digits) and ``component_id`` of every row.

    ``component_id`` is the smallest key reachable over links, the row's own included. Null and
    wordless texts have fingerprint 0 and link like others. Rows that repeat a key are rows of
    their own; null keys take part but never become an id, and a component of null keys only
    has a null id. No rows give no rows; other columns are not looked at.
    """
    return _grouped(docs, radius, words, bucket_nodes, key, text).select(
        F.col(_ID).alias(key), F.lpad(F.lower(F.hex(_FP)), 16, "0").alias("fingerprint"),
        F.col("least").alias("component_id"))


def keep_one(docs: DataFrame, radius: int = RADIUS, words: int = SHINGLE_WORDS,
             bucket_nodes: int = BUCKET_NODES, key: str = "doc_id",
             text: str = "text") -> DataFrame:
    """One row of ``docs`` for each component of linked fingerprints, all columns as they are: the
    row of the smallest key (a null comes last), and among that key's rows one by a digest of
    the text. Null and wordless texts have fingerprint 0 and are one component."""
    grouped = _grouped(docs, radius, words, bucket_nodes, key, text)
    first = grouped.groupBy("root").agg(
        F.min(F.struct(F.col(_ID).isNull().alias("none"), _ID, _TEXT)).alias("first"))
    first = first.select("first.*").select(F.col(_ID).alias("_llm_first"), _TEXT)
    own = docs.withColumn("_llm_own", digest(whole_text(text)))
    kept = own.join(first.hint("shuffle_hash"),
                    F.col(key).cast("bigint").eqNullSafe(F.col("_llm_first"))
                    & (F.col("_llm_own") == F.col(_TEXT)), "left_semi")
    # Rows that repeat both key and text are still there together.
    return kept.dropDuplicates([key, "_llm_own"]).select(*docs.columns)
