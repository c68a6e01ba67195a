"""Dropping lines that many documents share, with Bloom filters in front of the exact count.

A line's key is the line without white space at both ends, in lower case (A-Z). A key of enough
characters found in enough documents loses all its lines except those in the largest document id
that holds it. Almost all keys occur once, so they are kept out of the exact count:

1. Each task takes a quick hash of the keys of its documents and sends the distinct hashes, eight
   bytes each, to the slice of the hash space they belong to; hashes that the task
   met again go a second time, in a list of their own.
2. Each slice puts them into two Bloom filters: a hash whose bits are all in the once-seen filter
   sets its bits in the twice-seen filter, any other hash sets its bits in the once-seen one.
   Nothing that occurs twice can be missed.
3. Lines whose hash is in the twice-seen filter are suspected repeats. Only they are shuffled,
   as 16-byte digests with their document ids, to count documents exactly and to choose the
   document that keeps the line.
4. Documents with lines to drop get the list of those lines' digests by document id.

Filters grow with the number of lines. Up to ``broadcast_bytes`` the twice-seen filters are
broadcast, so the second pass reads each document where it is. Beyond that nothing is broadcast:
hashes travel to their slice's filter, the suspected ones travel back. Both ways find the same.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Collection, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import whole_text
from larkspur.session import stored

LEAST_CHARACTERS = 20
LEAST_DOCUMENTS = 3
BITS_PER_LINE = 12
HASHES = 4
#: A slice's filter has so many bits, whatever the size of the input.
SLICE_BITS = 1 << 23
BROADCAST_BYTES = 64 << 20
#: Lines that meet a slice's filter in one task.
PART_LINES = 1 << 22

_ID = "_llm_id"


def line_keys(text: str, least: int) -> list[bytes]:
    """The key of every line in UTF-8: stripped of ASCII white space, A-Z in lower case; empty
    where it has fewer than ``least`` characters and so cannot count."""
    # Methods of bytes know ASCII only, so lower() and strip() do just what a key needs.
    keys = [line.strip() for line in text.encode("utf-8", "surrogatepass").lower().split(b"\n")]
    if text.isascii():
        return [k if len(k) >= least else b"" for k in keys]
    return [k if len(k) >= 4 * least or len(k.decode("utf-8", "surrogatepass")) >= least else b""
            for k in keys]


def _digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def _hashes(keys: Collection[bytes]) -> np.ndarray:
    """A quick hash of every key, for the filters."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), dtype=np.uint64, count=len(keys))


def _slice_of(hashes: np.ndarray, slices: int) -> np.ndarray:
    return ((hashes >> np.uint64(40)) % np.uint64(slices)).astype(np.int32)


def _positions(hashes: np.ndarray) -> np.ndarray:
    """The bits of each hash, by double hashing: one row per hash."""
    step = (hashes >> np.uint64(20)) | np.uint64(1)
    turns = np.arange(HASHES, dtype=np.uint64)
    with np.errstate(over="ignore"):
        return ((hashes[:, None] + turns * step[:, None]) % np.uint64(SLICE_BITS)).astype(np.int64)


class Filter:
    """One slice's Bloom filter."""

    def __init__(self, bits: np.ndarray | None = None):
        self.bits = np.zeros(SLICE_BITS, dtype=bool) if bits is None else bits

    def has(self, hashes: np.ndarray) -> np.ndarray:
        return self.bits[_positions(hashes)].all(axis=1)

    def add(self, hashes: np.ndarray) -> None:
        self.bits[_positions(hashes).ravel()] = True

    def packed(self) -> bytes:
        return zlib.compress(np.packbits(self.bits).tobytes(), 1)

    @classmethod
    def unpacked(cls, data: bytes) -> Filter:
        return cls(np.unpackbits(np.frombuffer(zlib.decompress(data), dtype=np.uint8)).view(bool))


class PackedFilters:
    """The twice-seen filters of all slices, eight bits a byte; bounded by the caller."""

    def __init__(self, filters: dict[int, bytes], slices: int):
        self.slices = slices
        self.bits = {s: np.frombuffer(zlib.decompress(d), dtype=np.uint8)
                     for s, d in filters.items()}

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = np.zeros(len(hashes), dtype=bool)
        own = _slice_of(hashes, self.slices)
        for s in np.unique(own):
            if int(s) in self.bits:
                at = np.flatnonzero(own == s)
                positions = _positions(hashes[at])
                taken = self.bits[int(s)][positions >> 3] >> (7 - (positions & 7)).astype(np.uint8)
                found[at] = (taken & 1).all(axis=1)
        return found


def _by_slice(hashes: np.ndarray, slices: int) -> Iterator[tuple[int, bytes]]:
    if not len(hashes):
        return
    own = _slice_of(hashes, slices)
    order = np.argsort(own, kind="stable")
    starts = np.flatnonzero(np.diff(own[order], prepend=-1))
    for a, b in zip(starts, [*starts[1:], len(order)], strict=True):
        yield int(own[order[a]]), hashes[order[a:b]].astype("<u8").tobytes()


def _task_hashes(docs: DataFrame, least: int, slices: int) -> DataFrame:
    """Distinct hashes of each task by slice: ``hashes`` met, ``again`` met in another document.

    A task keeps at most ``HELD`` hashes and then sends them on, so its memory is bounded; a
    hash sent twice counts as seen twice.
    """
    HELD = 1 << 21
    schema = "slice int, hashes binary, again binary"

    def flush(parts: list[np.ndarray]) -> pa.RecordBatch:
        distinct, counts = np.unique(np.concatenate(parts), return_counts=True)
        rows = {s: [s, data, b""] for s, data in _by_slice(distinct, slices)}
        for s, data in _by_slice(distinct[counts > 1], slices):
            rows[s][2] = data
        columns = zip(*rows.values(), strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in
             zip(columns, (pa.int32(), pa.binary(), pa.binary()), strict=True)],
            ["slice", "hashes", "again"])

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for value in batch.column(0):
                own = np.unique(_hashes(set(line_keys(value.as_py(), least)) - {b""}))
                if len(own):
                    parts.append(own)
                    held += len(own)
                if held >= HELD:
                    yield flush(parts)
                    parts, held = [], 0
        if parts:
            yield flush(parts)

    return docs.select("_llm_text").mapInArrow(collect, schema)


def twice_seen(docs: DataFrame, least: int, slices: int) -> DataFrame:
    """``slice`` and ``filter``: the twice-seen Bloom filter of every slice with repeats."""
    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Rows come sorted by slice, so one pair of filters is held at a time.
        current, once, twice = None, None, None
        for frame in batches:
            for s, hashes, again in frame.itertuples(index=False):
                if s != current:
                    if twice is not None and twice.bits.any():
                        yield pd.DataFrame({"slice": [current], "filter": [twice.packed()]})
                    current, once, twice = s, Filter(), Filter()
                new = np.frombuffer(hashes, dtype="<u8")
                met = once.has(new)
                twice.add(new[met])
                once.add(new[~met])
                twice.add(np.frombuffer(again, dtype="<u8"))
        if twice is not None and twice.bits.any():
            yield pd.DataFrame({"slice": [current], "filter": [twice.packed()]})

    return (_task_hashes(docs, least, slices)
            .repartition("slice").sortWithinPartitions("slice")
            .mapInPandas(build, "slice int, filter binary"))


def _suspects_here(docs: DataFrame, least: int, filters: PackedFilters) -> DataFrame:
    """Digest and document of every line whose hash is in the broadcast filters."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = [], []
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                keys = list(set(line_keys(value.as_py(), least)) - {b""})
                if keys:
                    hits = np.flatnonzero(shared.value.has(_hashes(keys)))
                    found += [_digest(keys[i]) for i in hits]
                    ids += [doc] * len(hits)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(found, pa.binary())], [_ID, "digest"])

    return docs.select(_ID, "_llm_text").mapInArrow(probe, f"{_ID} long, digest binary")


def _packs(docs: DataFrame, least: int, slices: int) -> DataFrame:
    """Every document's distinct lines for the slice of their hash: in each row some ``ids``,
    ``hashes`` and ``digests`` of one slice, in one order. A task holds at most ``HELD`` lines."""
    HELD = 1 << 19

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, keys = [], []

        def flush() -> pa.RecordBatch:
            hashes = _hashes(keys)
            digests = np.frombuffer(b"".join(map(_digest, keys)), dtype="V16")
            docs_of = np.array([-1 if i is None else i for i in ids], dtype=np.int64)
            missing = np.array([i is None for i in ids])
            own = _slice_of(hashes, slices)
            order = np.argsort(own, kind="stable")
            starts = np.flatnonzero(np.diff(own[order], prepend=-1))
            at = [order[a:b] for a, b in zip(starts, [*starts[1:], len(order)], strict=True)]
            return pa.RecordBatch.from_arrays(
                [pa.array([int(own[x[0]]) for x in at], pa.int32()),
                 pa.array([pa.array(docs_of[x], mask=missing[x]).to_pylist() for x in at],
                          pa.list_(pa.int64())),
                 pa.array([hashes[x].astype("<u8").tobytes() for x in at], pa.binary()),
                 pa.array([digests[x].tobytes() for x in at], pa.binary()),
                 pa.array([len(x) for x in at], pa.int64())],
                ["slice", "ids", "hashes", "digests", "n"])

        for batch in batches:
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = set(line_keys(value.as_py(), least)) - {b""}
                keys += own
                ids += [doc] * len(own)
                if len(keys) >= HELD:
                    yield flush()
                    ids, keys = [], []
        if keys:
            yield flush()

    return docs.select(_ID, "_llm_text").mapInArrow(
        spread, "slice int, ids array<long>, hashes binary, digests binary, n long")


def _suspects_by_slice(docs: DataFrame, least: int, slices: int, filters: DataFrame,
                       part_lines: int = PART_LINES) -> DataFrame:
    """The same without a broadcast. Lines travel to their slice in packs, where the slice's filter
    comes first and the packs follow. A slice that a frequent line makes large is dealt to
    several parts of about ``part_lines`` lines, each with its own copy of the filter."""
    packed = stored(_packs(docs, least, slices))
    parts = packed.groupBy("slice").agg(
        F.greatest(F.ceil(F.sum("n") / part_lines), F.lit(1)).cast("int").alias("parts"))
    none = F.lit(None)
    dealt = packed.join(parts, "slice").select(
        "slice", F.pmod(F.xxhash64("hashes", "ids"), F.col("parts")).cast("int").alias("part"),
        F.lit(1).alias("kind"), none.cast("binary").alias("filter"), "ids", "hashes", "digests")
    first = filters.join(parts, "slice").select(
        "slice", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.lit(0).alias("kind"), "filter", none.cast("array<bigint>").alias("ids"),
        none.cast("binary").alias("hashes"), none.cast("binary").alias("digests"))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, twice = None, None
        for batch in batches:
            found_ids, found = [], []
            for i in range(batch.num_rows):
                place = (batch.column(0)[i].as_py(), batch.column(1)[i].as_py())
                if batch.column(2)[i].as_py() == 0:
                    current, twice = place, Filter.unpacked(batch.column(3)[i].as_py())
                elif place == current:
                    hashes = np.frombuffer(batch.column(5)[i].as_py(), dtype="<u8")
                    ids, digests = batch.column(4)[i].as_py(), batch.column(6)[i].as_py()
                    for h in np.flatnonzero(twice.has(hashes)):
                        found_ids.append(ids[h])
                        found.append(digests[16 * h:16 * h + 16])
                # A slice without a filter has no line twice.
            yield pa.RecordBatch.from_arrays(
                [pa.array(found_ids, pa.int64()), pa.array(found, pa.binary())], [_ID, "digest"])

    return (dealt.unionByName(first).repartition("slice", "part")
            .sortWithinPartitions("slice", "part", "kind")
            .mapInArrow(probe, f"{_ID} long, digest binary"))


def repeated_lines(docs: DataFrame, least_characters: int, least_documents: int,
                   broadcast_bytes: int, key: str, text: str) -> DataFrame:
    """Per document that loses lines: its id and ``drops``, the digests of their keys."""
    slim = docs.select(F.col(key).cast("bigint").alias(_ID), whole_text(text).alias("_llm_text"))
    lines = slim.agg(F.sum(F.length("_llm_text") + 1
                           - F.length(F.replace("_llm_text", F.lit("\n"))))).first()[0] or 0
    slices = max(1, math.ceil(lines * BITS_PER_LINE / SLICE_BITS))
    filters = twice_seen(slim, least_characters, slices)
    if slices * SLICE_BITS // 8 <= broadcast_bytes:
        held = PackedFilters({r["slice"]: bytes(r["filter"]) for r in filters.collect()}, slices)
        suspects = _suspects_here(slim, least_characters, held)
    else:
        suspects = _suspects_by_slice(slim, least_characters, slices, stored(filters))
    suspects = stored(suspects)
    # A document's repeated rows are one document; null is a document before all others.
    held = suspects.distinct()
    repeats = held.groupBy("digest").agg(
        F.count(F.lit(1)).alias("documents"), F.max(_ID).alias("_keeper"),
    ).filter(F.col("documents") >= least_documents).select("digest", "_keeper")
    return (held.join(repeats, "digest")
            .filter(~F.col(_ID).eqNullSafe(F.col("_keeper")))
            .groupBy(_ID).agg(F.collect_list("digest").alias("drops")))


def dedup_lines(docs: DataFrame, least_characters: int = LEAST_CHARACTERS,
                least_documents: int = LEAST_DOCUMENTS, broadcast_bytes: int = BROADCAST_BYTES,
                key: str = "doc_id", text: str = "text",
                names: tuple[str, str, str] = ("kept_text", "n_lines", "n_dropped")) -> DataFrame:
    """All rows and columns of ``docs``, with ``kept_text``, ``n_lines`` and ``n_dropped``, or
    what ``names`` calls them.

    A null or empty text is one empty line. Documents are told apart by ``key``: rows that
    repeat a key count as one document, and rows without one as a document before all others.
    Short keys never count. A document whose lines all go keeps its row, with an empty text.
    """
    clash = set(names) & set(docs.columns)
    if clash:
        raise ValueError(f"columns with these names are added here: {sorted(clash)}")
    drops = repeated_lines(docs, least_characters, least_documents, broadcast_bytes, key, text)

    @F.pandas_udf("text string, dropped long")
    def without(texts: pd.Series, lists: pd.Series) -> pd.DataFrame:
        rows = []
        for value, digests in zip(texts, lists, strict=True):
            if digests is None:
                rows.append((None, 0))
                continue
            gone = {bytes(d) for d in digests}
            lines = value.split("\n")
            left = [x for x, k in zip(lines, line_keys(value, least_characters), strict=True)
                    if not k or _digest(k) not in gone]
            rows.append(("\n".join(left), len(lines) - len(left)))
        return pd.DataFrame(rows, columns=["text", "dropped"])

    own = docs.withColumn(_ID, F.col(key).cast("bigint"))
    joined = own.join(drops.select(F.col(_ID).alias("_llm_drop_id"), F.col("drops").alias(
        "_llm_drops")).hint("shuffle_hash"), F.col(_ID).eqNullSafe(F.col("_llm_drop_id")), "left")
    value = whole_text(text)
    # Texts that lose nothing stay in the JVM.
    changed = joined.withColumn("_llm_left", without(
        F.when(F.col("_llm_drops").isNotNull(), value), "_llm_drops"))
    return changed.select(
        *docs.columns, F.coalesce("_llm_left.text", value).alias(names[0]),
        (F.length(value) + 1 - F.length(F.replace(value, F.lit("\n")))).cast("bigint")
        .alias(names[1]),
        F.col("_llm_left.dropped").alias(names[2]))


def line_digest(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: lines before, lines dropped, and SHA-256 of the text that is left."""
    return dedup_lines(docs.select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))
