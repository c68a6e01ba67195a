"""Packing documents into sequences by fitted length patterns.

Documents become pieces of at most ``capacity`` tokens. What decides the packing is only the
histogram of piece lengths, at most ``capacity`` numbers however many documents there are:

1. Patterns of up to three lengths that fill a sequence exactly are enumerated.
2. Non-negative least squares fits how often each pattern is used to the histogram.
3. Repeats are rounded down and cut back to the pieces there are.
4. The pieces left over are packed by best fit, longest first, again on counts.

The plan, a list of (pattern, repeats), is turned into places on Spark: the r-th piece of a
length looks up which use of which pattern it belongs to.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import numbered, whole_text
from larkspur.session import stored

CAPACITY = 1024
END_OF_TEXT = 2
TOKENIZER = "byte_bpe_50k.json"
#: The same vocabulary as ranks, for a faster library; "" to do without.
RANKS = "byte_bpe_50k.tiktoken"

# --- tokens ---

#: Texts of these characters without two white spaces in a row are split alike with and without
#: the public pattern's look-ahead, and no two libraries differ on their classes.
_PLAIN = re.compile(r"[^\t\n\r\x20-\x7e¡-¬®-ÿ]|\s\s|<\|endoftext\|>")
#: The public pattern of the vocabulary (a fixed value) without its look-ahead for white space.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"
#: No token reaches across a blank between two letters, so a long text may be cut there.
_CUT = re.compile(r"(?<=[A-Za-z])(?= [A-Za-z])")
CHUNK = 1 << 18


@lru_cache(maxsize=4)
def _encoder(tokenizer: str, ranks: str):
    """A function from a text without limits on length to its ids; one per Python worker."""
    import base64
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import public_tokenizers
    from tokenizers import Tokenizer

    def path(name: str) -> str:
        return name if os.path.isabs(name) else public_tokenizers.path(name)

    exact, fast = Tokenizer.from_file(path(tokenizer)), None
    if ranks:
        import tiktoken

        with open(path(ranks), "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        fast = tiktoken.Encoding("ranks", pat_str=_PATTERN, mergeable_ranks=table,
                                 special_tokens={})

    def encode(text: str) -> list[int]:
        if fast is not None and not _PLAIN.search(text):
            return fast.encode_ordinary(text)
        return exact.encode(text, add_special_tokens=False).ids

    return encode


def chunks(text: str, size: int = CHUNK) -> Iterator[str]:
    """The text in parts that can be encoded one by one."""
    start = 0
    while len(text) - start > size:
        cut = _CUT.search(text, start + size)
        if not cut:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


def token_ids(text: str, tokenizer: str = TOKENIZER, ranks: str = RANKS) -> np.ndarray:
    """The ids of a whole text and the closing id, 4 bytes each."""
    encode = _encoder(tokenizer, ranks)
    parts = [np.array(encode(part), dtype="<u4") for part in chunks(text)]
    return np.concatenate([*parts, np.array([END_OF_TEXT], dtype="<u4")])


def cuts(length: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces: one, or a first shorter one and then full ones."""
    first = (length - 1) % capacity + 1
    return [(0, first)] + [(s, capacity) for s in range(first, length, capacity)]


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER,
                 ranks: str = RANKS, with_ids: bool = False, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32`` and, on request, ``ids``.

    A null text is an empty one; an empty text is one piece with only the closing id.
    """
    fields = "doc_id long, piece int, start long, length long, ids_crc32 long"
    if with_ids:
        fields += ", ids array<int>"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = token_ids(value.as_py(), tokenizer, ranks)
                for i, (start, length) in enumerate(cuts(len(ids), capacity)):
                    own = ids[start:start + length]
                    row = (doc, i, start, length, zlib.crc32(own.tobytes()))
                    rows.append((*row, own.astype(np.int32)) if with_ids else row)
            names = [f.split()[0] for f in fields.split(", ")]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(),
                     pa.list_(pa.int32())]
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=False)], names)

    return docs.select(F.col(key).cast("bigint"), whole_text(text)).mapInArrow(cut, fields)


# --- plan ---

@dataclass(frozen=True)
class Use:
    """``repeats`` sequences, each holding one piece of every length in ``lengths``."""
    lengths: tuple[int, ...]
    repeats: int


def patterns(capacity: int, present: np.ndarray) -> list[tuple[int, ...]]:
    """One, two or three of the present lengths that add up to ``capacity``."""
    has = np.zeros(capacity + 1, dtype=bool)
    has[present] = True
    found: list[tuple[int, ...]] = [(capacity,)] if has[capacity] else []
    found += [(a, capacity - a) for a in range((capacity + 1) // 2, capacity)
              if has[a] and has[capacity - a]]
    lengths = np.flatnonzero(has[:capacity])
    for a in lengths[::-1]:
        b = lengths[(lengths <= a) & (2 * lengths >= capacity - a) & (lengths < capacity - a)]
        c = capacity - a - b
        good = has[c]
        found += [(int(a), int(x), int(y)) for x, y in zip(b[good], c[good], strict=True)]
    return found


def fitted_repeats(slots: np.ndarray, histogram: np.ndarray, support: int = 64,
                   rounds: int = 24, steps: int = 150) -> np.ndarray:
    """Repeats ``x >= 0`` that make the pieces used, ``A x``, close to the histogram.

    ``slots`` has a row of lengths per pattern, filled up with 0. The fit works on a growing
    set of patterns: the ones with the steepest gradient join it, and accelerated projected
    gradient steps refit it. So few patterns carry large repeats, and rounding costs little.
    """
    n = histogram.astype(float).copy()
    n[0] = 0
    x = np.zeros(len(slots))
    chosen = np.flatnonzero((slots > 0).sum(1) <= 2)

    def used(index: np.ndarray, values: np.ndarray) -> np.ndarray:
        total = np.zeros(len(n))
        for column in slots[index].T:
            np.add.at(total, column, values)
        total[0] = 0
        return total

    for _ in range(rounds):
        if len(chosen):
            own = slots[chosen]
            degree = used(chosen, np.ones(len(chosen)))
            step = 1 / max(1.0, 3 * degree.max())
            at, look, t = x[chosen], x[chosen], 1.0
            for _ in range(steps):
                rest = n - used(chosen, look)
                rest[0] = 0
                new = np.maximum(0, look + step * rest[own].sum(1))
                faster = (1 + (1 + 4 * t * t) ** 0.5) / 2
                look, at, t = new + (t - 1) / faster * (new - at), new, faster
            x[chosen] = at
        rest = n - used(np.arange(len(slots)), x)
        rest[0] = 0
        gain = rest[slots].sum(1)
        gain[chosen] = 0
        best = np.argsort(-gain, kind="stable")[:support]
        best = best[gain[best] > 0]
        if not len(best):
            break
        chosen = np.union1d(chosen, best)
    return x


def best_fit(counts: dict[int, int], capacity: int) -> list[Use]:
    """Best fit, longest first, on counts: equal sequences stay together as one entry."""
    open_by_room: dict[int, list[list]] = {}
    rooms: list[int] = []

    def put(lengths: tuple[int, ...], many: int) -> None:
        room = capacity - sum(lengths)
        if room not in open_by_room:
            open_by_room[room] = []
            bisect.insort(rooms, room)
        open_by_room[room].append([lengths, many])

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            i = bisect.bisect_left(rooms, length)
            if i == len(rooms):
                each = capacity // length
                if left >= each:
                    put((length,) * each, left // each)
                if left % each:
                    put((length,) * (left % each), 1)
                break
            room = rooms[i]
            entries = open_by_room[room]
            lengths, many = entries.pop()
            if not entries:
                del open_by_room[room]
                rooms.pop(i)
            each = min(room // length, left)
            taken = min(many, left // each)
            if many > taken:
                put(lengths, many - taken)
            put(lengths + (length,) * each, taken)
            left -= taken * each
    return [Use(lengths, many) for entries in open_by_room.values() for lengths, many in entries]


def packing_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Use]:
    """Uses of patterns that hold every piece of the histogram exactly once."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, many in histogram.items():
        if not 1 <= length <= capacity:
            raise ValueError(f"a piece of {length} tokens does not fit")
        left[length] = many
    plan = []
    listed = patterns(capacity, np.flatnonzero(left))
    if listed:
        slots = np.zeros((len(listed), 3), dtype=np.int64)
        for i, lengths in enumerate(listed):
            slots[i, :len(lengths)] = lengths
        repeats = fitted_repeats(slots, left)
        for i in np.argsort(-repeats, kind="stable"):
            lengths = listed[i]
            many = min([int(repeats[i]), *(int(left[x]) // lengths.count(x) for x in lengths)])
            if many > 0:
                plan.append(Use(lengths, many))
                for x in lengths:
                    left[x] -= many
    rest = {int(x): int(left[x]) for x in np.flatnonzero(left)}
    return plan + best_fit(rest, capacity)


# --- places ---

@dataclass(frozen=True)
class Lookup:
    """Where the r-th piece of a length goes; as many rows as the plan has slots."""
    keys: np.ndarray
    first: np.ndarray
    each: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray

    #: Ranks below this share a key with their length.
    SPAN = 1 << 44

    @classmethod
    def of(cls, plan: list[Use]) -> Lookup:
        rows, taken, sequence = [], {}, 0
        for use in plan:
            offset, done = 0, 0
            while done < len(use.lengths):
                length = use.lengths[done]
                each = 1
                while done + each < len(use.lengths) and use.lengths[done + each] == length:
                    each += 1
                rank = taken.get(length, 0)
                rows.append((length * cls.SPAN + rank, rank, each, sequence, offset))
                taken[length] = rank + each * use.repeats
                offset += each * length
                done += each
            sequence += use.repeats
        columns = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5).T
        return cls(*columns)

    def places(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        i = np.searchsorted(self.keys, length * self.SPAN + rank, side="right") - 1
        turn = rank - self.first[i]
        return (self.sequence[i] + turn // self.each[i],
                self.offset[i] + turn % self.each[i] * length)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (``doc_id``, ``piece``, ``length`` and others) with ``sequence_id`` and
    ``offset``.

    Pieces are read more than once, so give a stored table. Which of several pieces of one
    length goes where follows from their contents. No pieces give no rows. The plan that
    every task holds has a few thousand rows, bounded by ``capacity`` and not by the input.
    """
    counts = {int(r.length): int(r.many) for r in
              pieces.groupBy("length").agg(F.count(F.lit(1)).alias("many")).collect()}
    lookup = Lookup.of(packing_plan(counts, capacity))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = lookup.places(length.to_numpy(), rank.to_numpy())
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    ranked = numbered(pieces, [c for c in ("doc_id", "piece") if c in pieces.columns],
                      ["length"], "_rank", buckets=64)
    return (ranked.withColumn("_place", place("length", "_rank"))
            .select(*pieces.columns, "_place.sequence_id", "_place.offset"))


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER,
                   ranks: str = RANKS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's pieces with their places; see :func:`token_pieces`, :func:`pack`.

    Nulls, empty texts, repeated rows and other columns of ``docs`` do no harm: each row is a
    document of its own, and only key and text are looked at.
    """
    return pack(stored(token_pieces(docs, capacity, tokenizer, ranks, key=key, text=text)),
                capacity)


def packed_sequences(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER,
                     ranks: str = RANKS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``sequence_id`` and the sequence's ``ids``, at most ``capacity`` of them."""
    pieces = stored(token_pieces(docs, capacity, tokenizer, ranks, True, key, text))
    placed = pack(pieces, capacity)
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(
        F.flatten(F.transform(ordered, lambda p: p.getField("ids"))).alias("ids"))
