"""Periodic runs in the words of a text, by a dictionary of basic factors.

A run is a stretch of consecutive words with smallest period q, at least twice as long, that no
neighbouring word extends with that period. All of them are found:

1. The dictionary names every factor (substring) of 2^k words, k = 0, 1, ...: two factors of one
   text have the same name exactly if they are equal. A factor's name comes from the names of its
   halves. Factors that occur once in their text get a name of their own and are never looked at
   again, so in plain prose little is left after a few doublings.
2. A run of period 2^k <= q < 2^(k+1) holds a factor of 2^k words that occurs again q words
   later, within twice the factor's length. The occurrences of a factor, in order, fall into
   arithmetic progressions; inside one, further multiples of its step are no smallest periods, and
   a pair of occurrences whose predecessors are equally far off tells nothing new. What is left,
   a number in proportion to the text for every k, proposes periods.
3. A proposed (place, period) is extended to both sides by comparing names from the longest
   factors down. Stretches that are long enough are kept once, each with its smallest period.

Many texts are worked on at a time, as one sequence of words whose names tell the texts apart,
so numpy's calls are few. Memory grows with words times the doublings that still find repeats.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import whole_text

LEAST_LENGTH = 12
#: Words worked on at a time, unless one text has more.
WORDS_AT_ONCE = 1 << 16


def words_of(text: str) -> list[bytes]:
    """Words in UTF-8, separated by ASCII white space."""
    return text.encode("utf-8", "surrogatepass").split()


@dataclass(frozen=True)
class Runs:
    """Runs of a sequence of words, ordered by start and period."""

    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


def _factor_names(names: np.ndarray) -> list[np.ndarray]:
    """Names of the factors of 1, 2, 4, ... words by place, as long as any occurs twice. A factor
    that occurs once has the negative name -1 - place, as has one that the sequence cuts off."""
    n = len(names)
    places = np.arange(n)
    levels: list[np.ndarray] = []
    live, keys = places, names
    while True:
        _, number, counts = np.unique(keys, return_inverse=True, return_counts=True)
        again = counts[number] > 1
        level = -1 - places
        level[live[again]] = number[again]
        if not again.any():
            return levels
        levels.append(level)
        half = 1 << (len(levels) - 1)
        live = live[again]
        live = live[live + half < n]
        live = live[level[live + half] >= 0]
        keys = level[live] * np.int64(n) + level[live + half]


def _proposals(names: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods, from ``length`` to below twice that, by the factors of ``length`` words."""
    live = np.flatnonzero(names >= 0)
    order = live[np.argsort(names[live], kind="stable")]
    m = len(order)
    same = names[order[1:]] == names[order[:-1]]
    gap = np.zeros(m, dtype=np.int64)  # to the next occurrence of the same factor, 0 for none
    gap[:-1] = np.where(same, np.diff(order), 0)
    before = np.zeros(m, dtype=np.int64)
    before[1:] = gap[:-1]
    # The last occurrence of the progression that goes on from here.
    ends = np.flatnonzero(np.append(gap[1:] != gap[:-1], True)) + 1
    last = np.minimum(ends[np.searchsorted(ends, np.arange(m), side="right")], m - 1)

    found_at, found_period = [], []
    a = np.flatnonzero((gap > 0) & (gap < 2 * length))
    # Within the first progression only its step can be a smallest period.
    first = a[~((before[a] == gap[a]) & (gap[a] <= length))]
    found_at.append(order[first])
    found_period.append(gap[first])
    c = np.where(gap[a] <= length, last[a], a + 1)
    while len(a):
        step = gap[c]
        room = 2 * length - 1 - (order[c] - order[a])
        goes_on = (step > 0) & (step <= room)
        a, c, step, room = a[goes_on], c[goes_on], step[goes_on], room[goes_on]
        # Pairs whose predecessors are as far apart lie in the same run as those.
        new = ~((before[a] == step) & (step <= length))
        many = np.where(new, np.minimum(last[c] - c, room // np.maximum(step, 1)), 0)
        turn = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + 1
        at = np.repeat(order[a], many)
        found_at.append(at)
        found_period.append(np.repeat(order[c], many) - at + turn * np.repeat(step, many))
        c = last[c]
    at, period = np.concatenate(found_at), np.concatenate(found_period)
    good = period >= length
    return at[good], period[good]


def _common(levels: list[np.ndarray], left: np.ndarray, right: np.ndarray,
            backward: bool) -> np.ndarray:
    """For how many words from ``left`` and ``right`` on, or before them, the texts agree."""
    n, total = len(levels[0]), np.zeros(len(left), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        half = 1 << k
        x, y = (left - total - half, right - total - half) if backward else (
            left + total, right + total)
        inside = (x >= 0) & (y < n)
        names = levels[k]
        total += half * (inside & (names[np.where(inside, x, 0)] == names[np.where(inside, y, 1)]))
    return total


def find_runs(names: np.ndarray, least: int = LEAST_LENGTH) -> Runs:
    """All runs of at least ``least`` words in a sequence of words, given as equal numbers for
    equal words."""
    none = np.zeros(0, dtype=np.int64)
    levels = _factor_names(np.asarray(names, dtype=np.int64)) if len(names) > 1 else []
    starts, ends, periods = [none], [none], [none]
    for k, level in enumerate(levels):
        at, period = _proposals(level, 1 << k)
        start = at - _common(levels, at, at + period, backward=True)
        end = at + period + _common(levels, at, at + period, backward=False)
        good = end - start >= np.maximum(least, 2 * period)
        starts.append(start[good])
        ends.append(end[good])
        periods.append(period[good])
    start, end, period = map(np.concatenate, (starts, ends, periods))
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    # A stretch with a smaller period too comes behind itself.
    new = np.append(True, (np.diff(start) != 0) | (np.diff(end) != 0)) if len(start) else none
    keep = np.flatnonzero(new)
    keep = keep[np.lexsort((period[keep], start[keep]))]
    return Runs(start[keep], end[keep] - start[keep], period[keep])


def dropped_words(runs: Runs, n: int) -> np.ndarray:
    """Which of ``n`` words stand in a run behind its first period."""
    depth = np.zeros(n + 1, dtype=np.int64)
    np.add.at(depth, runs.start + runs.period, 1)
    np.add.at(depth, runs.start + runs.length, -1)
    return np.cumsum(depth[:n]) > 0


def made_periodic(words: list[bytes], key: int | None) -> list[bytes]:
    """The words, of every tenth key or so with a planted period. Without a key as they are."""
    h = zlib.crc32(str(key).encode()) if key is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def _of_many(texts: list[list[bytes]], least: int) -> Iterator[Runs]:
    """The runs of each text, found in one go."""
    numbers: list[int] = []
    sizes = []
    known: dict[bytes, int] = {}
    for words in texts:
        # Later texts count on, so no word of one text is a word of another.
        base, own = len(known), len(numbers)
        known = {}
        numbers += [known.setdefault(w, len(known)) for w in words]
        sizes.append((own, len(words), base))
    names = np.array(numbers, dtype=np.int64)
    offset = 0
    for own, n, base in sizes:
        offset += base
        names[own:own + n] += offset
    runs = find_runs(names, least)
    bounds = np.searchsorted(runs.start, [own for own, _, _ in sizes] + [len(names)])
    for (own, _, _), a, b in zip(sizes, bounds[:-1], bounds[1:], strict=True):
        yield Runs(runs.start[a:b] - own, runs.length[a:b], runs.period[a:b])


def summary(words: list[bytes], runs: Runs) -> tuple:
    """Number of runs; start, length, period and exponent of the longest (smallest start, then
    period, among equals); digests of all runs and of the words that are left."""
    lines = "".join(f"{s},{x},{q}\n" for s, x, q in zip(
        runs.start.tolist(), runs.length.tolist(), runs.period.tolist(), strict=True))
    best = (None,) * 4
    if len(runs.start):
        i = int(np.lexsort((runs.period, runs.start, -runs.length))[0])
        s, x, q = int(runs.start[i]), int(runs.length[i]), int(runs.period[i])
        best = (s, x, q, 1000 * x // q)
        gone = dropped_words(runs, len(words))
        words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
    return (len(runs.start), *best, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(b" ".join(words)).hexdigest())


_KINDS = {"n_runs": pa.int64(), "start": pa.int64(), "length": pa.int64(), "period": pa.int64(),
          "exponent_milli": pa.int64(), "runs_sha256": pa.string(),
          "collapsed_sha256": pa.string()}


def runs_of(docs: DataFrame, key: str = "doc_id", text: str = "text",
            least: int = LEAST_LENGTH) -> DataFrame:
    """``key``, ``start``, ``length`` and ``period`` of every run of every row's text. A null text
    has none; rows that repeat a key each give their runs."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, columns = [], [[], [], []]
            for group in _grouped(batch):
                texts = [words_of(batch.column(1)[i].as_py()) for i in group]
                for i, runs in zip(group, _of_many(texts, least), strict=True):
                    ids += [i] * len(runs.start)
                    for column, values in zip(columns, (runs.start, runs.length, runs.period),
                                              strict=True):
                        column += values.tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(ids, pa.int64())),
                 *(pa.array(c, pa.int64()) for c in columns)], ["key", "start", "length", "period"])

    kind = docs.select(key).dtypes[0][1]
    return (docs.select(F.col(key).alias("key"), whole_text(text))
            .mapInArrow(find, f"key {kind}, start long, length long, period long")
            .withColumnRenamed("key", key))


def _grouped(batch: pa.RecordBatch) -> Iterator[list[int]]:
    """Rows of a batch that are worked on together: so many that their texts have about
    ``WORDS_AT_ONCE`` words at six bytes each, and one at least."""
    group, size = [], 0
    for i in range(batch.num_rows):
        own = len(batch.column(1)[i].as_buffer() or b"") // 6
        if group and size + own > WORDS_AT_ONCE:
            yield group
            group, size = [], 0
        group.append(i)
        size += own
    if group:
        yield group


def run_digest(docs: DataFrame) -> DataFrame:
    """One row of digests per row of ``docs``, whose texts get planted periods first.

    Null and empty texts have no words and no run; rows without a key get no planted period.
    """
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in _grouped(batch):
                ids = [batch.column(0)[i].as_py() for i in group]
                texts = [made_periodic(words_of(batch.column(1)[i].as_py()), key)
                         for i, key in zip(group, ids, strict=True)]
                rows = [(key, *summary(words, runs)) for key, words, runs in zip(
                    ids, texts, _of_many(texts, LEAST_LENGTH), strict=True)]
                kinds = (pa.int64(), *_KINDS.values())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                    ["doc_id", *_KINDS])

    fields = ", ".join(f"{n} {'long' if k == pa.int64() else 'string'}" for n, k in _KINDS.items())
    return docs.select(F.col("doc_id").cast("bigint"), whole_text()).mapInArrow(
        digest, f"doc_id long, {fields}")
