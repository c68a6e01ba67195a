import hashlib
import random
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from larkspur.llm.runs import find_runs, run_digest, runs_of
from llm_data import ODD
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"


def plain_runs(words, least=12):
    """Every period in turn; a stretch belongs to the smallest."""
    found = {}
    n = len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(least, 2 * q):
                found.setdefault((start, i + q - start), q)
    return sorted((s, x, q) for (s, x), q in found.items())


def as_rows(runs):
    return [tuple(map(int, r)) for r in zip(runs.start, runs.length, runs.period)]


def plain_words(text):
    words, word = [], ""
    for c in (text or "") + " ":
        if c in BLANKS:
            if word:
                words.append(word)
            word = ""
        else:
            word += c
    return words


def plain(rows):
    out = Counter()
    for key, text in rows:
        words = plain_words(text)
        h = zlib.crc32(str(key).encode())
        n, g = len(words), h // 10
        if key is not None and h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(words)
        gone = {i for s, x, q in runs for i in range(s + q, s + x)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        lines = "".join(f"{s},{x},{q}\n" for s, x, q in runs)
        left = " ".join(w for i, w in enumerate(words) if i not in gone)
        out[key, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(left.encode()).hexdigest()] += 1
    return out


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=70), st.integers(2, 12))
def test_all_runs_of_short_sequences(words, least):
    assert as_rows(find_runs(np.array(words, dtype=np.int64), least)) == plain_runs(words, least)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 1), min_size=1, max_size=9),
                          st.integers(1, 9), st.integers(0, 8)), max_size=5))
def test_all_runs_of_nested_repetitions(parts):
    words = []
    for block, times, cut in parts:
        words += block * times + block[:cut]
    words = words + words[:len(words) // 2] + words
    assert as_rows(find_runs(np.array(words, dtype=np.int64), 2)) == plain_runs(words, 2)


@pytest.mark.parametrize("seed", range(4))
def test_all_runs_of_fibonacci_and_thue_like_words(seed):
    a, b = [0], [0, 1]
    while len(b) < 900:
        a, b = b, b + a
    rng = random.Random(seed)
    words = list(b)
    for _ in range(seed * 3):
        words[rng.randrange(len(words))] = 2
    assert as_rows(find_runs(np.array(words, dtype=np.int64), 2)) == plain_runs(words, 2)


@pytest.mark.parametrize("block", [1, 2, 7, 5000])
def test_time_in_proportion_for_long_repetitions(block):
    def seconds(n):
        words = np.arange(n, dtype=np.int64) % block
        words[n // 2] = block + 1
        start = time.perf_counter()
        find_runs(words)
        return time.perf_counter() - start

    seconds(1 << 12)
    assert seconds(1 << 18) < 12 * seconds(1 << 16) + 1


def test_digest_against_brute_force(docs):
    rng = random.Random(4)
    rows = list(ODD)
    for i in range(100, 190):
        words = [rng.choice(["a", "b", "Ab", "é", "x y"]) for _ in range(rng.randrange(90))]
        if i % 3 == 0:
            at = rng.randrange(len(words) + 1)
            words[at:at] = [rng.choice("abc") for _ in range(rng.randrange(1, 9))] * rng.randrange(9)
        rows.append((i, rng.choice([" ", "\n", "\t \x0b"]).join(words)))
    rows += [(i, "".join(f"w{j} " for j in range(40))) for i in range(200, 240)]
    assert Counter(map(tuple, run_digest(docs(rows)).collect())) == plain(rows)


def test_runs_as_rows(docs):
    rows = [(1, "a b " * 8 + "c"), (2, None), (None, "x " * 12), (1, "a b " * 8 + "c")]
    got = Counter(map(tuple, runs_of(docs(rows)).collect()))
    assert got == Counter({(1, 0, 16, 2): 2, (None, 0, 12, 1): 1})


def test_empty_long_and_clashing(docs):
    none = docs([(1, "a")]).filter("false")
    assert run_digest(none).collect() == [] and runs_of(none).collect() == []
    long = docs([(11, "one two three " * 100_000)]).withColumns(
        {c: F.lit(0) for c in ("start", "length", "key", "n_runs")})
    row = run_digest(long).first()
    assert (row.n_runs, row.start, row.length, row.period) == (1, 0, 300_000, 3)
