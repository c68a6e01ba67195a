import hashlib
import random
from collections import Counter, defaultdict

import pytest
from larkspur.llm.common import whole_text
from larkspur.llm.line_dedup import (_ID, _suspects_by_slice, dedup_lines, line_digest,
                                     twice_seen)
from llm_data import ODD
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"


def plain(rows, least=20, documents=3):
    def key(line):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(BLANKS))

    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least:
                holders[key(line)].add(-1 if i is None else i)
    out = Counter()
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders[key(x)]) < documents
                or max(holders[key(x)]) == (-1 if i is None else i)]
        out[i, len(lines), len(lines) - len(kept),
            hashlib.sha256("\n".join(kept).encode()).hexdigest()] += 1
    return out


def made(n=80, seed=1):
    rng = random.Random(seed)
    shared = [f"this line is shared by many documents, number {i}" for i in range(15)]
    rows = list(ODD)
    for i in range(n):
        lines = []
        for _ in range(rng.randrange(12)):
            line = rng.choice(shared) if rng.random() < 0.4 else f"own line {rng.random()} of {i}"
            lines.append(rng.choice(["", " ", "\t"]) + rng.choice([line, line.upper(), line[:19]])
                         + rng.choice(["", "\r", "\x0b "]))
        rows.append((50 + i, "\n".join(lines)))
    return rows + [(60, shared[0]), (60, shared[0]), (None, shared[1]), (61, "İ" * 25), (62, "İ" * 25),
                   (63, "İ" * 25)]


def test_against_brute_force(docs):
    rows = made()
    assert Counter(map(tuple, line_digest(docs(rows)).collect())) == plain(rows)


@pytest.mark.parametrize("broadcast_bytes", [64 << 20, 0])
def test_both_ways_to_probe_find_the_same(docs, broadcast_bytes):
    rows = made(40, 2)
    got = dedup_lines(docs(rows), broadcast_bytes=broadcast_bytes)
    assert got.columns == [*docs(rows).columns, "kept_text", "n_lines", "n_dropped"]
    assert Counter((r.doc_id, r.n_lines, r.n_dropped,
                    hashlib.sha256(r.kept_text.encode()).hexdigest())
                   for r in got.collect()) == plain(rows)


def test_twenty_code_points_and_three_documents(docs):
    rows = [(1, "é" * 20), (2, "é" * 20), (3, "é" * 20 + "\nrest"), (4, "b" * 19), (5, "b" * 19),
            (6, "b" * 19), (7, "c" * 20), (8, "c" * 20)]
    kept = {r.doc_id: r.kept_text for r in dedup_lines(docs(rows)).collect()}
    assert kept == {1: "", 2: "", 3: "é" * 20 + "\nrest", 4: "b" * 19, 5: "b" * 19, 6: "b" * 19,
                    7: "c" * 20, 8: "c" * 20}


def test_empty_and_clashing(docs):
    assert line_digest(docs([(1, "a")]).filter("false")).collect() == []
    with pytest.raises(ValueError, match="n_lines"):
        dedup_lines(docs([(1, "a")]).withColumnRenamed("source", "n_lines"))


def test_slices_in_parts_lose_no_repeated_line(docs):
    rows = made(60, 3)
    slim = docs(rows).select(F.col("doc_id").alias(_ID), whole_text().alias("_llm_text"))
    suspects = _suspects_by_slice(slim, 20, 7, twice_seen(slim, 20, 7), part_lines=10)
    found = Counter(r.digest for r in suspects.distinct().collect())
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            key = line.strip(BLANKS).encode().lower()
            if len(key.decode()) >= 20:
                holders[hashlib.blake2b(key, digest_size=16).digest()].add(i)
    for digest, ids in holders.items():
        assert len(ids) == 1 or found[digest] == len(ids)
