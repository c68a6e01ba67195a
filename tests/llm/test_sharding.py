import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from larkspur.llm.sharding import (assign_shards, permuted, place, row_number, shard_digest,
                                   shard_documents)
from llm_data import ODD


@pytest.mark.parametrize("rows", [1, 2, 3, 7, 64, 1000, 4097])
def test_permutation_and_inverse(rows):
    p = permuted(np.arange(rows), rows, seed=5)
    assert sorted(p.tolist()) == list(range(rows))
    assert (permuted(p, rows, 5, inverse=True) == np.arange(rows)).all()


def test_place_of_one_row_can_be_computed_both_ways():
    for n in range(50):
        assert row_number(*place(n, 50, 7, 3), 50, 7, 3) == n


def check_places(rows, shards):
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    sizes = [len(slots[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_digest(docs, odd):
    rows = shard_digest(odd).collect()
    assert len(rows) == len(ODD)
    check_places(rows, 24)
    expected = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()))
                       for i, t in ODD)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == expected
    assert {r.law for r in rows} == {"rows"} and all(r.grown_shard is None for r in rows)


def test_places_do_not_follow_partitions(docs):
    rows = [(i % 40, f"text {i % 55}") for i in range(400)]
    got = [sorted(map(tuple, shard_digest(docs(rows, p)).drop("number").collect()), key=str)
           for p in (1, 5)]
    assert got[0] == got[1]


def test_one_hot_row(docs):
    rows = [(7, "the same")] * 300 + [(i, "other") for i in range(100)]
    placed = assign_shards(docs(rows).select("doc_id", "text"), ["doc_id"], 6).collect()
    assert sorted(r["number"] for r in placed) == list(range(400))
    check_places(placed, 6)


def test_documents_keep_their_columns(odd):
    placed = shard_documents(odd, 4)
    assert placed.columns == [*odd.columns, "shard", "slot"]
    rows = placed.collect()
    check_places(rows, 4)
    assert Counter((r.doc_id, r.text) for r in rows) == Counter(ODD)


def test_empty_and_clashing(docs):
    assert shard_digest(docs([(1, "a")]).filter("false")).collect() == []
    with pytest.raises(ValueError, match="slot"):
        assign_shards(docs([(1, "a")]).withColumnRenamed("source", "slot"), ["doc_id"], 2)
