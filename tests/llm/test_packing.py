import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from larkspur.llm.packing import (chunks, cuts, pack_documents, packed_sequences, packing_plan,
                                  token_ids)
from llm_data import ODD
from tokenizers import Tokenizer


@pytest.fixture(scope="module")
def plain():
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: exact.encode(text or "", add_special_tokens=False).ids + [2]


def test_fast_ids_are_the_ids_of_the_file(plain):
    rng = random.Random(1)
    parts = ["the", " word", "'s", "12", " 345", "!?", "\n", "\r\n", "  ", "\t", "é", "ß", "😀",
             "<|endoftext|>", " ", "x" * 40, "ﬀ", "\x00", " 's", "°", "½"]
    texts = [t for _, t in ODD] + ["".join(rng.choice(parts) for _ in range(rng.randrange(60)))
                                   for _ in range(400)]
    for text in texts:
        assert token_ids(text or "").tolist() == plain(text)


def test_chunks_do_not_change_ids(plain):
    rng = random.Random(2)
    text = " ".join(rng.choice(["alpha", "12", "it's", "-", "Ünder", "\n\nnew", "z"])
                    for _ in range(3000))
    parts = list(chunks(text, 500))
    assert len(parts) > 10 and "".join(parts) == text
    assert [i for p in parts for i in plain(p)[:-1]] == plain(text)[:-1]


def test_only_the_first_piece_may_be_shorter():
    assert cuts(1, 1024) == [(0, 1)] and cuts(1024, 1024) == [(0, 1024)]
    assert cuts(2500, 1024) == [(0, 452), (452, 1024), (1476, 1024)]


@pytest.mark.parametrize("seed", range(4))
def test_plan_holds_every_piece_and_wastes_little(seed):
    rng = np.random.default_rng(seed)
    lengths = np.minimum(1024, rng.lognormal(5, 1.2, 20000).astype(int) + 1)
    counts = Counter(lengths.tolist())
    plan = packing_plan(counts)
    used = Counter()
    for use in plan:
        assert use.repeats > 0 and sum(use.lengths) <= 1024
        for length in use.lengths:
            used[length] += use.repeats
    assert used == counts
    least = -(-int(lengths.sum()) // 1024)
    assert sum(u.repeats for u in plan) <= least * 1.01 + 2


def check(rows, placed, plain):
    pieces = defaultdict(list)
    by_sequence = defaultdict(list)
    for r in placed:
        by_sequence[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    for own in by_sequence.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 1024
    expected = defaultdict(list)
    for i, text in rows:
        ids = plain(text)
        for n, (start, length) in enumerate(cuts(len(ids), 1024)):
            part = np.array(ids[start:start + length], dtype="<u4").tobytes()
            expected[i].append((n, start, length, zlib.crc32(part)))
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in expected.items()}


def test_pieces_and_places(docs, plain):
    rng = random.Random(3)
    rows = ODD + [(100 + i, " ".join(rng.choice(["some", "words", "é", "7"])
                                     for _ in range(rng.choice([3, 50, 900, 4000]))))
                  for i in range(60)] + [(500, "hot copy of a text")] * 40
    check(rows, pack_documents(docs(rows)).collect(), plain)


def test_sequences_hold_the_ids(docs, plain):
    rows = [(1, "a short text"), (2, None), (3, "word " * 2000)]
    got = Counter(i for r in packed_sequences(docs(rows)).collect() for i in r.ids)
    assert got == Counter(i for _, t in rows for i in plain(t))


def test_empty(docs):
    assert pack_documents(docs([(1, "a")]).filter("false")).collect() == []
