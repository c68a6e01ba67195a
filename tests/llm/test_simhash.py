import random
from collections import Counter

import pytest
import xxhash
from larkspur.llm.simhash import fingerprint, keep_one, links, masks, near_duplicates
from llm_data import ODD


def plain_fingerprint(text):
    words, word = [], ""
    for c in (text or "") + " ":
        if c in " \t\n\x0b\x0c\r":
            if word:
                words.append(word)
            word = ""
        else:
            word += chr(ord(c) + 32) if "A" <= c <= "Z" else c
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64)
               if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(values, radius=3):
    """Smallest member reachable, by comparing everything."""
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a in values:
        for b in values:
            if a < b and (a ^ b).bit_count() <= radius:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {v: find(v) for v in values}


def test_fingerprint_by_definition():
    rng = random.Random(2)
    texts = [t for _, t in ODD] + [
        " ".join(rng.choice(["Ab", "cd", "é", "İx", "z\n"]) for _ in range(rng.randrange(40)))
        for _ in range(60)]
    for text in texts:
        assert fingerprint(text or "") == plain_fingerprint(text)


def test_every_near_pair_collides_in_some_table():
    rng = random.Random(3)
    looked = [int(m) for m in masks()]
    assert len(looked) == 15
    for _ in range(3000):
        difference = sum(1 << b for b in rng.sample(range(64), rng.randrange(4)))
        assert any(not difference & m for m in looked)


@pytest.mark.parametrize("bucket_nodes", [512, 1])
def test_links_give_the_components_of_all_pairs(spark, bucket_nodes):
    rng = random.Random(4)
    values = set()
    for _ in range(25):
        value = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 7)):
            values.add(value)
            for b in rng.sample(range(64), rng.randrange(1, 5)):
                value ^= 1 << b
    signed = {v - (1 << 64) if v >> 63 else v: v for v in values}
    rows = links(spark.createDataFrame([(s,) for s in signed], "fp long"),
                 bucket_nodes=bucket_nodes).collect()
    found = {v: v for v in values}

    def find(v):
        while found[v] != v:
            v = found[v]
        return v

    for r in rows:
        a, b = signed[r.u], signed[r.v]
        x, y = sorted((find(a), find(b)))
        found[y] = x
    assert {v: find(v) for v in values} == components(values)


def expected_rows(rows):
    fps = [(i, plain_fingerprint(t)) for i, t in rows]
    roots = components({f for _, f in fps})
    least = {}
    for i, f in fps:
        if i is not None:
            least[roots[f]] = min(i, least.get(roots[f], i))
    return Counter((i, f"{f:016x}", least.get(roots[f])) for i, f in fps)


def test_digest_against_all_pairs(docs):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    rows = list(ODD)
    for group in range(12):
        base = [rng.choice(words) for _ in range(200)]
        for copy in range(5):
            own = list(base)
            for _ in range(copy):
                own[rng.randrange(len(own))] = rng.choice(words)
            rows.append((100 + group * 10 + copy, " ".join(own)))
    got = Counter(map(tuple, near_duplicates(docs(rows)).collect()))
    assert got == expected_rows(rows)


def test_keep_one_keeps_the_smallest_key_of_each_component(docs):
    rows = [*ODD, (20, "SAME text\there"), (21, "quite another text than that")]
    kept = keep_one(docs(rows))
    assert kept.columns == docs(rows).columns
    expected = [i for i in {r[2] for r in expected_rows(rows)}]
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(expected, key=str)


def test_empty(docs):
    none = docs([(1, "a")]).filter("false")
    assert near_duplicates(none).collect() == [] and keep_one(none).collect() == []


def test_keep_one_among_drifting_copies_against_all_pairs(docs):
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(2000)]
    rows, chain = [], [rng.choice(vocabulary) for _ in range(900)]
    for i in range(300):
        rows.append((i, " ".join(chain)))
        chain[rng.randrange(900)] = rng.choice(vocabulary)
    expected = sorted({r[2] for r in expected_rows(rows)})
    assert len(expected) < 290
    assert sorted(r.doc_id for r in keep_one(docs(rows)).collect()) == expected
