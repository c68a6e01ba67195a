import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from larkspur.llm.manifest import (FIELDS, Parent, block_levels, leaf_digest, manifest_digest,
                                   prove_and_fold, tampered)
from llm_data import ODD
from pyspark.sql import functions as F


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes, fanout):
    """All levels, the leaves first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i:i + fanout]) for i in range(0, len(last), fanout)])
    return levels


def way(levels, at, fanout):
    """Per level: the siblings to the left and to the right."""
    out = []
    for nodes in levels[:-1]:
        first = at - at % fanout
        out.append((nodes[first:at], nodes[at + 1:first + fanout]))
        at //= fanout
    return out


def plain(rows, fanout=2):
    """Rows are (doc_id, source, lang, n_chars, text)."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[2]].append(row)
    names = sorted(groups, key=lambda n: (n is not None, (n or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[name] = climb([leaf_of(r) for r in groups[name]], fanout)
    upper = climb([trees[n][-1][0] for n in names], fanout)
    out = Counter()
    for g, name in enumerate(names):
        for at, row in enumerate(groups[name]):
            steps = way(trees[name], at, fanout) + way(upper, g, fanout)
            changed = list(row)
            if row[0] is not None and row[3] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0:
                changed[3] += 1
            node = leaf_of(changed)
            for left, right in steps:
                node = h(*left, node, *right)
            root = upper[-1][0]
            out[row[0], leaf_of(row), trees[name][-1][0], root,
                h(*(x for left, right in steps for x in (*left, *right))), node,
                node == root] += 1
    return out


def documents(spark, rows):
    return spark.createDataFrame(
        rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(3)


def made(n, languages=("en", "de", None, "é")):
    rows = [(i, None, None, None, t) for i, t in ODD]
    rows += [(100 + 3 * i, f"src{i % 3}" if i % 5 else None, languages[(i * i + i // 7) % len(languages)],
              i * 3 if i % 4 else None, f"text {i} ü" if i % 6 else None) for i in range(n)]
    return rows


@pytest.mark.parametrize("n", [0, 1, 150])
def test_against_brute_force(spark, n):
    rows = made(n)
    assert Counter(map(tuple, manifest_digest(documents(spark, rows)).collect())) == plain(rows)


@pytest.mark.parametrize(("fanout", "levels"), [(2, 1), (2, 2), (3, 1), (3, 2)])
def test_many_layers_and_wider_parents(spark, fanout, levels):
    rows = made(60)
    fields = [F.col(c) for c in FIELDS]
    other = [F.col(c) + 1 if c == "n_chars" else F.col(c) for c in FIELDS]
    got = prove_and_fold(documents(spark, rows), leaf_digest(fields),
                         F.when(tampered(), leaf_digest(other)), fanout=fanout, levels=levels,
                         keep=("text",))
    assert got.columns == ["doc_id", "text", "leaf", "subroot", "root", "proof_sha256",
                           "folded_root"]
    assert Counter((r[0], *r[2:], r[6] == r[4]) for r in got.collect()) == plain(rows, fanout)


def test_folding_resumes_a_kept_state():
    nodes = [h(str(i)) for i in range(5)]
    parent = Parent(nodes)
    assert parent.digest == h(*nodes) and len(parent.states) == 5
    for slot in range(5):
        assert parent.fold(slot, h("x")) == h(*nodes[:slot], h("x"), *nodes[slot + 1:])
        assert parent.siblings(slot) == "".join(nodes[:slot] + nodes[slot + 1:])
        # What is to the left stands in the kept state alone.
        broken = Parent(nodes)
        broken.children[:slot] = [b"lost"] * slot
        assert broken.fold(slot, nodes[slot]) == parent.digest
    assert [len(x) for x in block_levels(nodes, 2, 4)] == [3, 2, 1, 1]


def test_empty_table_and_other_columns(spark):
    docs = documents(spark, made(5)).withColumns(
        {c: F.lit(1) for c in ("leaf", "root", "pos", "key", "grp", "name")})
    assert manifest_digest(docs.filter("false")).collect() == []
    assert Counter(map(tuple, manifest_digest(docs).collect())) == plain(made(5))
