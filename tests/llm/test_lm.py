import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from larkspur.llm.lm import (END_WORD, Parameters, Scorer, Training, contexts_of, frequent_words,
                             held_out, learn, lm_digest, score_texts, token_counts, words_of)
from llm_data import ODD
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"


def plain_words(text):
    words, word = [], ""
    for c in (text or "") + " ":
        if c in BLANKS:
            if word:
                words.append(word)
            word = ""
        else:
            word += chr(ord(c) + 32) if "A" <= c <= "Z" else c
    return words


def is_held_out(key):
    return key is not None and zlib.crc32(str(key).encode()) % 7 == 2


def chain(rng, n):
    """Words that mostly follow from the word before."""
    words, last = [], 0
    for _ in range(n):
        last = (3 * last + 1) % 40 if rng.random() < 0.8 else rng.randrange(40)
        words.append(f"w{last}" if rng.random() < 0.95 else f"rare{rng.randrange(5000)}")
    return " ".join(words)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(2)
    return [*ODD, *((100 + i, chain(rng, rng.randrange(1, 300))) for i in range(500))]


def test_base_columns_against_brute_force(docs, corpus):
    counts = Counter()
    for key, text in corpus:
        if not is_held_out(key):
            counts.update([*plain_words(text), None])
    n, v = sum(counts.values()), len(counts)
    expected = Counter()
    for key, text in corpus:
        tokens = [*plain_words(text), None]
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens)
        expected[key, is_held_out(key), len(tokens), sum(counts[t] > 0 for t in tokens), n,
                 round(base, 6)] += 1
    rows = lm_digest(docs(corpus)).collect()
    assert Counter((*r[:5], round(r.base_score, 6)) for r in rows) == expected
    # What the model gained from contexts, on texts it has not seen.
    held = [r for r in rows if r.held_out and r.n_tokens > 20]
    per_token = [sum(r[c] for r in held) / sum(r.n_tokens for r in held)
                 for c in ("score", "base_score")]
    assert len(held) > 40 and per_token[0] > per_token[1] + 0.15
    assert all(r.score <= 0 for r in rows)


def test_scores_against_plain_arithmetic_with_few_known_words(docs, corpus):
    """Few classes and few known words: most words meet the table of counts in the join."""
    texts = docs(corpus)
    model, counts = learn(texts, classes=12, known_words=30, rounds=1)
    assert model.n_classes == 12 and 12 < len(model.known) <= 30
    p, by_word = model.parameters, Counter()
    for _, text in corpus:
        by_word.update([*(w.encode() for w in plain_words(text)), END_WORD])
    assert {bytes(r.word): r.c for r in counts.collect()} == by_word
    own = {w: i for w, i in model.known.items() if i < 12} | {END_WORD: 1}
    rest = sum(c + 1 for w, c in by_word.items() if w not in own) + 1

    def plain_score(text):
        before, total = [12, 12], 0.0
        for w in [*(w.encode() for w in plain_words(text)), END_WORD]:
            q = sum(p.context[b].astype(float) @ p.places[j] for j, b in enumerate(before))
            z = p.target.astype(float) @ q + p.bias
            i = own.get(w, 0)
            total += math.log10(math.exp(z[i]) / np.exp(z).sum())
            if i == 0:
                total += math.log10((by_word[w] + 1) / rest)
            before = [i, before[0]]
        return total

    rows = score_texts(texts, model, counts).collect()
    expected = Counter((key, round(plain_score(text), 3)) for key, text in corpus)
    assert Counter((r.doc_id, round(r.score, 3)) for r in rows).keys() <= {
        (k, round(s + d, 3)) for k, s in expected for d in (-0.001, 0, 0.001)}
    assert len(rows) == len(corpus)
    # All words of the last class and an unseen one share out what it has.
    assert model.rest() == rest


def test_probabilities_of_all_classes_add_up(docs, corpus):
    model, _ = learn(docs(corpus), classes=30, rounds=1)
    n = model.n_classes
    rng = np.random.default_rng(0)
    for context in rng.integers(0, n + 1, (20, 2)):
        scores = Scorer(model).class_scores(np.tile(context, (n, 1)), np.arange(n))
        assert abs(np.exp(scores).sum() - 1) < 1e-4


def test_noise_contrastive_steps_reach_the_distribution():
    """With one context the unnormalised scores approach the logarithms of the shares."""
    shares = np.array([0.1, 0.2, 0.7])
    training = Training(Parameters.first(np.full(3, 1 / 3)), np.full(3, 1 / 3), [1])
    rng = np.random.default_rng(3)
    for _ in range(3000):
        tokens = rng.choice(3, 256, p=shares)
        training.step(np.zeros((256, 2), dtype=np.int64), tokens)
    p = training.p
    scores = p.target @ p.predicted(np.zeros((1, 2), dtype=np.int64))[0] + p.bias
    assert np.abs(np.exp(scores) - shares).max() < 0.05


def test_contexts_do_not_reach_into_other_texts():
    contexts, tokens = contexts_of([np.array([5, 6, 1]), np.array([1]), np.array([7, 1])], 9)
    assert tokens.tolist() == [5, 6, 1, 1, 7, 1]
    assert contexts.tolist() == [[9, 9], [5, 9], [6, 5], [9, 9], [9, 9], [7, 9]]


def test_frequent_words_are_all_from_some_count_up(docs, corpus):
    counts = token_counts(docs(corpus))
    everything = sorted(((bytes(r.word), r.c) for r in counts.collect()), key=lambda x: (-x[1], x[0]))
    for most in (0, 1, 7, 30, 1 << 16):
        found = frequent_words(counts, most)
        assert len(found) <= most and found == everything[:len(found)]
    assert frequent_words(counts, 1 << 16) == everything


def test_empty_tables_and_clashing_columns(docs):
    none = docs([(1, "a")]).filter("false")
    assert lm_digest(none).collect() == []
    untrained = lm_digest(docs([(key, "a b") for key in range(200) if is_held_out(key)]))
    assert all(r.train_tokens == r.n_known == r.base_score == 0 for r in untrained.collect())
    clashing = docs([(1, "a b"), (2, None)]).withColumns(
        {c: F.lit(0) for c in ("row", "words", "times", "n", "c", "word", "score", "held_out")})
    assert sorted((r.doc_id, r.n_tokens) for r in lm_digest(clashing).collect()) == [(1, 3), (2, 1)]
    assert words_of("Ab\x0bÉ x") == ["ab".encode(), "É x".encode()]


def test_long_text(docs):
    a, b = [key for key in range(20) if not is_held_out(key)][:2]
    rows = lm_digest(docs([(a, "to be or " * 60_000), (b, "to be")])).collect()
    assert sorted((r.doc_id, r.n_tokens, r.n_known) for r in rows) == [
        (a, 180_001, 180_001), (b, 3, 3)]


def test_held_out_rows(docs):
    rows = docs([(i, "") for i in [*range(50), None]]).select("doc_id", held_out().alias("h"))
    assert all(r.h == is_held_out(r.doc_id) for r in rows.collect())
