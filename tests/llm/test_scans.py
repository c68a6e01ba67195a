"""Licenses, quality rules, decontamination and languages against plain versions."""

import random
import time
from collections import Counter, defaultdict

import pytest
from larkspur.llm.decontaminate import (Index, contaminated, drop_contaminated,
                                        find_contamination, words_of)
from larkspur.llm.language import held_out, keep_identified, language_digest, train
from larkspur.llm.licenses import NOTICES, PHRASES, license_digest, scan_licenses
from larkspur.llm.quality_rules import host_verdicts, measure, quality_digest
from llm_data import ODD

BLANKS = " \t\n\x0b\x0c\r"


# --- licenses ---

def license_words(text):
    words, word = [], ""
    for c in (text or "") + " ":
        if c.isascii() and not c.isalnum():
            if word:
                words.append(word)
            word = ""
        else:
            word += c.lower() if c.isascii() else c
    return words


def base_places(text):
    words = license_words(text)
    return [(i, label) for phrase, label in PHRASES for i in range(len(words))
            if words[i:i + len(phrase.split())] == phrase.split()]


def test_license_base_by_definition(docs):
    rng = random.Random(1)
    parts = ["under", "the", "MIT", "license,", "Apache License,", "Version 2", "CC-BY", "by", "nc",
             "under the mit license", "cc by nc", "é", "\n", "no"]
    rows = [(100 + i, " ".join(rng.choice(parts) for _ in range(rng.randrange(40))))
            for i in range(150)]
    rows += [(i, t) for i, t in ODD] + [(400, "Under The MIT-License under the mit license")]
    got = license_digest(docs(rows)).collect()
    assert len(got) == len(rows)
    expected = Counter()
    for i, t in rows:
        found = base_places(t)
        starts = [s for s, _ in found]
        expected[i, len(license_words(t)), len(found), min(starts, default=None),
                 max(starts, default=None), ",".join(sorted({x for _, x in found}))] += 1
    assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)
                   for r in got) == expected
    for r in got:
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1


def test_notices_with_changed_words_are_found_and_prose_is_not(docs):
    rows = []
    for n, (notice, _) in enumerate(NOTICES):
        rows.append((n, f"before it {notice} and after"))
    words = NOTICES[0][0].split()
    words[8:8] = ["new", "words"]
    rows.append((100, "start " + " ".join(words[:20] + words[21:])))
    rows.append((101, "a license to use this software in any way, as the foundation says"))
    got = {r.doc_id: r.labels.split(",") for r in license_digest(docs(rows)).collect()}
    for n, (_, label) in enumerate(NOTICES):
        assert label in got[n]
    assert "mit" in got[100] and got[101] == [""]


def test_lightly_edited_notices_are_found_and_other_licenses_are_not(docs):
    rows, expected = [], {}
    for number, (notice, label) in enumerate(NOTICES):
        words = notice.split()
        if len(words) >= 16:
            for a in range(9, 12) if label == "apache-2" else range(3, 6):
                # Two words far apart; those that tell licenses apart stay.
                own = list(words)
                own[a] = own[9 if label == "mpl-2" else -4] = "changed"
                rows.append((number * 100 + a, f"before it {' '.join(own)} and after"))
                expected[number * 100 + a] = label
    others = {
        "distributed under the mit license": "mit",
        "is licensed under an apache license version 2 0": None,
        "licensed beneath the apache license version 2 0": None,
        "made available under the apache license version 2 0": "apache-2",
        "made available under the gnu general public license version 3": "gpl-3",
        "our work is licensed under a creative commons attribution 4 0 international license":
            "cc-by",
        "this is free and truly unencumbered software released into a public domain": None,
        "this is free and unencumbered software placed into the public domain": "unlicense",
    }
    never = {
        "licensed under the apache license version 1 1": "apache-2",
        "licensed under the gnu general public license version 1": "gpl",
        "licensed under the gnu lesser general public license version 3": "gpl-3",
        "this work is licensed under a creative commons attribution noderivatives 4 0 "
        "international license": "cc-by",
        "this work is licensed under a creative commons attribution noncommercial sharealike 4 0 "
        "international license": "cc-by-nc",
        "licensed under the apache license version 1 1 you may not use this file except in "
        "compliance with the license": "apache-2",
    }
    rows += [(5000 + i, f"see it is {x} for more") for i, x in enumerate(others)]
    rows += [(6000 + i, f"see it is {x} for more") for i, x in enumerate(never)]
    got = {r.doc_id: r for r in license_digest(docs(rows)).collect()}
    for i, label in expected.items():
        assert label in got[i].labels.split(","), (i, label, got[i])
    for i, label in enumerate(others.values()):
        assert not label or label in got[5000 + i].labels.split(","), got[5000 + i]
    for i, label in enumerate(never.values()):
        assert label not in got[6000 + i].labels.split(","), got[6000 + i]


def test_words_put_into_a_notice_do_not_lose_it(docs):
    opening = next(n for n, label in NOTICES if label == "bsd").split()
    alien = "seven tall unrelated words".split()
    own = "redistribution and use in".split()
    rows = [(1, " ".join(opening[:10] + alien + opening[10:])),
            (2, " ".join(opening[:10] + own + opening[10:])),
            # Other places of the notice's words before, between and after two whole ones.
            (3, " ".join(own + opening + own * 3 + opening + own)),
            (4, " ".join(own * 30))]
    got = {r.doc_id: r for r in scan_licenses(docs(rows)).collect()}
    assert {k: r.license_spans[0].label if r.license_spans else None for k, r in got.items()} == {
        1: "bsd", 2: "bsd", 3: "bsd", 4: None}
    assert got[1].score == 1.0 and got[2].score == 1.0
    assert len(got[3].license_spans) == 2


def test_license_work_follows_the_length_of_a_text(docs):
    def seconds(n):
        text = " ".join(f"w{i % 5000}" for i in range(n))
        start = time.perf_counter()
        row = license_digest(docs([(1, text + " under the mit license")])).first()
        assert (row.n_base, row.first_word) == (1, n)
        return time.perf_counter() - start

    seconds(1000)
    assert seconds(400_000) <= 2.5 * seconds(200_000)


# --- quality rules ---

def plain_measures(text):
    text = text or ""
    words, word, chars = [], "", 0
    for c in text + " ":
        if c in BLANKS:
            if word:
                words.append(word)
            word = ""
        else:
            word, chars = word + c, chars + 1
    windows = defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i:i + 8])].append(i)
    covered = {i + j for v in windows.values() if len(v) > 1 for i in v for j in range(8)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if line.strip(BLANKS):
            repeated += line in seen
            seen.add(line)
    return len(words), chars, sum(c in "#*$%&|<>" for c in text), repeated, len(covered)


def test_quality_measures_by_definition(docs):
    rng = random.Random(2)
    phrase = "one two three four five six seven eight nine"
    rows = list(ODD) + [(100 + i, "".join(
        rng.choice([phrase, " ", "\n", "a b", "#", "same line\n", "é|", "\x0b", phrase + "\n"])
        for _ in range(rng.randrange(40)))) for i in range(120)]
    got = quality_digest(docs(rows)).collect()
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines,
                    r.n_repeat_words) for r in got) == Counter(
        (i, *plain_measures(t)) for i, t in rows)
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept == (not r.base_failed and not r.host_failed)


def test_small_hosts_lean_on_the_others(spark):
    good = " ".join(f"word{i}" for i in range(40))
    rows = [(i, good, "good") for i in range(300)] + [(i, "short", "bad") for i in range(300)]
    rows += [(i, good, f"host{i % 20}") for i in range(200)]
    rows += [(1, "short", "one"), (2, good, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    measured = measure(docs, [docs.source.alias("host")])
    verdicts = {r["_host"]: r for r in host_verdicts(measured, "host").collect()}
    assert verdicts["bad"].host_failed and not verdicts["good"].host_failed
    assert None in verdicts and verdicts["one"].few_words_rate < 1
    assert verdicts["bad"].few_words_rate > 0.95
    kept = quality_digest(docs).filter("kept")
    assert kept.count() == 501
    assert quality_digest(docs.filter("false")).collect() == []


# --- decontamination ---

def items(n=60, seed=3):
    rng = random.Random(seed)
    vocabulary = [f"term{i}" for i in range(400)]
    return [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(8, 40))) + ". "
             + " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 9))))
            for i in range(n)]


def test_pruned_retrieval_finds_what_full_scoring_finds():
    import numpy as np
    rng = random.Random(4)
    listed = items()
    index = Index.of(listed)
    for threshold in (0.1, 0.3, 0.6):
        for _ in range(80):
            words = words_of(rng.choice(listed)[1])
            words = rng.sample(words, rng.randrange(1, len(words))) + [
                f"term{rng.randrange(500)}" for _ in range(rng.randrange(30))]
            terms = np.unique([index.terms[w] for w in words if w in index.terms])
            blocks = np.arange(index.block_max.shape[1])
            if not len(terms):
                continue
            got = dict(index.retrieve(terms, blocks, threshold))
            full = {k: v for k, v in index.scored(words).items() if v >= threshold}
            assert {k for k, v in full.items() if v > threshold + 1e-9} <= set(got)
            for k, v in got.items():
                assert v == pytest.approx(full[k])


def test_items_are_found_wherever_they_stand(docs, spark):
    rng = random.Random(5)
    listed = items()
    benchmark = spark.createDataFrame([*listed, (500, None), (501, "!!")],
                                      "item_id long, text string")
    rows, expected = list(ODD), set()
    for i, text in listed:
        before = " ".join(f"other{rng.randrange(900)}" for _ in range(rng.randrange(0, 400)))
        rows.append((1000 + i, f"{before} {text.upper()}, {before}"))
        expected.add((1000 + i, i))
        # Half of an item is not the item.
        half = " ".join(text.split()[:len(text.split()) // 2])
        rows.append((2000 + i, f"{before} {half} {before}"))
    found = find_contamination(docs(rows), benchmark)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == expected
    parts = find_contamination(docs(rows), benchmark, index_items=7)
    assert {(r.doc_id, r.item_id) for r in parts.collect()} == expected
    kept = drop_contaminated(docs(rows), benchmark)
    assert kept.columns == docs(rows).columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(
        i for i, _ in rows if not i or not 1000 <= i < 2000)


def test_an_item_with_one_changed_word_is_found_and_half_of_it_is_not():
    listed = items()
    index = Index.of(listed)
    filler = [f"filler{i}" for i in range(150)]
    for item, text in listed:
        words = words_of(text)
        for at in range(len(words)):
            others = [words[:at] + ["changed"] + words[at + 1:], words[:at] + words[at + 1:],
                      words[:at] + ["more"] + words[at:]]
            for own in others:
                marked = " ".join(filler[:37 + at] + own + filler)
                assert item in contaminated(marked, index), (text, at)
        # Every third word changed is another text.
        other = [w if i % 3 else "changed" for i, w in enumerate(words)]
        assert item not in contaminated(" ".join(filler + other + filler), index, threshold=0.1)


def test_an_item_across_runs_of_a_very_long_text(monkeypatch):
    from larkspur.llm import decontaminate
    monkeypatch.setattr(decontaminate, "WORDS_AT_ONCE", 300)
    listed = items(10)
    index = Index.of(listed)
    for at in range(0, 1500, 37):
        text = " ".join(["filler"] * at) + f" {listed[3][1]} " + " ".join(["filler"] * 900)
        assert set(contaminated(text, index)) == {3}


def test_no_items_or_no_documents(docs, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame(items(3), "item_id long, text string")
    assert find_contamination(docs(ODD), none).collect() == []
    assert drop_contaminated(docs(ODD), none).count() == len(ODD)
    assert find_contamination(docs([(1, "a")]).filter("false"), some).collect() == []


# --- languages ---

SYLLABLES = {"aa": ["ba", "lo", "mi"], "bb": ["sch", "ung", "ett"], "cc": ["ção", "lhe", "nho"]}


def speech(rng, lang, n=40):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4)))
                    for _ in range(n))


@pytest.fixture
def spoken(spark):
    rng = random.Random(6)
    rows = [(i, speech(rng, lang), lang if i % 4 else None, "s")
            for i, lang in enumerate(["aa", "bb", "cc"] * 100)]
    rows += [(5000 + n, t, None, "s") for n, (_, t) in enumerate(ODD)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def test_held_out_languages_are_right(spoken):
    import zlib
    got = {r.doc_id: r for r in language_digest(spoken).collect()}
    assert len(got) == 300 + len(ODD)
    truth = {i: lang for i, lang in enumerate(["aa", "bb", "cc"] * 100)}
    right = [got[i].lang_pred == truth[i] for i in truth if got[i].held_out]
    assert sum(right) / len(right) > 0.97
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1
    for n, (_, t) in enumerate(ODD):
        if not any(c.isalpha() for c in t or ""):
            assert got[5000 + n].lang_pred == "und"


def test_training_follows_rows_not_partitions(spoken):
    import numpy as np
    a, b = train(spoken, rows=20), train(spoken.union(spoken).repartition(7), rows=20)
    assert a.languages == b.languages and np.array_equal(a.scores, b.scores)


def test_rejected_documents_go(spoken):
    kept = keep_identified(spoken)
    assert kept.columns == spoken.columns
    ids = {r.doc_id for r in kept.collect()}
    assert len([i for i in range(300) if i in ids]) >= 297
    assert not ids & {5000 + n for n, (_, t) in enumerate(ODD) if not t}


def test_nothing_labelled(docs):
    plain = docs([(1, "some text"), (2, None), (3, "12")]).selectExpr(
        "doc_id", "text", "CAST(NULL AS STRING) lang", "source")
    assert [r.doc_id for r in keep_identified(plain).collect()] == [1]
    assert {r.lang_pred for r in language_digest(plain).collect()} == {"und"}
    assert language_digest(plain.filter("false")).collect() == []
    assert plain.select(held_out()).count() == 3
