import hashlib
import random
import re

from larkspur.llm.secret_scan import (Scanner, base_spans, candidates, encoded, find_secrets, fit,
                                       form, secret_digest, shown, train, window)
from llm_data import ODD

KINDS = ["assign", "access", "hex"]


def plain(text):
    """The contract's three patterns, read literally."""
    text = text or ""
    words = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*"""
                       r"""["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
    spans = [(m.start(), 0, m.end()) for m in words.finditer(text) if len(m.group(2)) >= 8]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text)
              if len(m.group()) >= 16]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text)
              if len(m.group()) >= 32]
    return sorted(spans)


def made(n=300, seed=1):
    rng = random.Random(seed)

    def key(k):
        return "".join(rng.choice("ABCDEFGHJKLMNPQRabcdefghijk0123456789+/") for _ in range(k))

    rows = []
    for i in range(n):
        kind = i % 6
        filler = " ".join(rng.choice(["plain", "words", "of", "prose2024", "x-1"])
                          for _ in range(20))
        middle = [f'password = "{key(20)}"', f"AKIA{key(16).upper().replace('+', 'Q').replace('/', 'Z')}",
                  hashlib.sha256(str(i).encode()).hexdigest(), f"order-number-2024-{i:08d}",
                  f"API_KEY:{key(rng.randrange(4, 12))} PassWD='{key(9)}", "no-thing-here-at-all"][kind]
        rows.append((100 + i, f"{filler} {middle} {filler} 😀"))
    return rows


def test_base_spans_by_definition():
    rng = random.Random(5)
    parts = ["password", "TOKEN", "api_key", "apikey", '"', "'", " ", "=", ":", "abcdefgh", "AKIA",
             "AKIA0123456789ABCD", "0" * 31, "f" * 8, "é", "\n", "ſecret", "tokenſ", "_", "."]
    texts = [t for _, t in ODD + made(60)] + [
        "".join(rng.choice(parts) for _ in range(30)) for _ in range(1500)]
    for text in texts:
        assert [(s, k, e) for s, e, k in base_spans(text or "")] == plain(text)


def test_digest_keeps_base_spans(docs):
    rows = made() + ODD
    got = {r.doc_id: r for r in secret_digest(docs(rows)).collect()}
    for i, text in rows:
        if i is None or i in (7,):
            continue
        spans = plain(text)
        r = got[i]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == x for _, k, _ in spans)
                                                     for x in range(3)]
        joined = [f"{KINDS[k]}:{s}:{e}" for s, k, e in spans]
        assert r.base_sha256 == hashlib.sha256(",".join(joined).encode()).hexdigest()
        assert [x for x in r.spans.split(",") if x and not x.startswith("model")] == joined


def test_network_tells_keys_from_numbers():
    rng = random.Random(7)

    def secret():
        value = "".join(rng.choice("ABCDEFGHJKabcdefghjk0123456789") for _ in range(24))
        text = f"some words and {value} some words"
        return window(text, 15, 15 + 24)

    def number():
        value = f"order-number-{rng.randrange(10 ** 8):08d}"
        text = f"some words and {value} some words"
        return window(text, 15, 15 + len(value))

    network = fit([secret() for _ in range(300)] + [number() for _ in range(300)],
                  [1] * 300 + [0] * 300)
    from larkspur.llm.secret_scan import encoded
    hits = network.scores(encoded([secret() for _ in range(100)])) >= network.threshold
    false = network.scores(encoded([number() for _ in range(100)])) >= network.threshold
    assert hits.mean() >= 0.95 and false.mean() <= 0.05


def test_planted_secrets_without_key_words(docs):
    """The corpus to learn from has base findings of one kind only."""
    rng = random.Random(11)
    upper, digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    lower = upper.lower()
    parts = ["tion", "the", "ment", "ing", "er", "wha", "ble", "ou", "en", "re", "st", "que"]

    def prose(n=60):
        words = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 5))) for _ in range(n)]
        return " ".join(w.capitalize() if rng.random() < 0.1 else w for w in words)

    def value(letters, n):
        return "".join(rng.choice(letters) for _ in range(n))

    rows = [(i, prose() + (f' token = "{value("0123456789abcdef", 40)}" ' if i % 5 == 0 else " ")
             + f"{rng.randrange(10 ** 15, 10 ** 16)} 555-{rng.randrange(1000, 9999)} " + prose())
            for i in range(400)]
    network = train(docs(rows))
    kinds = [lambda: "aws_key: " + value(upper + lower + digits + "+/", 40),
             lambda: "Authorization: Bearer " + value(upper + lower + digits, 32),
             lambda: "use sk_live_" + value(upper + lower + digits, 24),
             lambda: "auth " + value("0123456789abcdef", 30),
             lambda: "the code is " + value(upper + lower, rng.randrange(12, 30)),
             lambda: "login with " + value(upper + lower + digits, rng.randrange(8, 12))]
    planted, ends = [], {}
    for i in range(600):
        secret, before = kinds[i % len(kinds)](), prose()
        planted.append((i, f"{before} {secret} {prose()}"))
        ends[i] = len(before) + 1 + len(secret)
    planted += [(1000 + i, prose(200)) for i in range(500)]
    got = {r.doc_id: r.spans for r in find_secrets(docs(planted), network).collect()}
    for kind in range(len(kinds)):
        ours = [i for i in ends if i % len(kinds) == kind]
        assert sum(any(s.end == ends[i] for s in got[i]) for i in ours) >= 0.9 * len(ours), kind
    assert sum(len(got[1000 + i]) for i in range(500)) <= 5
    assert all(found >= 0.9 and false <= 0.01 for _, found, _, false in network.measured)


def test_scores_settled_without_context_are_the_same(docs):
    """Candidates whose own characters put them out of reach would not be found with context."""
    rows = made(60)
    network = train(docs(rows))
    texts = [t for _, t in rows + ODD if t]
    for text, (spans, _) in zip(texts, Scanner(network).spans(texts), strict=True):
        base = base_spans(text)
        found = [(s, e) for s, e in candidates(text)
                 if not any(s < b and a < e for a, b, _ in base)]
        windows = [window(text, s, e) for s, e in found]
        scores = network.scores(encoded(windows)) if windows else []
        assert [(s, e) for (s, e), p in zip(found, scores, strict=True)
                if p >= network.thresholds[form(shown(text[s:e]))]] == [
                    (s, e) for s, e, k in spans if k == 3]


def test_a_bounded_sample_is_enough_and_repeatable(docs):
    from larkspur.llm.secret_scan import labelled_findings
    rows = made(120)
    windows, labels = labelled_findings(docs(rows), "text", sample=10)
    assert labels.count(0) <= 10 and labels.count(1) == 10
    assert (windows, labels) == labelled_findings(docs(rows, 7), "text", sample=10)
    # Copies of one text do not crowd out others.
    assert (windows, labels) == labelled_findings(docs(rows + rows[:1] * 200), "text", sample=10)


def test_nothing_to_learn_from(docs):
    clean = docs([(1, "plain text"), (2, None)])
    assert train(clean) is None
    assert [r.spans for r in find_secrets(clean, None).collect()] == [[], []]
    assert secret_digest(clean.filter("false")).collect() == []


def test_training_takes_every_example(docs, monkeypatch):
    """All different findings and candidates are examples, all are in parts, and all that are kept
    from training are counted for the thresholds."""
    from larkspur.llm import secret_scan
    rows = [(i, f'word{i:05d} and token = "{hashlib.sha256(str(i).encode()).hexdigest()}" end')
            for i in range(400)]
    every = secret_scan.examples(docs(rows), "text")
    assert every.groupBy("kind").count().collect() and every.filter(
        f"kind < {secret_scan.FORMS}").count() == 400 and every.count() == 800
    again = secret_scan.examples(docs(rows + rows[:1] * 50, 7), "text")
    assert sorted(every.collect()) == sorted(again.collect())
    monkeypatch.setattr(secret_scan, "ALTERED", 20)
    parts = [secret_scan.Part.unpacked(bytes(r.data)) for r in secret_scan.packed_parts(every, 3).collect()]
    assert len(parts) == 3 and sum(len(p.labels) for p in parts) == 800 + 3 * 20
    monkeypatch.setattr(secret_scan, "STEPS", 40)
    network = train(docs(rows), part=300)
    held = sum(p.seen()[1] + p.seen()[3] for p in parts)
    assert sum(n + m for n, _, m, _ in network.measured) == held
