"""Secrets found by patterns and by a character network over every candidate.

Three patterns give the base findings. Beyond them, every run of at least eight characters that
keys are made of is a candidate, with a digit or without, so long words of prose are too. A small
convolutional network in numpy looks at the candidate and the characters around it. It learns
from findings of the corpus:

* Positive examples are the base findings, half of those after a key word with key word and
  separator blanked out. As the findings of one corpus tend to look alike, ``ALTERED`` more are
  made from them in every part: the value written anew in another alphabet and length, in its own
  place with the key word blanked, or in the place of a negative example.
* Negative examples are candidates that no pattern wants and that have no word like "key" or
  "auth" before them.

Every different finding and candidate of the whole corpus is an example, in one of its places.
Examples are dealt by hash to parts of about ``PART``. In each of ``ROUNDS`` rounds all parts
train side by side from the network of the round before, and their weights are averaged; a part
scores each of its negative examples and learns from those not yet right by far. A quarter of the examples is kept from training. All of
these are scored and counted by kind, form and score, and from these counts come calibration and
thresholds. Each form of
candidate (with a digit, letters alone, capitals alone, short or long) has a threshold of its own. It is never so
high that less than ``RECALL`` of the form's positive examples there are found. Where a lower one
still finds at most ``MOST_FALSE`` of the negative ones, it lies between the two, a third of
the way up from the lower one, in logits. ``Network.measured`` says what recall and what share of false findings that gives.

Candidates from the threshold up that overlap no base finding become spans of kind ``model``.
The part of a score that comes from the context is bounded, so candidates whose own characters,
alone or with those after them, put them out of reach are settled without the rest; their result
is the same.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import whole_text
from larkspur.session import stored

#: The patterns of the base findings.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KEY_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
LEAST_ASSIGNED, LEAST_ACCESS = 8, 16

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{8,}")
_DIGIT = re.compile(r"[0-9]")
#: Words that make what follows them likely to be a secret: no place for negative examples.
SECRET_CONTEXT = re.compile(r"pass|secret|token|key|auth|bearer|credential|login", re.IGNORECASE)
KINDS = ("assign", "access", "hex", "model")

#: Examples that are trained together in one task, about, and rounds after which parts are averaged.
PART, ROUNDS = 160_000, 4
#: Positive examples made by writing values anew, in every part.
ALTERED = 8000
#: Lengths and alphabets of values written anew, and what may stand before and after them.
ALTERED_LENGTHS = (8, 40)
OPENING, CLOSING = " \"'=:", " \"',;\n"
ALPHABETS = tuple(np.array(list(x)) for x in (
    "0123456789abcdef", "0123456789ABCDEF", "abcdefghijklmnopqrstuvwxyz0123456789",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "abcdefghijklmnopqrstuvwxyz0123456789",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"))
NAMES = np.array(list("abcdefghijklmnopqrstuvwxyz"))
RECALL = 0.95
MOST_FALSE = 0.0005
#: Candidates shorter than this are a form of their own.
LONG = 12
FORMS = 6
#: Steps over all rounds and parts at least, and what a step takes: negative examples by turns, negative ones
#: of each form equally often, positive ones of each form.
STEPS, RATE = 2000, 0.004
BY_TURNS, BY_FORM, POSITIVE = 40, 18, 30
#: Negative examples that are scored at a time; those below ``EASY`` would move nothing.
CHUNK, EASY = 4096, 0.02
#: Scores are counted by steps of this part of a logit before calibration.
RESOLUTION = 512
BEFORE, INSIDE, AFTER = 24, 40, 8
WIDTH = BEFORE + INSIDE + AFTER
SYMBOLS, FILTERS, KERNEL, EMBEDDED = 128, 24, 5, 8
#: Candidates scored at a time.
BLOCK = 512
#: Candidates whose own part of the score a task remembers.
REMEMBERED = 200_000
#: Values that a task collects before it hands them on.
COLLECTED = 200_000

Span = tuple[int, int, int]


def base_spans(text: str) -> list[Span]:
    """(start, end, kind) of the base findings of a whole text, in code points."""
    spans = []
    lowered = text.lower()
    if any(word in lowered for word in KEY_WORDS):
        spans += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text)
                  if len(m.group(2)) >= LEAST_ASSIGNED]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text)
                  if m.end() - m.start() >= LEAST_ACCESS]
    spans += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], s[2], s[1]))


def candidates(text: str) -> list[tuple[int, int]]:
    """Start and end of every run that could be a key."""
    return [m.span() for m in CANDIDATE.finditer(text)]


def _outside(found: list[tuple[int, int]], spans: list[Span]) -> list[tuple[int, int]]:
    """Those of ``found`` that overlap no span; both are in order of their starts."""
    kept, i, reach = [], 0, 0
    for start, end in found:
        while i < len(spans) and spans[i][0] < end:
            reach = max(reach, spans[i][1])
            i += 1
        if reach <= start:
            kept.append((start, end))
    return kept


def shown(value: str) -> str:
    """What the network sees of a candidate: all, or both ends of a long one."""
    if len(value) > INSIDE:
        return value[:INSIDE - INSIDE // 4] + value[-(INSIDE // 4):]
    return value


def window(text: str, start: int, end: int, blank: tuple[int, int] | None = None) -> str:
    """The characters the network sees: some before, the candidate, some after. Characters from
    ``blank[0]`` to ``blank[1]`` are replaced by blanks."""
    before = text[max(0, start - BEFORE):start]
    if blank:
        a, b = (max(0, min(len(before), x - start + len(before))) for x in blank)
        before = before[:a] + " " * (b - a) + before[b:]
    return (before.rjust(BEFORE) + shown(text[start:end]).ljust(INSIDE, "\0")
            + text[end:end + AFTER].ljust(AFTER))


def encoded(windows: list[str], width: int = WIDTH) -> np.ndarray:
    """Symbols of the windows, a row each: ASCII characters as they are, others as one."""
    points = np.frombuffer("".join(windows).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return np.minimum(points, SYMBOLS - 1).astype(np.int16).reshape(len(windows), width)


def form(value: str) -> int:
    """Which threshold a candidate has: letters alone or with a digit, short or long; words in
    capitals are forms of their own, as they are rare but come together."""
    if value.isupper() and not _DIGIT.search(value):
        return 4 + (len(value) >= LONG)
    return 2 * bool(_DIGIT.search(value)) + (len(value) >= LONG)


def _strips(x: np.ndarray) -> np.ndarray:
    """Embedded characters (n, width, e) as rows of ``KERNEL`` neighbours (n, places, ...)."""
    view = np.lib.stride_tricks.sliding_window_view(x, KERNEL, axis=1)
    return view.transpose(0, 1, 3, 2).reshape(len(x), x.shape[1] - KERNEL + 1, -1)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


@dataclass
class Network:
    """Embedded characters, one convolution each before, in and after the candidate, a logistic
    unit. In the candidate maximum and mean over its places count, around it the maximum,
    squashed to at most 1."""
    weights: dict[str, np.ndarray]
    scale: float = 1.0
    offset: float = 0.0
    threshold: float = 1.0
    thresholds: list[float] = field(default_factory=lambda: [1.0] * FORMS)
    #: By form: positive and negative examples kept from training, and the share found of each.
    measured: list[tuple[int, float, int, float]] = field(default_factory=list)

    @classmethod
    def fresh(cls, rng: np.random.Generator) -> Network:
        w = {"embedding": rng.normal(0, 0.5, (SYMBOLS, EMBEDDED)), "bias": np.zeros(1)}
        for part, pools in (("inside", 2), ("before", 1), ("after", 1)):
            w[f"{part}_kernel"] = rng.normal(0, (KERNEL * EMBEDDED) ** -0.5,
                                             (KERNEL * EMBEDDED, FILTERS))
            w[f"{part}_shift"] = np.zeros(FILTERS)
            w[f"{part}_out"] = rng.normal(0, 0.1, pools * FILTERS)
        return cls({k: v.astype(np.float32) for k, v in w.items()})

    def inside(self, symbols: np.ndarray) -> tuple:
        """The candidate's own part of the score, and what leads to it."""
        w = self.weights
        lengths = np.maximum((symbols > 0).sum(axis=1), 1).astype(np.float32)
        side = KERNEL // 2
        padded = np.pad(symbols, ((0, 0), (side, side)))
        strips = _strips(w["embedding"][padded])
        values = np.maximum(strips @ w["inside_kernel"] + w["inside_shift"], 0)
        values *= (np.arange(symbols.shape[1]) < lengths[:, None])[:, :, None]
        pooled = np.concatenate([values.max(axis=1), values.sum(axis=1) / lengths[:, None]], axis=1)
        return padded, strips, values, lengths, pooled, pooled @ w["inside_out"]

    def around(self, symbols: np.ndarray, part: str) -> tuple:
        """The part of the score from before or after the candidate, and what leads to it."""
        w = self.weights
        strips = _strips(w["embedding"][symbols])
        values = strips @ w[f"{part}_kernel"] + w[f"{part}_shift"]
        pooled = np.tanh(np.maximum(values.max(axis=1), 0))
        return strips, values, pooled, pooled @ w[f"{part}_out"]

    def context_bound(self, *parts: str) -> float:
        """What these parts of the context can add to a score at most."""
        return float(sum(np.maximum(self.weights[f"{part}_out"], 0).sum() for part in parts))

    def raw(self, symbols: np.ndarray) -> np.ndarray:
        """Scores before calibration."""
        out = np.zeros(len(symbols))
        # In blocks of like lengths no places behind the ends have to be worked out.
        lengths = (symbols[:, BEFORE:BEFORE + INSIDE] > 0).sum(axis=1)
        order = np.argsort(lengths, kind="stable")
        for i in range(0, len(symbols), BLOCK):
            rows = order[i:i + BLOCK]
            s = symbols[rows]
            longest = max(KERNEL, int(lengths[rows[-1]]))
            out[rows] = (self.inside(s[:, BEFORE:BEFORE + longest])[-1] + self.weights["bias"]
                         + self.around(s[:, :BEFORE], "before")[-1]
                         + self.around(s[:, BEFORE + INSIDE:], "after")[-1])
        return out

    def calibrated(self, raw: np.ndarray) -> np.ndarray:
        return _sigmoid(self.scale * raw + self.offset)

    def scores(self, symbols: np.ndarray) -> np.ndarray:
        """Calibrated probabilities."""
        return self.calibrated(self.raw(symbols))

    def flat(self) -> np.ndarray:
        return np.concatenate([w.ravel() for w in self.weights.values()]).astype("<f4")

    def like(self, flat: np.ndarray) -> Network:
        """A network of this shape with the given weights."""
        ends = np.cumsum([w.size for w in self.weights.values()])
        return Network({k: part.reshape(w.shape).astype(np.float32) for (k, w), part in zip(
            self.weights.items(), np.split(flat, ends[:-1]), strict=True)})

    def gradients(self, symbols: np.ndarray, labels: np.ndarray,
                  shares: np.ndarray) -> dict[str, np.ndarray]:
        """Of the logistic loss, by weight; ``shares`` is what each example counts."""
        w = self.weights
        sides = {"before": symbols[:, :BEFORE], "after": symbols[:, BEFORE + INSIDE:]}
        padded, strips, values, lengths, pooled, own = self.inside(
            symbols[:, BEFORE:BEFORE + INSIDE])
        found = {part: self.around(s, part) for part, s in sides.items()}
        z = own + w["bias"] + sum(f[-1] for f in found.values())
        error = ((_sigmoid(z) - labels) * shares).astype(np.float32)
        g = {"bias": error.sum(keepdims=True), "embedding": np.zeros_like(w["embedding"]),
             "inside_out": pooled.T @ error}

        def convolution(part: str, seen: np.ndarray, own_symbols: np.ndarray,
                        down: np.ndarray) -> None:
            g[f"{part}_kernel"] = seen.reshape(-1, seen.shape[2]).T @ down.reshape(-1, FILTERS)
            g[f"{part}_shift"] = down.sum(axis=(0, 1))
            spread = (down @ w[f"{part}_kernel"].T).reshape(*down.shape[:2], KERNEL, EMBEDDED)
            back = np.zeros((*own_symbols.shape, EMBEDDED), np.float32)
            for k in range(KERNEL):
                back[:, k:k + down.shape[1]] += spread[:, :, k]
            for e in range(EMBEDDED):
                g["embedding"][:, e] += np.bincount(own_symbols.ravel(), back[..., e].ravel(),
                                                    minlength=SYMBOLS)

        most, mean = np.split(error[:, None] * w["inside_out"], 2, axis=1)
        down = (mean / lengths[:, None])[:, None, :] * (values > 0)
        at = values.argmax(axis=1)[:, None, :]
        top = np.take_along_axis(values, at, 1)[:, 0]
        np.put_along_axis(down, at, np.take_along_axis(down, at, 1)
                          + (most * (top > 0))[:, None, :], 1)
        convolution("inside", strips, padded, down)
        for part, (seen, values, pooled, _) in found.items():
            g[f"{part}_out"] = pooled.T @ error
            down = np.zeros_like(values)
            np.put_along_axis(
                down, values.argmax(axis=1)[:, None, :],
                (error[:, None] * w[f"{part}_out"] * (1 - pooled ** 2) * (pooled > 0))[:, None, :],
                1)
            convolution(part, seen, sides[part], down)
        return g


def altered(windows: list[str], others: list[str], number: int,
            rng: np.random.Generator) -> list[str]:
    """``number`` positive examples from the ``windows`` of findings: their values written anew, by
    turns in their own place with what stands before blanked and in the place of one of ``others``."""
    made = []
    for i in range(number if windows or others else 0):
        letters = ALPHABETS[i % len(ALPHABETS)]
        shortest, longest = ALTERED_LENGTHS
        n = int(rng.integers(shortest, LONG if rng.random() < 0.5 else longest + 1))
        value = "".join(rng.choice(letters, n))
        if n > LONG and rng.random() < 0.15:
            # Some services put a short name before their keys.
            value = "".join(rng.choice(NAMES, rng.integers(2, 5))) + "_" + value
            value = value[:longest]
        own = windows[i % len(windows)] if windows else ""
        if others and (not windows or rng.random() < 0.5):
            own = others[int(rng.integers(len(others)))]
            before = own[:BEFORE - 1] + OPENING[int(rng.integers(len(OPENING)))]
            after = CLOSING[int(rng.integers(len(CLOSING)))] + own[BEFORE + INSIDE + 1:]
        else:
            # Key word and separator are among the last characters before the value.
            before, after = own[:BEFORE - 12] + " " * 12, own[BEFORE + INSIDE:]
        made.append(before + value.ljust(INSIDE, "\0") + after)
    return made


def _inner(one: str) -> str:
    return one[BEFORE:BEFORE + INSIDE].rstrip("\0")


@dataclass
class Part:
    """Examples that are trained together: encoded windows, labels, forms, and which of them are
    kept from training."""
    symbols: np.ndarray
    labels: np.ndarray
    forms: np.ndarray
    held: np.ndarray

    @classmethod
    def of(cls, windows: list[str], labels: list[int]) -> Part:
        held = [zlib.crc32(w.encode("utf-8", "surrogatepass")) % 4 == 0 for w in windows]
        return cls(encoded(windows).astype(np.uint8), np.array(labels, np.uint8),
                   np.array([form(_inner(w)) for w in windows], np.uint8),
                   np.array(held, np.uint8))

    def packed(self) -> bytes:
        columns = (self.labels, self.forms, self.held)
        return np.column_stack([self.symbols, *(c[:, None] for c in columns)]).tobytes()

    @classmethod
    def unpacked(cls, data: bytes) -> Part:
        rows = np.frombuffer(data, np.uint8).reshape(-1, WIDTH + 3)
        return cls(rows[:, :WIDTH], *(rows[:, WIDTH + i] for i in range(3)))

    def seen(self) -> list[int]:
        """Examples for training and kept from it, of label 0 and of label 1."""
        return [int(((self.labels == label) & (self.held == held)).sum())
                for label in (0, 1) for held in (0, 1)]


def can_hold_out(seen: list[int]) -> bool:
    """Whether both labels have examples for training and others to keep from it."""
    return min(seen) > 0


def train_part(network: Network, part: Part, turn: int, hold_out: bool, seed: int,
               parts: int = 1) -> Network:
    """The network after a part's steps of one round, by Adam: steps by running means of the
    gradients and their squares. Negative examples come by turns through all rounds, so each
    comes at least once; beside them each form of both labels comes equally often. Both labels
    count the same."""
    used = part.held == 0 if hold_out else np.ones(len(part.labels), dtype=bool)
    pools = [[rows for f in range(FORMS) if len(rows := np.flatnonzero(
        used & (part.labels == label) & (part.forms == f)))] for label in (0, 1)]
    order = np.random.default_rng(seed).permutation(np.flatnonzero(used & (part.labels == 0)))
    own = order[turn::ROUNDS] if len(order) > ROUNDS * CHUNK else order
    chunks = np.array_split(own, max(1, -(-len(own) // CHUNK)))
    rng = np.random.default_rng([seed, turn])
    network = network.like(network.flat())
    mean = {k: np.zeros_like(v) for k, v in network.weights.items()}
    square = {k: np.zeros_like(v) for k, v in network.weights.items()}

    def drawn(own_pools: list[np.ndarray], number: int) -> np.ndarray:
        return np.concatenate([rng.choice(rows, -(-number // len(own_pools))) for rows in own_pools])

    step = 0
    for i, chunk in enumerate(chunks):
        hard = chunk[_sigmoid(network.raw(part.symbols[chunk])) >= EASY]
        hard = hard if len(hard) else chunk
        steps = max(-(-STEPS // (ROUNDS * len(chunks) * parts)), -(-len(hard) // BY_TURNS))
        rate = RATE * (1.02 - (turn + (i + 1) / len(chunks)) / ROUNDS)
        for j in range(steps):
            groups, step = [], step + 1
            if len(hard):
                at = (j * BY_TURNS + np.arange(BY_TURNS)) % len(hard)
                groups += [(hard[at], 0.25), (drawn(pools[0], BY_FORM), 0.25)]
            if pools[1]:
                groups.append((drawn(pools[1], POSITIVE), 0.5))
            if not groups:
                return network
            batch = np.concatenate([rows for rows, _ in groups])
            shares = np.concatenate([np.full(len(rows), share / len(rows)) for rows, share in groups])
            for k, g in network.gradients(part.symbols[batch], part.labels[batch], shares).items():
                mean[k] += 0.1 * (g - mean[k])
                square[k] += 0.01 * (g * g - square[k])
                network.weights[k] = network.weights[k] - rate * (mean[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(square[k] / (1 - 0.99 ** step)) + 1e-8)
    return network


def score_counts(network: Network, part: Part, hold_out: bool) -> tuple[np.ndarray, ...]:
    """Label, form, score before calibration in steps of ``RESOLUTION``, and number of examples:
    those kept from training, or all where none can be."""
    own = part.held == 1 if hold_out else np.ones(len(part.labels), dtype=bool)
    z = np.floor(network.raw(part.symbols[own]) * RESOLUTION).astype(np.int64)
    rows, n = np.unique(np.column_stack([part.labels[own], part.forms[own], z]), axis=0,
                        return_counts=True)
    return rows[:, 0], rows[:, 1], rows[:, 2], n


def calibrate(network: Network, labels: np.ndarray, forms: np.ndarray, places: np.ndarray,
              counts: np.ndarray) -> Network:
    """Calibration and thresholds of a network from the counts of its scores."""
    order = np.argsort(places, kind="stable")
    target, forms, z, counts = labels[order], forms[order], places[order] / RESOLUTION, counts[order]
    # Platt scaling: slope and offset of the logistic, by Newton-like gradient steps.
    share = counts / np.array([max(1, counts[target == c].sum()) for c in (0, 1)])[target] / 2
    scale, offset = 1.0, 0.0
    for _ in range(300):
        d = (_sigmoid(scale * z + offset) - target) * share
        scale -= 0.5 * float((d * z).sum()) / (1 + float((z * z * share).sum()))
        offset -= 0.5 * float(d.sum())
    network.scale, network.offset = max(scale, 0.05), offset

    def threshold(good: np.ndarray, bad: np.ndarray) -> float:
        """What enough of ``good`` reach, or less where enough of ``bad`` is still left out."""
        reached = np.cumsum(counts[good])
        recalled = z[good][np.searchsorted(reached, int((1 - RECALL) * reached[-1]), "right")]
        above = np.cumsum(counts[bad][::-1])
        spared = (z[bad][::-1][np.searchsorted(above, int(MOST_FALSE * above[-1]), "right")]
                  + 1 / RESOLUTION)
        return float(recalled if spared >= recalled else (2 * spared + recalled) / 3)

    found = threshold(target == 1, target == 0)
    limits = []
    for f in range(FORMS):
        good, bad = ((forms == f) & (target == c) for c in (1, 0))
        # A form's own few negative examples may set its threshold higher, not lower.
        t = found
        if good.any():
            t = threshold(good, bad) if bad.any() else t
            pooled = ((forms < 4) == (f < 4)) & (target == 0)
            t = max(t, threshold(good, pooled)) if pooled.any() else t
        limits.append(t)
        (n, hits), (m, false) = ((int(counts[x].sum()), int(counts[x & (z >= t)].sum()))
                                 for x in (good, bad))
        network.measured.append((n, hits / n if n else 1.0, m, false / m if m else 0.0))
    network.threshold = float(network.calibrated(np.array(found)))
    network.thresholds = [float(t) for t in network.calibrated(np.array(limits))]
    return network


def fit(windows: list[str], labels: list[int], seed: int = 1) -> Network | None:
    """A network with calibration and thresholds from examples of one part; None unless both kinds
    are there."""
    if len(set(labels)) < 2:
        return None
    part = Part.of(windows, labels)
    hold_out = can_hold_out(part.seen())
    network = Network.fresh(np.random.default_rng(seed))
    for turn in range(ROUNDS):
        network = train_part(network, part, turn, hold_out, seed)
    return calibrate(network, *score_counts(network, part, hold_out))


def examples(docs: DataFrame, text: str) -> DataFrame:
    """Every different finding and every different candidate of all whole texts that may be a
    negative example, each in one of its places: ``kind`` (the candidate's form, or ``FORMS`` for a
    finding), ``h`` (the value's hash) and ``window``.

    Of a value's places that in the text with the smallest hash counts, its first one there, so
    neither copies nor partitions change an example.
    """
    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, tuple[int, str]] = {}
        others: dict[str, tuple[int, str]] = {}

        def handed_on() -> pa.RecordBatch:
            rows = [(k, xxhash.xxh64_intdigest(v.encode("utf-8", "surrogatepass")) - (1 << 63), t, w)
                    for own, positive in ((found, True), (others, False))
                    for v, (t, w) in own.items() for k in (FORMS if positive else form(v),)]
            found.clear()
            others.clear()
            columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
            types = (pa.int32(), pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                ["kind", "h", "t", "window"])

        for batch in batches:
            for value in batch.column(0):
                whole = value.as_py()
                spans = base_spans(whole)
                t = xxhash.xxh64_intdigest(whole.encode("utf-8", "surrogatepass")) - (1 << 63)
                for start, end, kind in spans:
                    blank = None
                    if kind == 0:
                        m = ASSIGN.match(whole, start, end)
                        start = m.start(2)
                        blank = (m.start(1), start)
                    one = whole[start:end]
                    if one not in found or t < found[one][0]:
                        half = xxhash.xxh64_intdigest(one.encode("utf-8", "surrogatepass")) % 2
                        found[one] = t, window(whole, start, end, blank if half else None)
                for start, end in _outside(candidates(whole), spans):
                    one = whole[start:end]
                    known = others.get(one)
                    if (known is None or t < known[0]) and not SECRET_CONTEXT.search(
                            whole, max(0, start - BEFORE), start):
                        others[one] = t, window(whole, start, end)
                if len(found) + len(others) >= COLLECTED:
                    yield handed_on()
        yield handed_on()

    return (docs.select(whole_text(text))
            .mapInArrow(collect, "kind int, h long, t long, window string")
            .groupBy("kind", "h").agg(F.min(F.struct("t", "window")).alias("first"))
            .select("kind", "h", F.col("first.window").alias("window")))


def labelled_findings(docs: DataFrame, text: str, sample: int) -> tuple[list, list]:
    """Some windows and labels to look at: the ``sample`` findings, and of each form of negative
    example the ``sample // FORMS``, with the smallest hashes. Training takes all examples."""
    every = examples(docs, text)
    rows = [r for kind in range(FORMS + 1)
            for r in every.filter(F.col("kind") == kind).orderBy("h").limit(
                sample if kind == FORMS else max(1, sample // FORMS)).collect()]
    return [r["window"] for r in rows], [int(r["kind"] == FORMS) for r in rows]


def packed_parts(every: DataFrame, parts: int) -> DataFrame:
    """All examples in ``parts`` parts by hash, with those made anew in each, a row per part:
    ``part``, ``seen`` (:meth:`Part.seen`), ``data``. A task holds one part at a time."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, windows, labels = None, [], []

        def made() -> pa.RecordBatch:
            found = [w for w, label in zip(windows, labels, strict=True) if label]
            others = [w for w, label in zip(windows, labels, strict=True) if not label]
            more = altered(found, others, ALTERED, np.random.default_rng([2, current]))
            part = Part.of(windows + more, labels + [1] * len(more))
            return pa.RecordBatch.from_arrays(
                [pa.array([current], pa.int64()), pa.array([part.seen()], pa.list_(pa.int64())),
                 pa.array([part.packed()], pa.binary())], ["part", "seen", "data"])

        for batch in batches:
            for number, kind, one in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if number != current:
                    if windows:
                        yield made()
                    current, windows, labels = number, [], []
                windows.append(one)
                labels.append(int(kind == FORMS))
        if windows:
            yield made()

    return (every.withColumn("part", F.pmod("h", F.lit(parts))).repartition(parts, "part")
            .sortWithinPartitions("part", "kind", "h").select("part", "kind", "window")
            .mapInArrow(pack, "part long, seen array<long>, data binary"))


def train(docs: DataFrame, text: str = "text", part: int = PART) -> Network | None:
    """A network trained on all findings of ``docs``; None where there are none."""
    every = stored(examples(docs, text))
    n, positive = every.agg(F.count(F.lit(1)), F.count_if(F.col("kind") == FORMS)).first()
    if positive in (0, n):
        return None
    number_of_parts = -(-n // part)
    parts = stored(packed_parts(every, number_of_parts))
    hold_out = can_hold_out(list(parts.agg(*(F.sum(F.get("seen", F.lit(i))) for i in range(4))).first()))
    network = Network.fresh(np.random.default_rng(1))
    context = docs.sparkSession.sparkContext

    def sent(function, schema: str) -> DataFrame:
        """What ``function`` makes of every part, as columns."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for number, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    columns = function(number, Part.unpacked(data))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c) for c in columns], names)
        names = [x.split()[0] for x in schema.split(", ")]
        return parts.select("part", "data").mapInArrow(run, schema)

    for turn in range(ROUNDS):
        shared = context.broadcast(network)
        rows = sent(lambda number, own: ([number], [len(own.labels)], [train_part(
            shared.value, own, turn, hold_out, number + 1, number_of_parts).flat().tobytes()]),
            "part long, n long, data binary").collect()
        shares = np.array([r["n"] for r in sorted(rows)], float)
        network = network.like(np.average(
            [np.frombuffer(r["data"], "<f4") for r in sorted(rows)], axis=0, weights=shares))
        shared.unpersist()
    shared = context.broadcast(network)
    counts = sent(lambda number, own: score_counts(shared.value, own, hold_out),
                  "label long, form long, place long, n long")
    rows = counts.groupBy("label", "form", "place").agg(F.sum("n")).collect()
    shared.unpersist()
    return calibrate(network, *np.array(sorted(rows), dtype=np.int64).T)


class Scanner:
    """Spans of whole texts by the patterns and a network."""

    def __init__(self, network: Network | None):
        self.network, self.known = network, {}
        if network is not None:
            #: By form, what own part and context have to reach together.
            t = np.clip(np.array(network.thresholds), 1e-15, 1 - 1e-15)
            self.least = ((np.log(t / (1 - t)) - network.offset) / network.scale
                          - float(network.weights["bias"][0]) - 1e-3)
            self.before = network.context_bound("before")
            self.around = network.context_bound("before", "after")

    def _margins(self, values: list[str]) -> list[float]:
        """What the candidates' own parts are above what has to be reached."""
        if len(self.known) > REMEMBERED:
            self.known = {}
        # In blocks of like lengths no places behind the ends have to be worked out.
        new = sorted((v for v in dict.fromkeys(values) if v not in self.known), key=len)
        for i in range(0, len(new), BLOCK):
            part = new[i:i + BLOCK]
            longest = len(part[-1])
            own = self.network.inside(
                encoded([v.ljust(longest, "\0") for v in part], longest))[-1]
            own = own - self.least[[form(v) for v in part]]
            self.known.update(zip(part, own.tolist(), strict=True))
        return [self.known[v] for v in values]

    def _near(self, text: str, places: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """The places that may reach their threshold: by the candidate's own characters with any
        context, and then by these and what stands after it."""
        margins = self._margins([shown(text[s:e]) for s, e in places])
        open_ones = [(p, m) for p, m in zip(places, margins, strict=True) if m + self.around >= 0]
        if not open_ones:
            return []
        after = self.network.around(encoded(
            [text[e:e + AFTER].ljust(AFTER) for (_, e), _ in open_ones], AFTER), "after")[-1]
        return [p for (p, m), a in zip(open_ones, after.tolist(), strict=True)
                if m + a + self.before >= 0]

    def spans(self, texts: list[str]) -> list[tuple[list[Span], float]]:
        """Per text, base findings and those the network adds, in order, and the highest added
        score (0 where none was added)."""
        spans = [base_spans(t) for t in texts]
        best = [0.0] * len(texts)
        if self.network is None:
            return list(zip(spans, best, strict=True))
        places: list[tuple[int, int, int]] = []
        for i, text in enumerate(texts):
            found = _outside(candidates(text), spans[i])
            for j in range(0, len(found), REMEMBERED):
                places += [(i, s, e) for s, e in self._near(text, found[j:j + REMEMBERED])]
        for j in range(0, len(places), BLOCK):
            part = places[j:j + BLOCK]
            windows = [window(texts[i], s, e) for i, s, e in part]
            scores = self.network.scores(encoded(windows)).tolist()
            for (i, s, e), own, p in zip(part, windows, scores, strict=True):
                if p >= self.network.thresholds[form(_inner(own))]:
                    spans[i].append((s, e, 3))
                    best[i] = max(best[i], p)
        return [(sorted(found, key=lambda s: (s[0], s[2], s[1])), p)
                for found, p in zip(spans, best, strict=True)]


def find_secrets(docs: DataFrame, network: Network | None, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """``key``, ``spans`` (array of start, end, kind; code points, end exclusive) and
    ``model_score`` of every row.

    A null or empty text has no spans. Repeated rows get equal results. Without a network only
    the base findings are there. Candidates of long texts are scored in blocks. Keys in letters of
    one case alone are candidates, but no examples of them are made, so many are missed.
    """
    shared = docs.sparkSession.sparkContext.broadcast(network)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(shared.value)
        for batch in batches:
            found = scanner.spans(batch.column(1).to_pylist())
            spans = [[{"start": s, "end": e, "kind": KINDS[k]} for s, e, k in own]
                     for own, _ in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(spans, kind),
                 pa.array([p for _, p in found], pa.float64())], [key, "spans", "model_score"])

    chosen = docs.select(F.col(key), whole_text(text).alias("_llm_whole"))
    type_name = chosen.schema[0].dataType.simpleString()
    return chosen.mapInArrow(find, f"`{key}` {type_name}, spans array<struct<start: long, "
                                   "end: long, kind: string>>, model_score double")


def secret_digest(docs: DataFrame) -> DataFrame:
    """Counts, digest and list of the spans per document."""
    scanned = find_secrets(docs, train(docs))

    def of(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["kind"] != "model")
    return scanned.select(
        "doc_id", of("assign").alias("n_assign"), of("access").alias("n_access"),
        of("hex").alias("n_hex"), F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"), of("model").alias("n_model"), "model_score")


def digest_of(spans: list[Span]) -> str:
    """The SHA-256 of base spans, as :func:`secret_digest` gives it."""
    return hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in spans if k < 3)
                          .encode()).hexdigest()
