"""Scoring texts with a log-bilinear language model trained by noise-contrastive estimation.

A token is a word, or the end of a text. The model (Mnih and Hinton 2007; Mnih and Teh 2012) knows
``CLASSES`` classes: the end, the most frequent words, and one for all other words. The vectors of
the ``CONTEXT`` classes before a token, each times a matrix of its place, add up to a predicted
vector; its product with a class's own vector plus the class's bias is the class's score, and the
softmax over all classes its probability. A word of the last class gets that class's probability
times its share, with one added to every count, among the words there. So the probabilities of
all words, an unseen one included, add up to one.

* **Counts** cover all training texts: tasks count, Spark adds up. Only totals and the counts of
  at most ``KNOWN_WORDS`` words, the most frequent ones, reach the driver and the tasks.
* **Numbers**: every text's tokens are written once as numbers of known words, beside its unknown
  words, for all that follows.
* **Training** reads all training texts in each of ``ROUNDS`` rounds. Every task takes its texts
  in order through noise-contrastive steps in numpy, from the parameters of the round before, and
  sends its parameters on; their mean, weighted by tokens, is the next start. So what is gathered
  grows with the input, while each task's parameters have one size.
* **Scoring** makes the softmax's denominators with batched matrix products, once for each pair
  of classes that a task meets. Words that are not among the known ones are counted by text and
  meet the table of counts in a join; nothing about them is kept in a task.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import whole_text
from larkspur.session import stored

CLASSES = 1024
DIMENSIONS = 16
CONTEXT = 2
#: Passes over the training texts, noise tokens and tokens of a step, and the step size.
ROUNDS, NOISE, BATCH, RATE = 2, 32, 1024, 0.3
#: Words whose counts every task knows.
KNOWN_WORDS = 1 << 16
#: Distinct words that a task counts before it hands them on.
COUNTED_AT_ONCE = 1 << 18
#: Tokens that a task holds before it trains on them or scores them.
TOKENS_AT_ONCE = 1 << 15
#: Parameters of a row in which they travel.
CHUNK = 1024
SEED = 7

OTHER, END = 0, 1
#: The end of a text as a word; no word is empty.
END_WORD = b""


def words_of(text: str) -> list[bytes]:
    """Words in UTF-8 with A-Z in lower case, separated by ASCII white space."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def token_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``word`` (in UTF-8; empty for the end of a text) and ``c`` over all texts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
                ["word", "c"])

        for batch in batches:
            counts[END_WORD] += batch.num_rows
            for value in batch.column(0):
                counts.update(words_of(value.as_py()))
                if len(counts) > COUNTED_AT_ONCE:
                    yield made()
                    counts.clear()
        if counts:
            yield made()

    counted = docs.select(whole_text(text)).mapInArrow(count, "word binary, c long")
    return counted.groupBy("word").agg(F.sum("c").alias("c")).filter("c > 0")


def frequent_words(counts: DataFrame, most: int = KNOWN_WORDS) -> list[tuple[bytes, int]]:
    """At most ``most`` words with their counts, the most frequent first: all from some count up,
    which is chosen from a histogram, so no task ranks the words."""
    step = F.floor(F.log2("c") * 64)
    sizes = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()
    least, total = None, 0
    for row in sorted(sizes, reverse=True):
        total += row["n"]
        if total > most:
            break
        least = row["step"]
    if least is None:
        return []
    rows = counts.filter(step >= least).collect()
    return sorted(((bytes(r["word"]), r["c"]) for r in rows), key=lambda x: (-x[1], x[0]))


@dataclass(frozen=True)
class Parameters:
    """The log-bilinear model. The context vectors have one row more, for what is before a text."""

    context: np.ndarray
    places: np.ndarray
    target: np.ndarray
    bias: np.ndarray

    @classmethod
    def first(cls, shares: np.ndarray, dimensions: int = DIMENSIONS,
              context: int = CONTEXT) -> Parameters:
        """Where training starts: every class has its share, whatever the context."""
        rng = np.random.default_rng(SEED)
        n = len(shares)
        return cls(rng.normal(0, 0.3, (n + 1, dimensions)).astype(np.float32),
                   np.stack([np.eye(dimensions, dtype=np.float32) / (1 + j)
                             for j in range(context)]),
                   np.zeros((n, dimensions), np.float32), np.log(shares).astype(np.float32))

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    def parts(self) -> tuple[np.ndarray, ...]:
        return self.context, self.places, self.target, self.bias

    def like(self, flat: np.ndarray) -> Parameters:
        """The same shapes with other values."""
        bounds = np.cumsum([p.size for p in self.parts()])[:-1]
        return Parameters(*(v.reshape(p.shape).astype(np.float32)
                            for v, p in zip(np.split(flat, bounds), self.parts(), strict=True)))

    def predicted(self, contexts: np.ndarray) -> np.ndarray:
        """Predicted vectors of rows of ``CONTEXT`` classes, the nearest one first."""
        return sum(self.context[contexts[:, j]] @ m for j, m in enumerate(self.places))

    def log_denominators(self, contexts: np.ndarray) -> np.ndarray:
        """Logarithm of the softmax's denominator, a bounded number of contexts at a time."""
        out = np.empty(len(contexts), np.float32)
        for i in range(0, len(contexts), 4096):
            scores = self.predicted(contexts[i:i + 4096]) @ self.target.T
            scores += self.bias
            top = scores.max(axis=1, keepdims=True)
            scores -= top
            np.exp(scores, out=scores)
            out[i:i + 4096] = np.log(scores.sum(axis=1)) + top[:, 0]
        return out


class Training:
    """Noise-contrastive steps with a step size that falls by parameter as gradients add up."""

    def __init__(self, start: Parameters, shares: np.ndarray, seed: list[int]):
        self.p = Parameters(*(x.copy() for x in start.parts()))
        self.sums = [np.full(x.shape, 1e-2, np.float32) for x in self.p.parts()]
        self.rng = np.random.default_rng(seed)
        self.below = np.cumsum(shares)
        self.log_noise = np.log(NOISE * shares).astype(np.float32)

    def step(self, contexts: np.ndarray, tokens: np.ndarray) -> None:
        p, n = self.p, len(tokens)
        noise = np.minimum(np.searchsorted(self.below, self.rng.random(NOISE), side="right"),
                           len(self.below) - 1)
        before = [p.context[contexts[:, j]] for j in range(contexts.shape[1])]
        predicted = sum(r @ m for r, m in zip(before, p.places, strict=True))
        own, other = p.target[tokens], p.target[noise]
        true = np.einsum("ij,ij->i", predicted, own) + p.bias[tokens] - self.log_noise[tokens]
        false = predicted @ other.T + (p.bias[noise] - self.log_noise[noise])
        # How far each is from being told right: data from noise, noise from data.
        true = 1 / (1 + np.exp(np.clip(true, -30, 30)))
        false = -1 / (1 + np.exp(-np.clip(false, -30, 30)))
        back = true[:, None] * own + false @ other
        target = _rows_added(tokens, true[:, None] * predicted, len(p.target))
        np.add.at(target, noise, false.T @ predicted)
        bias = np.bincount(tokens, true, len(p.bias)).astype(np.float32)
        np.add.at(bias, noise, false.sum(axis=0))
        context = sum(_rows_added(contexts[:, j], back @ m.T, len(p.context))
                      for j, m in enumerate(p.places))
        places = np.stack([r.T @ back for r in before])
        for value, gradient, sums in zip(p.parts(), (context, places, target, bias), self.sums,
                                         strict=True):
            gradient = gradient / np.float32(n)
            sums += gradient * gradient
            value += np.float32(RATE) * gradient / np.sqrt(sums)


def _rows_added(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """The sum of the values of each row number."""
    width = values.shape[1]
    at = (rows[:, None] * width + np.arange(width)).ravel()
    return np.bincount(at, values.ravel(), n * width).reshape(n, width).astype(np.float32)


def contexts_of(texts: list[np.ndarray], n_classes: int, context: int = CONTEXT
                ) -> tuple[np.ndarray, np.ndarray]:
    """For every token of every text its context's classes and its own; each text has its end."""
    start = np.full(context, n_classes, dtype=np.int64)
    padded = np.concatenate([x for text in texts for x in (start, text)])
    inside = np.ones(len(padded), dtype=bool)
    at = np.cumsum([0, *(len(t) + context for t in texts[:-1])])
    for j in range(context):
        inside[at + j] = False
    places = np.flatnonzero(inside)
    return np.stack([padded[places - 1 - j] for j in range(context)], axis=1), padded[places]


@dataclass(frozen=True)
class LanguageModel:
    """Parameters, the known words with their numbers, and what the counts add up to.

    Number ``i`` of a known word is its rank by count, from 2; the first ``n_classes`` numbers
    are classes of their own.
    """

    parameters: Parameters
    known: dict[bytes, int]
    known_counts: np.ndarray
    n_tokens: int
    n_words: int

    @property
    def n_classes(self) -> int:
        return len(self.parameters.bias)

    def shares(self) -> np.ndarray:
        """Every class's share of the tokens, with one added to its count."""
        own = self.known_counts[:self.n_classes].copy()
        own[OTHER] = self.n_tokens - own[1:].sum()
        return (own + 1.0) / (own.sum() + len(own))

    def share_of_base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 1.0) / (self.n_tokens + self.n_words + 1))

    def rest(self) -> int:
        """What counts of words of the last class, each with one added, and of an unseen one
        add up to."""
        own = self.known_counts[1:self.n_classes]
        return self.n_tokens - int(own.sum()) + self.n_words - int((own > 0).sum()) + 1

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The numbers of words, -1 for words that are not known, and of the end behind them."""
        get = self.known.get
        out = [get(w, -1) for w in words]
        out.append(END)
        return np.array(out, dtype=np.int64)

    def classes(self, numbers: np.ndarray) -> np.ndarray:
        return np.where((numbers < 0) | (numbers >= self.n_classes), OTHER, numbers)


def first_model(counts: DataFrame, classes: int = CLASSES, known_words: int = KNOWN_WORDS
                ) -> LanguageModel:
    """The model before training: counts, and parameters that give every class its share."""
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("word").alias("v"),
                       F.coalesce(F.sum(F.when(F.octet_length("word") == 0, F.col("c"))),
                                  F.lit(0)).alias("ends")).first()
    frequent = [x for x in frequent_words(counts, known_words) if x[0] != END_WORD]
    known = {w: i for i, (w, _) in enumerate(frequent, 2)}
    known_counts = np.array([0, total["ends"], *(c for _, c in frequent)], dtype=np.int64)
    even = np.ones(min(classes, len(known_counts)))
    model = LanguageModel(Parameters.first(even), known, known_counts, total["n"], total["v"])
    return replace(model, parameters=Parameters.first(model.shares()))


def _mean(sent: DataFrame) -> DataFrame:
    """The mean of each chunk over the rows that were sent, weighted by their tokens. Rows come
    sorted by chunk, one is held at a time."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, total, weight = None, None, 0

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([current], pa.int32()),
                 pa.array([(total / weight).astype("<f4").tobytes()], pa.binary())],
                ["chunk", "mean"])

        for batch in batches:
            for chunk, n, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if chunk != current:
                    if current is not None:
                        yield made()
                    current, total, weight = chunk, 0.0, 0
                total = total + n * np.frombuffer(data, "<f4").astype(np.float64)
                weight += n
        if current is not None:
            yield made()

    return (sent.repartition("chunk").sortWithinPartitions("chunk", "n", "data")
            .mapInArrow(add, "chunk int, mean binary"))


def numbered_texts(docs: DataFrame, model: LanguageModel, key: str = "doc_id",
                   text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Every row's tokens, written once: the ``key`` as ``_llm_key``, the ``keep`` columns,
    ``numbers`` (32 bits each, little-endian, the end's behind), the distinct unknown ``words``,
    how many ``times`` each, and ``row``, which tells rows apart."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    chosen = docs.select(F.col(key).alias("_llm_key"), *keep, whole_text(text).alias("_llm_whole"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            numbers, words, times = [], [], []
            for value in batch.column(batch.num_columns - 1):
                tokens = words_of(value.as_py())
                own = model.numbers(tokens)
                missing = Counter(tokens[i] for i in np.flatnonzero(own < 0).tolist())
                numbers.append(own.astype("<i4").tobytes())
                words.append(list(missing))
                times.append(list(missing.values()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(numbers, pa.binary()),
                 pa.array(words, pa.list_(pa.binary())), pa.array(times, pa.list_(pa.int64()))],
                [*batch.schema.names[:-1], "numbers", "words", "times"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1]]
    return stored(chosen.mapInArrow(number, ", ".join(
        [*fields, "numbers binary, words array<binary>, times array<long>"]))
        .withColumn("row", F.monotonically_increasing_id()))


def _held(batch: pa.RecordBatch, column: int) -> Iterator[tuple[list[np.ndarray], int]]:
    """The numbers of a batch's texts, some texts at a time, and how many there are."""
    held, n = [], 0
    for value in batch.column(column):
        held.append(np.frombuffer(value.as_py(), "<i4").astype(np.int64))
        n += len(held[-1])
        if n >= TOKENS_AT_ONCE:
            yield held, n
            held, n = [], 0
    if held:
        yield held, n


def train_round(texts: DataFrame, model: LanguageModel, turn: int) -> LanguageModel:
    """One pass over all of ``numbered_texts``, in all tasks at a time, from the model's parameters."""
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, total = shared.value, 0
        training = Training(model.parameters, model.shares(),
                            [SEED, turn, TaskContext.get().partitionId()])
        for batch in batches:
            for held, n in _held(batch, 0):
                contexts, tokens = contexts_of([model.classes(x) for x in held], model.n_classes)
                order = training.rng.permutation(n)
                for i in range(0, n, BATCH):
                    own = order[i:i + BATCH]
                    training.step(contexts[own], tokens[own])
                total += n
        if total:
            flat = training.p.flat().astype("<f4")
            chunks = [flat[i:i + CHUNK].tobytes() for i in range(0, len(flat), CHUNK)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(chunks)), pa.int32()),
                 pa.array([total] * len(chunks), pa.int64()), pa.array(chunks, pa.binary())],
                ["chunk", "n", "data"])

    sent = texts.select("numbers").mapInArrow(train, "chunk int, n long, data binary")
    # As many rows as the model has chunks, whatever the number of tasks.
    rows = sorted(_mean(sent).collect())
    shared.unpersist()
    if not rows:
        return model
    flat = np.concatenate([np.frombuffer(r["mean"], "<f4") for r in rows])
    return replace(model, parameters=model.parameters.like(flat))


def learn(docs: DataFrame, text: str = "text", classes: int = CLASSES,
          known_words: int = KNOWN_WORDS, rounds: int = ROUNDS) -> tuple[LanguageModel, DataFrame]:
    """A model from all texts of ``docs``, and the table of their token counts."""
    counts = stored(token_counts(docs, text))
    model = first_model(counts, classes, known_words)
    texts = numbered_texts(docs.select(F.lit(0).alias("key"), text), model, "key", text)
    return trained(texts, model, rounds), counts


def trained(texts: DataFrame, model: LanguageModel, rounds: int = ROUNDS) -> LanguageModel:
    """The model after ``rounds`` passes over ``numbered_texts``."""
    for turn in range(rounds):
        model = train_round(texts, model, turn)
    return model


class Scorer:
    """Base-10 log-probabilities of tokens; denominators are kept by context."""

    def __init__(self, model: LanguageModel):
        self.model = model
        n = model.n_classes + 1
        # One number for every context that can be; contexts of more than two places are too many.
        self.kept = np.full(n ** CONTEXT, np.nan, np.float32) if n ** CONTEXT <= 1 << 22 else None
        self.turns = n ** np.arange(CONTEXT)

    def class_scores(self, contexts: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """Natural logarithms of the probabilities of classes in their contexts."""
        p = self.model.parameters
        codes, where = np.unique(contexts @ self.turns, return_inverse=True)
        rows = codes[:, None] // self.turns % (self.model.n_classes + 1)
        if self.kept is None:
            denominators = p.log_denominators(rows)
        else:
            new = np.isnan(self.kept[codes])
            self.kept[codes[new]] = p.log_denominators(rows[new])
            denominators = self.kept[codes]
        predicted = p.predicted(rows)
        scores = np.einsum("ij,ij->i", predicted[where], p.target[tokens]) + p.bias[tokens]
        return scores.astype(np.float64) - denominators[where]

    def texts(self, numbers: list[np.ndarray]) -> tuple[np.ndarray, ...]:
        """Arrays by text: tokens, known tokens, the base score and the model's score, both without
        the shares of unknown words."""
        model = self.model
        flat = np.concatenate(numbers)
        contexts, tokens = contexts_of([model.classes(x) for x in numbers], model.n_classes)
        scores = self.class_scores(contexts, tokens) / np.log(10)
        known = flat >= 0
        counts = model.known_counts[np.where(known, flat, 0)]
        base = np.where(known, model.share_of_base(counts), 0.0)
        inner = known & (flat >= model.n_classes)
        scores += np.where(inner, np.log10((counts + 1.0) / model.rest()), 0.0)
        sizes = np.array([len(x) for x in numbers])
        starts = np.cumsum(sizes) - sizes
        hits = (known & (counts > 0)).astype(np.int64)
        return (sizes, *(np.add.reduceat(x, starts) for x in (hits, base, scores)))


def score_numbered(texts: DataFrame, model: LanguageModel, counts: DataFrame, key: str = "doc_id",
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """``score_texts`` for ``numbered_texts``."""
    shared = texts.sparkSession.sparkContext.broadcast(model)
    names = ["n", "hits", "base", "own"]
    chosen = texts.select("row", "_llm_key", *keep, "numbers")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            parts = [scorer.texts(held) for held, _ in _held(batch, batch.num_columns - 1)]
            new = [np.concatenate(c) for c in zip(*parts, strict=True)] or [[]] * 4
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *(pa.array(c, k) for c, k in zip(new, kinds, strict=True))],
                [*batch.schema.names[:-1], *names])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1]]
    partly = chosen.mapInArrow(score, ", ".join(
        [*fields, "n long, hits long, base double, own double"]))
    rare = texts.select("row", F.inline(F.arrays_zip("words", "times")))
    c = F.coalesce("c", F.lit(0))
    # The counts have one row a word, so a word that many texts have is split like a skewed join.
    looked_up = rare.join(counts.select(F.col("word").alias("words"), "c"), "words", "left")
    rest = looked_up.groupBy("row").agg(
        F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("more_hits"),
        F.sum(F.col("times") * F.log10((c + 1) / F.lit(
            float(model.n_tokens + model.n_words + 1)))).alias("more_base"),
        F.sum(F.col("times") * F.log10((c + 1) / F.lit(float(model.rest())))).alias("more_own"))

    def both(a: str, b: str) -> Column:
        return F.col(a) + F.coalesce(b, F.lit(0))

    return partly.join(rest, "row", "left").select(
        F.col("_llm_key").alias(key), *keep, F.col("n").alias("n_tokens"),
        both("hits", "more_hits").alias("n_known"),
        F.lit(model.n_tokens).cast("bigint").alias("train_tokens"),
        both("base", "more_base").alias("base_score"), both("own", "more_own").alias("score"))


def score_texts(docs: DataFrame, model: LanguageModel, counts: DataFrame, key: str = "doc_id",
                text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``key``, the ``keep`` columns, ``n_tokens``, ``n_known`` (tokens that were counted),
    ``train_tokens``, ``base_score`` and ``score`` of every row.

    Null and empty texts have one token, the end. Rows that repeat a key are scored each for
    itself. No rows give no rows; a model of no texts gives every word the same share.
    """
    return score_numbered(numbered_texts(docs, model, key, text, keep), model, counts, key, keep)


def held_out(key: str = "doc_id") -> Column:
    """Whether a row is kept from training: CRC-32 of the key as text leaves 2 modulo 7. Rows
    without a key are not held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def lm_digest(docs: DataFrame) -> DataFrame:
    """Scores of all documents by a model that the held-out ones had no part in."""
    marked = docs.select("doc_id", "text", held_out().alias("held_out"))
    counts = stored(token_counts(marked.filter("NOT held_out")))
    model = first_model(counts)
    texts = numbered_texts(marked, model, keep=("held_out",))
    model = trained(texts.filter("NOT held_out"), model)
    return score_numbered(texts, model, counts, keep=("held_out",))
