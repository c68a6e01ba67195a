"""Language of a text by averaged hashed subword embeddings and a linear softmax.

The letters of a text are cut into words; all n-grams of one to four characters of ``<word>`` are
hashed to buckets. A text is the mean of its buckets' embeddings, and a linear layer with
softmax turns it into a probability per language. Both are trained here by stochastic gradient
descent in numpy on a bounded sample of labelled rows: the driver gets the bucket counts of at
most ``ROWS_PER_LANGUAGE`` texts of each language, so it holds at most that many sparse vectors
of ``BUCKETS`` entries, however long the texts are. Prediction covers every whole text.

Since everything after the hashing is linear, embedding and layer are multiplied once into a
score per bucket and language, and a text's scores are the means of these.

The temperature of the softmax is fitted to texts that training did not see, and so is the
threshold below which a prediction is rejected: the largest that still keeps ``KEEP`` of those
texts that were right.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.common import hash_bounds, whole_text

BUCKETS = 1 << 16
DIMENSIONS = 16
NGRAMS = (1, 2, 3, 4)
#: Bound of the labelled sample, by language.
ROWS_PER_LANGUAGE = 1500
#: One sampled text in so many is for calibration only.
CALIBRATION = 5
EPOCHS = 6
RATE = 20.0
KEEP = 0.9995
#: No calibration set is large enough to justify rejecting what is surer than this.
HIGHEST_THRESHOLD = 0.5
UNDETERMINED = "und"
#: Characters hashed at a time.
BLOCK = 1 << 19

_WORDS = re.compile(r"[^\W\d_]+")


def _blocks(text: str) -> Iterator[np.ndarray]:
    """Code points of ``<word><word>...`` in lower case, a bounded number at a time."""
    for start in range(0, len(text), BLOCK):
        end = start + BLOCK
        # A word across a block's end is cut there; its n-grams inside are still counted.
        words = _WORDS.findall(text[start:end].lower())
        if words:
            joined = "<" + "><".join(words) + ">"
            yield np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def _bucket_numbers(points: np.ndarray) -> Iterator[np.ndarray]:
    """Buckets of the n-grams of one block, none of which reaches into another word."""
    value = points.astype(np.uint64)
    start, end = points == ord("<"), points == ord(">")
    rolled = np.zeros(len(points), dtype=np.uint64)
    for n in range(1, max(NGRAMS) + 1):
        m = len(points) - n + 1
        if m < 1:
            break
        with np.errstate(over="ignore"):
            rolled = rolled[:m] * np.uint64(0x9E3779B97F4A7C15) + value[n - 1:] + np.uint64(n)
            mixed = (rolled ^ (rolled >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        if n == 1:
            good = ~(start | end)
        else:
            # A sign at an end of the n-gram is fine, unless it closes or opens another word.
            inside = end[:m].copy()
            inside |= start[n - 1:]
            for j in range(1, n - 1):
                inside |= start[j:j + m] | end[j:j + m]
            good = ~inside
        if n in NGRAMS:
            yield (mixed[good] >> np.uint64(64 - 16)).astype(np.int64) % BUCKETS


def features(text: str) -> np.ndarray:
    """How often each bucket occurs in a whole text."""
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for points in _blocks(text):
        for numbers in _bucket_numbers(points):
            counts += np.bincount(numbers, minlength=BUCKETS)
    return counts


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    scores: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float

    def probabilities(self, mean_scores: np.ndarray) -> np.ndarray:
        z = (mean_scores + self.bias) / self.temperature
        z = np.exp(z - z.max(axis=-1, keepdims=True))
        return z / z.sum(axis=-1, keepdims=True)

    def predict(self, text: str) -> tuple[str, float, bool]:
        """Language, its calibrated probability, and whether the prediction is rejected."""
        total, n = np.zeros(len(self.languages)), 0
        for points in _blocks(text):
            for numbers in _bucket_numbers(points):
                if len(numbers) > 4 * BUCKETS:
                    counts = np.bincount(numbers, minlength=BUCKETS)
                    total += counts @ self.scores
                else:
                    # A product with ones is the sum, by the fastest way numpy has.
                    total += np.ones(len(numbers), np.float32) @ np.take(
                        self.scores, numbers, axis=0)
                n += len(numbers)
        if not n or not self.languages:
            return UNDETERMINED, 0.0, True
        p = self.probabilities(total / n)
        best = int(p.argmax())
        return self.languages[best], float(p[best]), bool(p[best] < self.threshold)


def labelled_sample(labelled: DataFrame, text: str, lang: str, rows: int = ROWS_PER_LANGUAGE
                    ) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """Language, buckets and counts of at most ``rows`` texts of each language, those with the
    smallest hashes. Equal texts of one language have one hash and count once or a few times."""
    hashed = labelled.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(text).alias("h"))
    # The hashes alone choose the rows: first a bound for each language, then the exact number.
    limits = hash_bounds(hashed, "lang", "h", rows)
    if not limits:
        return []
    condition = F.lit(False)
    for name, most in limits.items():
        condition = condition | ((F.col("lang") == name) & (F.col("h") <= most))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()  # as many as the sample has, whatever the number of copies
        for batch in batches:
            kept, numbers, counts = [], [], []
            keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for i, key in enumerate(keys):
                if key not in seen:
                    seen.add(key)
                    found = features(batch.column(2)[i].as_py())
                    kept.append(i)
                    numbers.append(np.flatnonzero(found).astype(np.int32))
                    counts.append(found[numbers[-1]])
            own = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(own), batch.column(1).take(own),
                 pa.array(numbers, pa.list_(pa.int32())),
                 pa.array(counts, pa.list_(pa.int64()))], ["lang", "h", "numbers", "counts"])

    sample = (hashed.filter(condition).select("lang", "h", "text")
              .mapInArrow(count, "lang string, h long, numbers array<int>, counts array<long>")
              # Copies of a text share its hash.
              .dropDuplicates(["lang", "h"])
              .withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("h")))
              .filter(F.col("n") <= rows).drop("n").orderBy("h", "lang"))
    return [(r["lang"], np.array(r["numbers"], dtype=np.int64), np.array(r["counts"], dtype=float))
            for r in sample.toLocalIterator() if r["numbers"]]


def fit(sample: list[tuple[str, np.ndarray, np.ndarray]], seed: int = 3) -> Model:
    """Train on four fifths of the sample and calibrate on the rest.

    Without labelled texts the model knows no language and rejects everything; with one
    language it always answers that one.
    """
    languages = tuple(sorted({name for name, _, _ in sample}))
    if not languages:
        return Model((), np.zeros((BUCKETS, 0), np.float32), np.zeros(0), 1.0, 0.0)
    index = {name: i for i, name in enumerate(languages)}
    rng = np.random.default_rng(seed)
    embedding = np.zeros((BUCKETS, DIMENSIONS))
    layer = rng.normal(0, 1 / np.sqrt(DIMENSIONS), (DIMENSIONS, len(languages)))
    bias = np.zeros(len(languages))
    training = [s for i, s in enumerate(sample) if i % CALIBRATION]
    training = training or sample
    weight = np.zeros(len(languages))
    for name, _, _ in training:
        weight[index[name]] += 1
    weight = np.where(weight > 0, len(training) / (len(languages) * np.maximum(weight, 1)), 0)
    steps = EPOCHS * len(training)
    step = 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(training)):
            name, numbers, counts = training[i]
            share = counts / counts.sum()
            hidden = share @ embedding[numbers]
            z = hidden @ layer + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[index[name]] -= 1
            rate = RATE * (1 - step / steps) * min(4.0, weight[index[name]])
            back = layer @ p
            layer -= 0.02 * rate * np.outer(hidden, p)
            bias -= 0.001 * rate * p
            embedding[numbers] -= rate * np.outer(share, back)
            step += 1
    scores = embedding @ layer
    held = [s for i, s in enumerate(sample) if i % CALIBRATION == 0] or sample
    z = np.array([(c / c.sum()) @ scores[n] for _, n, c in held]) + bias
    y = np.array([index[name] for name, _, _ in held])

    def loss(t: float) -> float:
        s = z / t
        s = s - s.max(axis=1, keepdims=True)
        return float(-(s[np.arange(len(y)), y] - np.log(np.exp(s).sum(axis=1))).mean())

    temperature = min(np.geomspace(0.1, 10, 61), key=loss)
    s = z / temperature
    p = np.exp(s - s.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    right = np.sort(p.max(axis=1)[p.argmax(axis=1) == y])
    threshold = float(right[int((1 - KEEP) * len(right))]) if len(right) else 0.0
    return Model(languages, scores.astype(np.float32), bias, float(temperature),
                 min(threshold, HIGHEST_THRESHOLD))


def train(labelled: DataFrame, text: str = "text", lang: str = "lang",
          rows: int = ROWS_PER_LANGUAGE) -> Model:
    """A model from the rows that have both a text and a language."""
    return fit(labelled_sample(labelled, text, lang, rows))


def identify(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text",
             keep: tuple[str, ...] = ()) -> DataFrame:
    """``key``, the ``keep`` columns, ``lang_pred``, ``score`` and ``rejected`` of every row.

    A null text, or one without a letter, is ``und`` with score 0 and rejected. Repeated rows
    get equal results. The model that all tasks read has ``BUCKETS`` rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    chosen = docs.select(F.col(key).alias("_llm_key"), *keep, whole_text(text).alias("_llm_whole"))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.predict(v.as_py()) for v in batch.column(batch.num_columns - 1)]
            new = list(zip(*found, strict=True)) if found else [(), (), ()]
            kinds = (pa.string(), pa.float64(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *(pa.array(c, k) for c, k in zip(new, kinds, strict=True))],
                [*batch.schema.names[:-1], "lang_pred", "score", "rejected"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1]]
    out = chosen.mapInArrow(predict, ", ".join(
        [*fields, "lang_pred string", "score double", "rejected boolean"]))
    return out.withColumnRenamed("_llm_key", key)


def held_out(key: str = "doc_id") -> Column:
    """Whether a row is kept from training: CRC-32 of the key as text leaves 2 modulo 4.
    Rows without a key are not held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def language_digest(docs: DataFrame) -> DataFrame:
    """Predictions for all documents by a model that the held-out ones had no part in."""
    marked = docs.select("doc_id", "text", "lang", held_out().alias("held_out"))
    model = train(marked.filter("NOT held_out AND doc_id IS NOT NULL"))
    return identify(marked, model, keep=("held_out",)).select(
        "doc_id", "held_out", "lang_pred", "score", "rejected")


def keep_identified(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose language is not rejected, all columns as they are.

    The model is trained on the rows of ``docs`` that have a language; without any, all rows
    with a letter are kept, as nothing can be told about them.
    """
    model = train(docs, text, lang)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def fine(texts: pd.Series) -> pd.Series:
        if not shared.value.languages:
            return texts.map(lambda t: bool(_WORDS.search(t)))
        return texts.map(lambda t: not shared.value.predict(t)[2])

    return docs.filter(fine(whole_text(text)))
