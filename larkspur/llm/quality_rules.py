"""Quality rules for documents, and verdicts on the hosts they come from.

Each document is measured and held against rules. A host's documents tell more than one of them:
the failures of each rule are summed by host, and the failure rate is shrunk towards what is
usual. The usual is a beta distribution whose two parameters are fitted to all hosts' rates (by
moments, empirical Bayes), so a host with few documents stays near the common rate and a large
one near its own. A host whose shrunk rate is above ``most_failures`` for some rule fails, and its
verdict is joined back to its documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import BLANKS, whole_text
from larkspur.session import stored

LEAST_WORDS = 20
MOST_REPEATED = 30
WINDOW = 8
SYMBOLS = "#*$%&|<>"
#: A host of which more than this share is expected to fail a rule is left out.
MOST_FAILURES = 0.6

_MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Odd factors for the rolling hash of a window, one per place.
_FACTORS = np.array([pow(0x9E3779B97F4A7C15, i + 1, 1 << 64) | 1 for i in range(64)],
                    dtype=np.uint64)

#: SQL conditions under which a document fails; each is counted by host on its own.
RULES = {
    "few_words": f"n_words < {LEAST_WORDS}",
    "repetition": f"100 * n_repeat_words > {MOST_REPEATED} * n_words",
    "symbols": "10 * n_symbols > 3 * n_words",
    "repeated_lines": "n_dup_lines > 3 AND 2 * n_dup_lines > n_lines",
}
#: The rules that also leave out the document itself.
OWN_RULES = ("few_words", "repetition")


def repeated_words(words: list, window: int = WINDOW) -> int:
    """Words in windows that are found twice or more, all occurrences counted.

    Windows are compared by a 64-bit rolling hash of the words' hashes, and those that agree
    word by word.
    """
    n = len(words) - window + 1
    if n < 2:
        return 0
    hashes = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)
    with np.errstate(over="ignore"):
        rolled = np.zeros(n, dtype=np.uint64)
        for i in range(window):
            rolled += hashes[i:i + n] * _FACTORS[i]
            rolled ^= rolled >> np.uint64(29)
    order = np.argsort(rolled, kind="stable")
    equal = np.diff(rolled[order]) == 0
    if not equal.any():
        return 0
    again = np.zeros(n, dtype=bool)
    again[order[1:][equal]] = True
    again[order[:-1][equal]] = True
    places: dict[tuple, list[int]] = {}
    for i in np.flatnonzero(again).tolist():
        places.setdefault(tuple(words[i:i + window]), []).append(i)
    steps = np.zeros(len(words) + 1, dtype=np.int64)
    for found in places.values():
        if len(found) > 1:
            at = np.array(found)
            steps[at] += 1
            steps[at + window] -= 1
    return int((np.cumsum(steps) > 0).sum())


def measures(text: str) -> tuple[int, int, int, int, int, int]:
    """The values of ``_MEASURES`` for a whole text, and its number of lines."""
    words = text.encode("utf-8", "surrogatepass").split()
    seen, repeated, n_lines = set(), 0, 0
    for line in text.split("\n"):
        n_lines += 1
        if line in seen:
            repeated += 1
        elif line.strip(BLANKS):
            seen.add(line)
    return (len(words), len(text) - sum(text.count(c) for c in BLANKS),
            sum(text.count(c) for c in SYMBOLS), repeated, repeated_words(words), n_lines)


def measure(docs: DataFrame, columns: list[Column], text: str = "text") -> DataFrame:
    """``columns`` and the measures of every row; a null text has none of anything."""
    fields = [f"{name} long" for name in (*_MEASURES, "n_lines")]
    chosen = docs.select(*columns, whole_text(text).alias("_llm_whole"))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [measures(value.as_py()) for value in batch.column(batch.num_columns - 1)]
            new = zip(*rows, strict=True) if rows else [()] * len(fields)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *(pa.array(c, pa.int64()) for c in new)],
                [*batch.schema.names[:-1], *(f.split()[0] for f in fields)])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1])
    return chosen.mapInArrow(add, ", ".join([kept, *fields]))


def host_verdicts(measured: DataFrame, host: str, most_failures: float = MOST_FAILURES
                  ) -> DataFrame:
    """One row per host: documents ``n``, per rule the failures, the shrunk rate
    ``<rule>_rate`` and ``host_failed``. Documents without a host make up a host of their own.

    The prior of a rule has the common rate as its mean. Its weight in documents follows from
    the variance of the hosts' rates, less what counting alone adds to it; where nothing is
    left (hosts do not differ, or there is one), it weighs as much as 1000 documents.
    """
    counts = measured.groupBy(F.col(host).alias("_host")).agg(
        F.count(F.lit(1)).alias("n"),
        *(F.count_if(F.expr(condition)).alias(rule) for rule, condition in RULES.items()))
    moments = counts.agg(
        *((F.sum(rule) / F.sum("n")).alias(f"{rule}_mean") for rule in RULES),
        *(F.var_pop(F.col(rule) / F.col("n")).alias(f"{rule}_var") for rule in RULES),
        F.avg(1 / F.col("n")).alias("inverse_n"))
    usual = moments.first()  # one row, whatever the input
    failed, rates = F.lit(False), {}
    for rule in RULES:
        mean = usual[f"{rule}_mean"] or 0.0
        spread = mean * (1 - mean)
        variance = (usual[f"{rule}_var"] or 0.0) - spread * (usual["inverse_n"] or 0.0)
        weight = max(1.0, spread / variance - 1 if variance > spread / 1001 else 1000.0)
        rates[f"{rule}_rate"] = (F.col(rule) + mean * weight) / (F.col("n") + weight)
        failed = failed | (rates[f"{rule}_rate"] > most_failures)
    joined = counts.withColumns(rates)
    return joined.withColumn("host_failed", failed).select(
        "_host", "n", *RULES, *(f"{rule}_rate" for rule in RULES), "host_failed")


def judge(docs: DataFrame, host: str = "source", most_failures: float = MOST_FAILURES,
          key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: ``key``, the host, all measures, ``base_failed``, ``host_failed`` and
    ``kept``.

    Null texts and empty texts have no words and fail. Repeated rows each count for their
    host. The verdicts are one small row per host, joined by Spark's own choice.
    """
    measured = stored(measure(docs, [F.col(key).alias("_llm_key"), F.col(host).alias("_llm_host")],
                              text))
    verdicts = host_verdicts(measured, "_llm_host", most_failures)
    base = F.lit(False)
    for rule in OWN_RULES:
        base = base | F.expr(RULES[rule])
    return (measured.join(verdicts, F.col("_llm_host").eqNullSafe(F.col("_host")), "left")
            .select(F.col("_llm_key").alias(key), F.col("_llm_host").alias(host), *_MEASURES,
                    "n_lines", base.alias("base_failed"), "host_failed",
                    (~base & ~F.col("host_failed")).alias("kept")))


def quality_digest(docs: DataFrame) -> DataFrame:
    """Measures and verdicts per document; its ``source`` is its host."""
    return judge(docs).select("doc_id", *_MEASURES, "base_failed", "kept", "host_failed")
