"""Benchmark items found in training text: BM25 with block-max WAND, then overlap.

The test items are the indexed side. Each item's BM25 weights are divided by the item's score
against itself, so a passage's score says what share of the item it covers, and one threshold
fits all items. Items lie in blocks; the index keeps a term's postings and its largest weight in
every block.

Training text is cut into overlapping passages, each a query. The stride is the length of the
longest item and the words that edits may add to it, so every place an item can stand lies in one
passage as a whole. Retrieval finds
all items above the threshold:

* the largest weights of a passage's terms are summed per block, for a whole batch of passages
  at once; a block whose sum stays below the threshold holds no item to find;
* in the other blocks the WAND loop walks the postings of the passage's terms, takes the first
  item at which the remaining largest weights can reach the threshold, and scores it in full.

What is retrieved is verified. An item's last sentence is its answer; the rest is the question.
A part's overlap is the share of its word 5-grams that stand in the passage or, as one changed
word kills five of those, the share of its words left after the fewest word edits that make it a
stretch of the passage, whichever is more. Enough of the item's words must be there over both
parts, and of each part enough or all but one word, so a short answer weighs by its length.

The index is broadcast up to ``INDEX_ITEMS`` items at a time; more items are as many indexes,
one after another over the same passages, so a task holds one of them.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import whole_text

K1, B = 1.2, 0.75
#: Share of an item's own score that a passage must reach.
THRESHOLD = 0.6
#: Shares of the question and the answer that must stand in a passage.
QUESTION_OVERLAP, ANSWER_OVERLAP = 0.8, 0.8
GRAM = 5
#: Small blocks have tight bounds; the bounds of an index take terms x blocks x 4 bytes.
BLOCK_ITEMS = 4
INDEX_ITEMS = 1024
LEAST_STRIDE = 32
#: Words of a text looked at in one go.
WORDS_AT_ONCE = 1 << 17

_WORD = re.compile(r"[^\W_]+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """Words of all sentences but the last one with a word, and of that one.

    An item of one sentence is a question without an answer.
    """
    parts = [w for w in map(words_of, _SENTENCE.split(text)) if w]
    if len(parts) < 2:
        return (parts[0] if parts else []), []
    return [w for p in parts[:-1] for w in p], parts[-1]


def grams(words: list[str]) -> set[tuple[str, ...]]:
    """The word n-grams; the whole sequence where there are fewer words."""
    if not words:
        return set()
    n = min(GRAM, len(words))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}


@dataclass
class Index:
    """Postings and block maxima of the items; weights are shares of an item's own score."""
    ids: list
    terms: dict[str, int]
    #: Per term: items in order, and their weights.
    postings: list[tuple[np.ndarray, np.ndarray]]
    #: Terms x blocks: the largest weight of a term in a block; one more row of zeros.
    block_max: np.ndarray
    parts: list[tuple[list[str], list[str], set, set]]
    #: Terms of the question and of the answer, in order.
    sequences: list[tuple[np.ndarray, np.ndarray]]
    stride: int

    @classmethod
    def of(cls, items: list[tuple[object, str]], corpus: tuple[int, float, dict] | None = None
           ) -> Index:
        """``corpus``: number of items, mean length and document frequencies of all items, where
        this index has only some of them."""
        listed = [(i, words_of(t), question_and_answer(t)) for i, t in items]
        listed = [x for x in listed if x[1]]
        n, mean, df = corpus or statistics([t for _, t in items])
        terms: dict[str, int] = {}
        rows: dict[int, list[tuple[int, float]]] = {}
        for at, (_, words, _) in enumerate(listed):
            weights = {}
            for term, tf in Counter(words).items():
                idf = np.log(1 + (n - df[term] + 0.5) / (df[term] + 0.5))
                weights[term] = idf * tf * (K1 + 1) / (
                    tf + K1 * (1 - B + B * len(words) / mean))
            whole = sum(weights.values())
            for term, weight in weights.items():
                rows.setdefault(terms.setdefault(term, len(terms)), []).append(
                    (at, weight / whole))
        postings = [(np.array([a for a, _ in rows[t]]), np.array([w for _, w in rows[t]]))
                    for t in range(len(terms))]
        blocks = -(-len(listed) // BLOCK_ITEMS)
        block_max = np.zeros((len(terms) + 1, max(1, blocks)), dtype=np.float32)
        for t, (at, weight) in enumerate(postings):
            # A little more, so that no sum of these falls below the true one.
            np.maximum.at(block_max[t], at // BLOCK_ITEMS,
                          (weight * 1.0001).astype(np.float32))
        return cls([i for i, _, _ in listed], terms, postings, block_max,
                   [(q, a, grams(q), grams(a)) for _, _, (q, a) in listed],
                   [tuple(np.array([terms[w] for w in p], dtype=np.int64) for p in parts)
                    for _, _, parts in listed],
                   max([LEAST_STRIDE, *(len(w) + len(w) // 4 for _, w, _ in listed)]))

    def retrieve(self, terms: np.ndarray, blocks: np.ndarray, threshold: float
                 ) -> list[tuple[int, float]]:
        """Items of the given blocks that score ``threshold`` or more with the given distinct
        terms, by the WAND loop within each block."""
        found = []
        for block in blocks.tolist():
            first, end = block * BLOCK_ITEMS, (block + 1) * BLOCK_ITEMS
            # A cursor per term: its next item, the term's largest weight here, what follows.
            cursors = []
            for t in terms[self.block_max[terms, block] > 0].tolist():
                at, weight = self.postings[t]
                a, b = np.searchsorted(at, (first, end))
                cursors.append([int(at[a]), float(self.block_max[t, block]), a, b, at, weight])
            while cursors:
                cursors.sort(key=lambda c: c[0])
                bound, pivot = 0.0, None
                for c in cursors:
                    bound += c[1]
                    if bound >= threshold:
                        pivot = c[0]
                        break
                if pivot is None:
                    break
                if cursors[0][0] == pivot:
                    score, left = 0.0, []
                    for c in cursors:
                        if c[0] == pivot:
                            score += float(c[5][c[2]])
                            c[2] += 1
                            if c[2] == c[3]:
                                continue
                            c[0] = int(c[4][c[2]])
                        left.append(c)
                    cursors = left
                    if score >= threshold:
                        found.append((pivot, score))
                else:
                    left = []
                    for c in cursors:
                        if c[0] < pivot:
                            c[2] += int(np.searchsorted(c[4][c[2]:c[3]], pivot))
                            if c[2] == c[3]:
                                continue
                            c[0] = int(c[4][c[2]])
                        left.append(c)
                    cursors = left
        return found

    def scored(self, words: list[str]) -> dict[int, float]:
        """Every item's score with the distinct words, without any pruning."""
        total: dict[int, float] = {}
        for word in set(words):
            if word in self.terms:
                for at, weight in zip(*self.postings[self.terms[word]], strict=True):
                    total[int(at)] = total.get(int(at), 0.0) + float(weight)
        return total

    def overlap(self, item: int, passage: set, numbers: np.ndarray, question: float,
                answer: float) -> tuple[float, float] | None:
        """Overlaps of question and answer with a passage, of which the n-grams and the terms in
        order are given, 1 for an empty part; None if the item is not there."""
        q, a, q_grams, a_grams = self.parts[item]

        def share(words: list[str], own: set) -> float:
            if not own:
                return 1.0
            if len(words) < GRAM:
                # Fewer words than an n-gram: they must stand in one.
                return float(any(words == list(g[i:i + len(words)])
                                 for g in passage for i in range(len(g) - len(words) + 1)))
            return len(own & passage) / len(own)

        def there(shares: list[float]) -> bool:
            return (sum(s * n for s, n in zip(shares, sizes, strict=True)) >= needed - 1e-9
                    and all(s >= level or (1 - s) * n <= 1 + 1e-9 for s, n, level
                            in zip(shares, sizes, (question, answer), strict=True)))

        sizes = (len(q), len(a))
        needed = question * len(q) + answer * len(a)
        shares = [share(q, q_grams), share(a, a_grams)]
        if shares[0] < question or shares[1] < answer:
            own = self.sequences[item]
            # No more words can be left than the passage has at all.
            if not there([max(s, float(np.isin(p, numbers).mean()) if len(p) else 1.0)
                          for s, p in zip(shares, own, strict=True)]):
                return None
            shares = [max(s, aligned_share(p, numbers)) for s, p in zip(shares, own, strict=True)]
            if not there(shares):
                return None
        return shares[0], shares[1]


def aligned_share(part: np.ndarray, passage: np.ndarray) -> float:
    """1 less the fewest edits (a word changed, put in or left out) that make ``part`` a stretch
    of ``passage``, as a share of its words; 1 for an empty part."""
    if not len(part):
        return 1.0
    steps = np.arange(len(passage) + 1)
    edits = np.zeros(len(passage) + 1, dtype=np.int64)
    for i, word in enumerate(part.tolist()):
        own = edits + 1
        own[1:] = np.minimum(own[1:], edits[:-1] + (passage != word))
        own[0] = i + 1
        edits = np.minimum.accumulate(own - steps) + steps
    return 1 - int(edits.min()) / len(part)


def statistics(texts: list[str]) -> tuple[int, float, dict[str, int]]:
    """Number of items with a word, their mean length, and in how many each word is."""
    listed = [w for w in map(words_of, texts) if w]
    df = Counter(word for words in listed for word in set(words))
    return len(listed), sum(map(len, listed)) / max(1, len(listed)), dict(df)


def _runs(text: str, stride: int) -> Iterator[list[str]]:
    """The words of a text in runs of bounded length, each with the last ``stride`` of the one
    before, so that no passage is lost at a border."""
    held: list[str] = []
    fresh = 0
    for match in _WORD.finditer(text.lower()):
        held.append(match.group())
        fresh += 1
        if fresh >= WORDS_AT_ONCE:
            yield held
            held, fresh = held[-2 * stride:], 0
    if fresh or not held:
        yield held


def _words_in_runs(text: str, stride: int) -> Iterator[list[str]]:
    if len(text) <= WORDS_AT_ONCE * 2:
        yield words_of(text)
    else:
        yield from _runs(text, stride)


def contaminated(text: str, index: Index, threshold: float = THRESHOLD,
                 question: float = QUESTION_OVERLAP, answer: float = ANSWER_OVERLAP
                 ) -> dict[int, tuple[float, float, float, int]]:
    """Items that a whole text holds: best score, overlaps and the passage's first word."""
    found: dict[int, tuple[float, float, float, int]] = {}
    stride, nothing, base = index.stride, len(index.terms), 0
    get = index.terms.get
    for words in _words_in_runs(text, stride):
        numbers = np.array([get(w, nothing) for w in words], dtype=np.int64)
        starts = np.arange(0, max(1, len(words) - stride), stride)
        if not (numbers < nothing).any():
            base += max(0, len(words) - 2 * stride)
            continue
        # Terms count once per stretch of words; a passage is two stretches, so this bound can
        # only be too high.
        stretch = np.arange(len(numbers)) // stride
        keys = np.unique(stretch * (nothing + 1) + numbers)
        own, terms = np.divmod(keys, nothing + 1)
        sums = np.zeros((int(own[-1]) + 2, index.block_max.shape[1]), dtype=np.float32)
        at = np.flatnonzero(np.diff(own, prepend=-1))
        sums[own[at]] = np.add.reduceat(index.block_max[terms], at, axis=0)
        bounds = sums[:-1] + sums[1:]
        for i in np.flatnonzero((bounds[:len(starts)] >= threshold).any(axis=1)).tolist():
            a = int(starts[i])
            passage = np.unique(numbers[a:a + 2 * stride])
            passage = passage[passage < nothing]
            exact = index.block_max[passage].sum(axis=0)
            blocks = np.flatnonzero(exact >= threshold)
            hits = index.retrieve(passage, blocks, threshold)
            if not hits:
                continue
            seen = grams(words[a:a + 2 * stride])
            for item, score in hits:
                if score <= found.get(item, (-1.0,))[0]:
                    continue
                shares = index.overlap(item, seen, numbers[a:a + 2 * stride], question, answer)
                if shares:
                    found[item] = (score, *shares, base + a)
        base += max(0, len(words) - 2 * stride)
    return found


def find_contamination(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD,
                       question: float = QUESTION_OVERLAP, answer: float = ANSWER_OVERLAP,
                       key: str = "doc_id", text: str = "text", item: str = "item_id",
                       item_text: str = "text", index_items: int = INDEX_ITEMS) -> DataFrame:
    """One row per row of ``docs`` and item found in it: ``key``, ``item``, ``score``,
    ``question_overlap``, ``answer_overlap``, ``first_word`` of the passage.

    Null and wordless texts hold nothing, null and wordless items are nowhere. Equal items are
    found together; repeated rows of ``docs`` each give their rows. Without items, or without
    documents, there are no rows.
    """
    spark = docs.sparkSession
    # The test items are the small, fixed side: they are read in parts of bounded size.
    listed = [(r[0], r[1]) for r in benchmark.filter(F.col(item_text).isNotNull())
              .select(F.col(item).cast("bigint"), item_text).orderBy(item, item_text)
              .toLocalIterator()]
    corpus = statistics([t for _, t in listed])
    chosen = docs.select(F.col(key), whole_text(text).alias("_llm_whole"))
    type_name = chosen.schema[0].dataType.simpleString()
    schema = (f"`{key}` {type_name}, `{item}` long, score double, question_overlap double, "
              "answer_overlap double, first_word long")
    kinds = (pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64())
    names = [key, item, "score", "question_overlap", "answer_overlap", "first_word"]

    def part(some: list[tuple[object, str]]) -> DataFrame:
        shared = spark.sparkContext.broadcast(Index.of(some, corpus))

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                keys, rows = [], []
                for i, value in enumerate(batch.column(1)):
                    for at, (score, q, a, first) in contaminated(
                            value.as_py(), index, threshold, question, answer).items():
                        keys.append(i)
                        rows.append((index.ids[at], score, q, a, first))
                columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(keys, pa.int64())),
                     *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names)

        return chosen.mapInArrow(search, schema)

    found = [part(listed[i:i + index_items]) for i in range(0, len(listed), index_items)]
    if not found:
        return part([])
    result = found[0]
    for more in found[1:]:
        result = result.union(more)
    return result


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id",
                      text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no item, all columns as they are. Rows are told apart by
    key and text, so a repeated key loses only the rows whose own text holds an item."""
    marked = docs.withColumn("_llm_hash", F.xxhash64(whole_text(text), F.length(whole_text(text))))
    keyed = marked.select(F.struct(F.col(key).alias("k"), "_llm_hash").alias("_llm_row"),
                          whole_text(text).alias("_llm_text"))
    held = (find_contamination(keyed, benchmark, key="_llm_row", text="_llm_text")
            .select("_llm_row").distinct())
    return marked.join(held, F.col(key).eqNullSafe(F.col("_llm_row.k"))
                       & (F.col("_llm_hash") == F.col("_llm_row._llm_hash")),
                       "left_anti").select(*docs.columns)
