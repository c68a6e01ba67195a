"""Term weights, cosine scores and the search for similar record pairs.

Records are frames with ``id`` and ``text``. Vectors are kept long: one row per record
and distinct token, so that every step is a join or an aggregate.

Weights are term frequency times N/df (no logarithm). A record that repeats another
one's text is not weighted again: equal texts share one vector, held under their
smallest id, together with the number of copies.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.functions.text import tokens_without
from larkspur.operators.counting import total_rows
from larkspur.session import dealt, stored, text_parts

# Records of one token that meet in one task: at most about this many from each side.
BLOCK = 4096
# Pairs that one copy of a record's vector serves.
PAIRS_PER_CELL = 4096
# Of one token, more vectors of a slice than this are held as a bitmap, fewer as a list. Spark's
# bitmaps take 4 KB whatever they hold.
LISTED = 64
# Vectors per slice, bits of a bitmap, and slices that meet a token's left side in one task.
SLICE, BITMAP_BITS, SLICES_PER_CELL = 16_384, 32_768, 64
# The same sum taken in another order differs far behind this many decimals, so comparing
# rounded scores with an edge gives the same answer from run to run.
EDGE_DECIMALS = 12
# Slack for sums of doubles in comparisons that may only keep too much, never too little.
SLACK = 1e-9


# -- one side ---------------------------------------------------------------------------

def record_tokens(records: DataFrame, stopwords: Iterable[str] = ()) -> DataFrame:
    """``id``, ``tokens``: the token list of every record."""
    return records.select("id", tokens_without(F.col("text"), stopwords).alias("tokens"))


def token_total(records: DataFrame, stopwords: Iterable[str] = ()) -> DataFrame:
    """Number of tokens over all records."""
    return record_tokens(records, stopwords).agg(
        F.coalesce(F.sum(F.size("tokens")), F.lit(0)).cast("bigint").alias("tokens"))


def biggest_record(records: DataFrame, stopwords: Iterable[str] = ()) -> DataFrame:
    """The record with most tokens, the smallest id among equals."""
    sizes = record_tokens(records, stopwords).select(
        "id", F.size("tokens").cast("bigint").alias("n_tokens"))
    return sizes.orderBy(F.desc("n_tokens"), F.asc("id")).limit(1)


def term_frequencies(records: DataFrame, stopwords: Iterable[str] = ()) -> DataFrame:
    """``id``, ``token``, ``tf``: share of a record's tokens, per distinct token.

    The records are placed by id, in partitions of bounded size, before their tokens become rows,
    so the count needs no shuffle of its own and a task counts a bounded number of tokens.
    """
    placed = dealt(records, "id", "text")
    counted = _counted_tokens(record_tokens(placed, stopwords), "id").groupBy(
        "id", "n_tokens", "token").agg(F.sum("n").alias("n"))
    return counted.select("id", "token", (F.col("n") / F.col("n_tokens")).alias("tf"))


def _counted_tokens(listed: DataFrame, *keep: str) -> DataFrame:
    """The ``keep`` columns, ``n_tokens``, and a row for each distinct ``token`` of the list in
    ``tokens`` with its number ``n``. The list is sorted and cut into runs, so a task holds one
    list at a time and no table of counts."""
    ordered = listed.select(*keep, F.sort_array("tokens").alias("ordered"))
    marked = F.transform("ordered", lambda x, i: F.when(
        ~x.eqNullSafe(F.get("ordered", i - 1)), F.struct(x.alias("token"), i.alias("at"))))
    runs = ordered.select(*keep, F.size("ordered").alias("n_tokens"),
                          F.filter(marked, lambda e: e.isNotNull()).alias("runs"))
    counted = F.transform("runs", lambda e, j: F.struct(e.token.alias("token"), (F.coalesce(
        F.get("runs", j + 1).getField("at"), F.col("n_tokens")) - e.at).alias("n")))
    return runs.select(*keep, "n_tokens", F.inline(counted))


def inverse_frequencies(records: DataFrame, stopwords: Iterable[str] = ()) -> DataFrame:
    """``token``, ``df``, ``idf`` = N/df over all records."""
    present = records.select(
        F.explode(F.array_distinct(tokens_without(F.col("text"), stopwords))).alias("token"))
    return (present.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
            .withColumn("idf", total_rows(records) / F.col("df")))


def weights(frequencies: DataFrame, idf: DataFrame) -> DataFrame:
    """``id``, ``token``, ``weight``; tokens without an idf contribute nothing."""
    return (frequencies.join(idf.select("token", "idf").hint("shuffle_hash"), "token")
            .select("id", "token", (F.col("tf") * F.col("idf")).alias("weight")))


def norms(weighted: DataFrame) -> DataFrame:
    """``id``, ``norm``: length of every vector."""
    return weighted.groupBy("id").agg(
        F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))


def vector_maps(weighted: DataFrame) -> DataFrame:
    """``id``, ``vector``: each record's weights as one map, at most a text's tokens long."""
    entries = F.collect_list(F.struct("token", "weight"))
    return weighted.groupBy("id").agg(F.map_from_entries(entries).alias("vector"))


def postings(weighted: DataFrame) -> DataFrame:
    """The inverted index as (token, id) rows."""
    return weighted.select("token", "id")


def text_pair_scores(pairs: DataFrame, idf: DataFrame,
                     stopwords: Iterable[str] = ()) -> DataFrame:
    """Cosine of two texts per row: ``key``, ``left_text``, ``right_text`` in,
    ``key``, ``score`` out; NULL when a side has no weighted token."""
    def side(column: str, tag: str) -> DataFrame:
        records = pairs.select(F.col("key").alias("id"), F.col(column).alias("text"))
        return weights(term_frequencies(records, stopwords), idf).select(
            "id", "token", F.col("weight").alias(tag))

    # Adding the two sides up per token keeps tokens of one side for its norm.
    both = (side("left_text", "a").withColumn("b", F.lit(0.0))
            .unionByName(side("right_text", "b").withColumn("a", F.lit(0.0))))
    merged = both.groupBy("id", "token").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    a, b = F.col("a"), F.col("b")
    scored = merged.groupBy("id").agg(
        F.try_divide(F.sum(a * b), F.sqrt(F.sum(a * a)) * F.sqrt(F.sum(b * b))).alias("score"))
    return (pairs.select("key").join(scored.withColumnRenamed("id", "key"), "key", "left"))


# -- two sides --------------------------------------------------------------------------

@dataclass(frozen=True)
class Vectors:
    """Unit vectors of two record sets, as far as their tokens occur on both sides.

    ``left_packed``/``right_packed``: ``id``, ``copies`` and ``entries``, the vector as one array of
    ``token`` (a number), ``unit`` and ``tail`` in the order of tokens. ``unit`` is the weight
    divided by the vector's norm; ``tail`` is the length of the part of the vector from this
    token on, most frequent token last. ``left``/``right`` have a row per entry.

    Norms cover all tokens of a record, tails those that occur on both sides: no other token adds
    to a score.

    ``left_ids``/``right_ids``: ``id``, ``vector_id`` for every record.
    """

    left_packed: DataFrame
    right_packed: DataFrame
    left_ids: DataFrame
    right_ids: DataFrame

    @property
    def left(self) -> DataFrame:
        return self.left_packed.select("id", "copies", F.inline("entries"))

    @property
    def right(self) -> DataFrame:
        return self.right_packed.select("id", "copies", F.inline("entries"))


def _keyed(records: DataFrame) -> DataFrame:
    return records.select("id", "text", F.unhex(F.sha2("text", 256)).alias("text_key"))


def record_ids(records: DataFrame) -> DataFrame:
    """``id``, ``vector_id``; the text itself does not travel."""
    keyed = _keyed(records).select("id", "text_key")
    first = keyed.groupBy("text_key").agg(F.min("id").alias("vector_id"))
    return keyed.join(first, "text_key").select("id", "vector_id")


def _distinct_vectors(records: DataFrame, stopwords: Iterable[str]) -> DataFrame:
    """Term frequencies per distinct text.

    One shuffle by text key removes copies (partially before the shuffle); the tokens of a text
    are then counted within its row.
    """
    once = _keyed(records).groupBy("text_key").agg(
        F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"),
        F.first("text").alias("text"))
    listed = once.select("id", "copies", tokens_without(F.col("text"), stopwords).alias("tokens"))
    return _counted_tokens(listed, "id", "copies").select(
        "id", "copies", "token", (F.col("n") / F.col("n_tokens")).alias("tf"))


def _token_counts(frequencies: DataFrame) -> DataFrame:
    """``token``, ``df`` over all records, and the distinct vectors of each side that hold it."""
    return frequencies.groupBy("token").agg(
        F.sum("copies").alias("df"),
        F.count_if(F.col("side") == "left").alias("left_df"),
        F.count_if(F.col("side") == "right").alias("right_df"))


def _weighted(frequencies: DataFrame, idf: DataFrame, n_records: Column) -> DataFrame:
    # One idf row per token: each task's share fits a hash table, and nothing is sorted.
    # A token has at most one row per distinct text, so even one found everywhere is a
    # small part of all rows; adaptive execution splits its partition if it is large.
    return frequencies.join(idf, "token").withColumn(
        "weight", F.col("tf") * (n_records / F.col("df")))


def _both_sides(left: DataFrame, right: DataFrame, stopwords: Iterable[str]) -> DataFrame:
    """Term frequencies of the distinct texts of both sides, with ``side``."""
    return (_distinct_vectors(left, stopwords).withColumn("side", F.lit("left"))
            .unionByName(_distinct_vectors(right, stopwords).withColumn("side", F.lit("right"))))


def _meeting_weights(left: DataFrame, right: DataFrame, stopwords: Iterable[str]) -> DataFrame:
    """``side``, ``id``, ``copies``, ``number``, ``df``, ``weight``, ``square``: a row for every
    record and token that both sides hold, and one more for a record's other tokens together, with
    nothing but the sum of their ``square``. That sum is all that scores need of them.

    Term frequencies and counts are written once. The rows of a record are placed together, in
    partitions of bounded size.
    """
    frequencies = stored(_both_sides(left, right, stopwords))
    counts = stored(_token_counts(frequencies).withColumn(
        "number", F.monotonically_increasing_id()))
    n_records = total_rows(left) + total_rows(right)
    met = (F.col("left_df") > 0) & (F.col("right_df") > 0)
    square = F.col("weight") * F.col("weight")
    # Few tokens may be on both sides; written by themselves, they are joined by their real size.
    shared = stored(counts.filter(met).select("token", "df", "number"))
    rows = _weighted(frequencies, shared, n_records).select(
        "side", "id", "copies", "number", "df", "weight", square.alias("square"))
    others = (_weighted(frequencies, counts.filter(~met).select("token", "df").hint("shuffle_hash"),
                        n_records)
              .groupBy("side", "id", "copies").agg(F.sum(square).alias("square")))
    texts = left.select("text").unionByName(right.select("text"))
    return rows.unionByName(others, allowMissingColumns=True).repartition(
        text_parts(texts, "text"), "id", "side")


def build_vectors(left: DataFrame, right: DataFrame, stopwords: Iterable[str] = ()) -> Vectors:
    """Unit vectors of both sides, written once: they feed every search and summary built on them."""
    rows = _meeting_weights(left, right, tuple(stopwords))
    # A record's tokens are one text's tokens, so this window never holds more than a text. The
    # row of other tokens has no df and comes last: it is in the norm and in no tail.
    rare_last = Window.partitionBy("id", "side").orderBy(
        F.desc_nulls_last("df"), F.desc_nulls_last("number"))
    whole = rare_last.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    so_far = rare_last.rowsBetween(Window.unboundedPreceding, 0)
    lengths = (rows.withColumn("norm", F.sqrt(F.sum("square").over(whole)))
               .withColumn("up_to", F.sqrt(F.sum("square").over(so_far))))
    # The rows of a record are together, so packing them needs no further shuffle.
    entry = F.struct(F.col("number").alias("token"),
                     (F.col("weight") / F.col("norm")).alias("unit"),
                     (F.col("up_to") / F.col("norm")).alias("tail"))
    packed = stored(lengths.filter("number IS NOT NULL").groupBy("id", "side").agg(
        F.first("copies").alias("copies"), F.sort_array(F.collect_list(entry)).alias("entries")))
    return Vectors(packed.filter("side = 'left'").drop("side"),
                   packed.filter("side = 'right'").drop("side"),
                   record_ids(left), record_ids(right))


def head_cells(vectors: Vectors, least_tail: float = 0.0) -> DataFrame:
    """The rows of both sides that may meet in a token, each once for every cell it has to meet
    the other side in: ``side``, ``token``, ``left_block``, ``right_block``, ``id``, ``copies``,
    ``unit``.

    Only heads take part, the rows up to where the rest of a vector is shorter than
    ``least_tail``. A token held by l heads of the left and r of the right becomes a grid of
    ceil(l/BLOCK) x ceil(r/BLOCK) cells instead of one join key, and a row is only copied to
    cells that hold rows of the other side. Rare tokens have one cell.
    """
    def heads(packed: DataFrame, side: str) -> DataFrame:
        head = F.filter("entries", lambda e: e.tail >= least_tail - SLACK)
        return packed.select(F.lit(side).alias("side"), "id", "copies", F.inline(head)).drop("tail")

    rows = heads(vectors.left_packed, "left").unionByName(heads(vectors.right_packed, "right"))
    on_left = F.col("side") == "left"
    grid = rows.groupBy("token").agg(
        F.ceil(F.count_if(on_left) / BLOCK).alias("left_blocks"),
        F.ceil(F.count_if(~on_left) / BLOCK).alias("right_blocks"),
    ).filter("left_blocks > 0 AND right_blocks > 0")
    placed = rows.join(grid.hint("shuffle_hash"), "token").withColumn("own", F.pmod(
        F.xxhash64("id"), F.when(on_left, F.col("left_blocks")).otherwise(F.col("right_blocks"))))
    # Few tokens have more than one block, and few of their blocks can be empty.
    taken = (placed.filter("left_blocks > 1 OR right_blocks > 1").groupBy("token").agg(
        F.collect_set(F.when(on_left, F.col("own"))).alias("lefts"),
        F.collect_set(F.when(~on_left, F.col("own"))).alias("rights")))
    one = F.array(F.lit(0).cast("bigint"))
    met = (placed.join(taken, "token", "left")
           .withColumn("other", F.explode(F.coalesce(
               F.when(on_left, F.col("rights")).otherwise(F.col("lefts")), one))))
    return met.select("side", "token",
                      F.when(on_left, F.col("own")).otherwise(F.col("other")).alias("left_block"),
                      F.when(on_left, F.col("other")).otherwise(F.col("own")).alias("right_block"),
                      "id", "copies", "unit")


def _meeting(vectors: Vectors, least_tail: float) -> DataFrame:
    """Token join of the two sides' heads, cell by cell: ``left_id``, ``right_id``, ``product``."""
    cells = head_cells(vectors, least_tail)

    def side(name: str) -> DataFrame:
        return cells.filter(F.col("side") == name).select(
            "token", "left_block", "right_block",
            *(F.col(c).alias(f"{name}_{c}") for c in ("id", "copies", "unit")))

    return side("left").join(side("right"), ["token", "left_block", "right_block"]).select(
        "left_id", "right_id", "left_copies", "right_copies",
        (F.col("left_unit") * F.col("right_unit")).alias("product"))


def with_vectors(pairs: DataFrame, packed: DataFrame, own: str, other: str, name: str,
                 counted: DataFrame | None = None) -> DataFrame:
    """``pairs`` with the vectors of the records in column ``own``, each as one array ``name`` of
    entries in the order of tokens. Pairs whose record has no vector drop out.

    How many pairs a record is in is counted first. One in many pairs has its vector copied, a
    copy for every ``PAIRS_PER_CELL`` pairs, and its pairs are dealt to the copies, so a record
    found in all pairs is spread over many tasks. ``counted`` may give the same pairs by a
    shorter way.
    """
    hot = ((counted or pairs).groupBy(own).agg(F.ceil(F.count(F.lit(1)) / PAIRS_PER_CELL).alias("cells"))
           .filter("cells > 1"))
    dealt = pairs.join(hot, own, "left").withColumn(
        "cell", F.pmod(F.xxhash64(other), F.coalesce("cells", F.lit(1)))).drop("cells")
    wanted = packed.select(F.col("id").alias(own), F.col("entries").alias(name))
    copied = wanted.join(hot, own, "left").select(own, name, F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.coalesce("cells", F.lit(1)) - 1)).alias("cell"))
    return dealt.join(copied, [own, "cell"]).drop("cell")


def vector_scores(pairs: DataFrame, vectors: Vectors) -> DataFrame:
    """``pairs`` of vectors (``left_id`` and ``right_id``, each pair once) with their ``score``.
    Only one packed vector per side and pair travels, and the product is taken row by row."""
    # The degrees are counted on the pairs as they were given, before vectors are beside them.
    left = with_vectors(pairs, vectors.left_packed, "left_id", "right_id", "left_vector")
    both = with_vectors(left, vectors.right_packed, "right_id", "left_id", "right_vector", pairs)
    both = both.withColumn("common", F.array_intersect("left_vector.token", "right_vector.token"))

    def shared(vector: str) -> Column:
        return F.filter(vector, lambda e: F.array_contains("common", e.token))

    # Both vectors are in the order of tokens, so what they share stands in the same places.
    products = F.zip_with(shared("left_vector"), shared("right_vector"),
                          lambda a, b: a.unit * b.unit)
    return both.withColumn("score", F.aggregate(products, F.lit(0.0), lambda x, y: x + y)).drop(
        "left_vector", "right_vector", "common")


def reaches(score: Column, least: float) -> Column:
    """Whether a score is ``least`` or more, whatever the order its sum was taken in."""
    return F.round(score, EDGE_DECIMALS) >= least


def similar_pairs(vectors: Vectors, min_score: float) -> DataFrame:
    """All vector pairs with a shared token and a cosine of at least ``min_score``:
    ``left_id``, ``right_id``, ``score``, ``left_copies``, ``right_copies``.

    With ``min_score`` 0 this lists every pair that shares a token. Above 0 most such
    pairs never come up, and the result is still complete. Both vectors are cut, in the
    order rare to frequent token, where the rest is shorter than half of ``min_score``.
    Tokens outside both heads can add less than that half to a score, so a pair that
    reaches ``min_score`` must collect at least the other half from tokens in both heads.
    Pairs that do are written once, and in a second pass scored in full.
    """
    columns = ["left_id", "right_id", "score", "left_copies", "right_copies"]
    half = min_score / 2
    met = (_meeting(vectors, half).groupBy("left_id", "right_id")
           .agg(F.sum("product").alias("score"), F.max("left_copies").alias("left_copies"),
                F.max("right_copies").alias("right_copies")))
    if min_score <= 0:
        return met.select(columns)
    promising = stored(met.filter(F.col("score") >= half - SLACK).drop("score"))
    return (vector_scores(promising, vectors).filter(reaches(F.col("score"), min_score))
            .select(columns))


def expand_copies(pairs: DataFrame, vectors: Vectors) -> DataFrame:
    """Repeat every vector pair for all records that share the two texts."""
    left = vectors.left_ids.select(F.col("vector_id").alias("left_id"), F.col("id").alias("l"))
    right = vectors.right_ids.select(F.col("vector_id").alias("right_id"), F.col("id").alias("r"))
    return (pairs.join(left, "left_id").join(right, "right_id")
            .select(F.col("l").alias("left_id"), F.col("r").alias("right_id"), "score"))


def pair_scores(pairs: DataFrame, vectors: Vectors, keep_unknown: bool = False) -> DataFrame:
    """Cosine of the given record pairs, 0 where they share no token: ``left_id``,
    ``right_id``, ``score``, ``times``.

    One row per distinct pair, with the number of times it was given. Pairs naming an
    unknown record drop out, or get 0 with ``keep_unknown``.
    """
    how = "left" if keep_unknown else "inner"
    left_ids = vectors.left_ids.select(F.col("id").alias("left_id"),
                                       F.col("vector_id").alias("left_vector"))
    right_ids = vectors.right_ids.select(F.col("id").alias("right_id"),
                                         F.col("vector_id").alias("right_vector"))
    given = stored(pairs.groupBy("left_id", "right_id").agg(F.count(F.lit(1)).alias("times"))
                   .join(left_ids, "left_id", how).join(right_ids, "right_id", how))
    # Records with equal texts share a vector: each pair of vectors is scored once.
    met = given.filter("left_vector IS NOT NULL AND right_vector IS NOT NULL").select(
        F.col("left_vector").alias("left_id"), F.col("right_vector").alias("right_id")).distinct()
    scored = vector_scores(met, vectors).select(
        F.col("left_id").alias("left_vector"), F.col("right_id").alias("right_vector"), "score")
    return given.join(scored, ["left_vector", "right_vector"], "left").select(
        "left_id", "right_id", F.coalesce("score", F.lit(0.0)).alias("score"), "times")


def score_of(left: DataFrame, right: DataFrame, left_id: object, right_id: object,
             stopwords: Iterable[str] = ()) -> DataFrame:
    """The score of one left and one right record, one row ``score``, 0 where they share no
    token; no row when either is absent.

    Only these two records get weights. All others are read for one thing, how many of them
    hold the tokens of the two.
    """
    stopwords = tuple(stopwords)
    def record(records: DataFrame, which: object, name: str) -> DataFrame:
        return records.filter(F.col("id") == which).select(
            F.lit(0).alias("key"), F.col("text").alias(name))

    pair = record(left, left_id, "left_text").join(record(right, right_id, "right_text"), "key")
    own = pair.select(F.explode(F.array_distinct(F.concat(
        tokens_without(F.col("left_text"), stopwords),
        tokens_without(F.col("right_text"), stopwords)))).alias("token")).distinct()
    corpus = left.select("text").unionByName(right.select("text"))
    held = corpus.select(F.explode(F.array_distinct(
        tokens_without(F.col("text"), stopwords))).alias("token")).join(own, "token", "left_semi")
    idf = held.groupBy("token").agg(F.count(F.lit(1)).alias("df")).withColumn(
        "idf", total_rows(corpus) / F.col("df"))
    return text_pair_scores(pair, idf, stopwords).select(
        F.coalesce("score", F.lit(0.0)).alias("score"))


def look_up(scores: DataFrame, left_id: object, right_id: object) -> DataFrame:
    """The score of one pair; no row when the pair is absent."""
    return scores.filter((F.col("left_id") == left_id) & (F.col("right_id") == right_id)
                         ).select("score")


def all_pairs_summary(vectors: Vectors, left: DataFrame, right: DataFrame) -> DataFrame:
    """Count, sum and mean of the cosine over every left-right record pair, one row.

    The sum over all pairs of sum over tokens equals the sum over tokens of the two
    sides' totals multiplied, so no pair is ever formed.
    """
    units = (vectors.left.withColumn("side", F.lit("left"))
             .unionByName(vectors.right.withColumn("side", F.lit("right"))))
    return _summary(units, left, right)


def records_summary(left: DataFrame, right: DataFrame, stopwords: Iterable[str] = ()) -> DataFrame:
    """``all_pairs_summary`` of two record sets whose vectors nothing else needs. A record's weights
    come together once, for its norm, and go on as units; nothing is ordered by token."""
    own = Window.partitionBy("id", "side", "copies")
    units = (_meeting_weights(left, right, tuple(stopwords))
             .withColumn("norm", F.sqrt(F.sum("square").over(own)))
             .filter("number IS NOT NULL")
             .select("side", "copies", F.col("number").alias("token"),
                     (F.col("weight") / F.col("norm")).alias("unit")))
    return _summary(units, left, right)


def _summary(units: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    own = F.col("copies") * F.col("unit")
    total = (units.groupBy("token")
             .agg(F.sum(F.when(F.col("side") == "left", own)).alias("a"),
                  F.sum(F.when(F.col("side") == "right", own)).alias("b"))
             .agg(F.coalesce(F.sum(F.col("a") * F.col("b")), F.lit(0.0)).alias("sum_score")))
    counted = total.withColumn("pairs", total_rows(left) * total_rows(right))
    return counted.select("pairs", "sum_score",
                          F.try_divide("sum_score", "pairs").alias("mean_score"))


def containers(vectors: Vectors) -> tuple[DataFrame, DataFrame]:
    """The right side by token and slice, in two forms. Lists: ``token``, ``slice``, ``power``,
    ``bits``, the places of at most ``LISTED`` vectors. Bitmaps: the same, as one bitmap of more.

    Every right-hand vector has a slice and a place in it. Copies are counted by splitting their
    number into powers of two, each with containers of its own.
    """
    right = vectors.right.select("id", "copies", "token")
    members = right.select("id").distinct()
    slices = F.greatest(F.ceil(total_rows(members) / SLICE), F.lit(1))
    sliced = members.withColumn("part", F.pmod(F.xxhash64("id"), slices))
    place = F.row_number().over(Window.partitionBy("part").orderBy("id")) - 1
    # A slice that drew more vectors than a bitmap has bits goes on in further slices, whose
    # numbers lie above those of all parts.
    more = F.floor(place / BITMAP_BITS)
    placed = sliced.withColumn("place", place).withColumn("more", more).select(
        "id", (F.col("part") + F.col("more") * slices).alias("slice"),
        (F.col("place") % BITMAP_BITS).cast("bigint").alias("bit"))
    powers = F.filter(F.sequence(F.lit(0), F.floor(F.log2("copies")).cast("int")),
                      lambda p: F.call_function("shiftright", F.col("copies"), p).bitwiseAND(1) == 1)
    located = right.join(placed, "id").select("token", "slice", "bit", F.explode(powers).alias("power"))
    held = stored(located.groupBy("token", "slice", "power").agg(F.collect_list("bit").alias("bits")))
    listed = held.filter(F.size("bits") <= LISTED)
    mapped = (held.filter(F.size("bits") > LISTED)
              .select("token", "slice", "power", F.explode("bits").alias("bit"))
              .groupBy("token", "slice", "power").agg(F.bitmap_construct_agg("bit").alias("bits")))
    return listed, mapped


def _meeting_containers(vectors: Vectors, held: DataFrame, grid: DataFrame) -> DataFrame:
    """Left-hand vectors with the containers of their tokens: ``id``, ``copies``, ``slice``, ``power``,
    ``bits``. A token's containers meet its left side in cells of at most about ``BLOCK`` vectors
    and ``SLICES_PER_CELL`` slices."""
    rows = (vectors.left.join(grid, "token")
            .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
            .select("id", "copies", "token", "block", F.explode("groups").alias("group")))
    right = (held.join(grid.select("token", "blocks"), "token")
             .select("token", "slice", "power", "bits", _slice_group().alias("group"), F.explode(
                 F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block")))
    return rows.join(right, ["token", "block", "group"]).select(
        "id", "copies", "slice", "power", "bits")


def _slice_group() -> Column:
    return F.floor(F.col("slice") / SLICES_PER_CELL)


def _container_grid(vectors: Vectors, listed: DataFrame, mapped: DataFrame) -> DataFrame:
    """Per token of both sides: the ``blocks`` its left side is cut into, and the ``groups`` of slices
    its containers lie in."""
    held = listed.select("token", "slice").unionByName(mapped.select("token", "slice"))
    groups = held.groupBy("token").agg(F.collect_set(_slice_group()).alias("groups"))
    blocks = vectors.left.groupBy("token").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    return groups.join(blocks, "token")


def candidate_count(vectors: Vectors) -> DataFrame:
    """How many record pairs share at least one token, one row ``candidate_pairs``.

    A frequent token's vectors are one bit each in a bitmap per slice; per left vector the
    bitmaps are merged and counted. What lists add are single places; those that no merged bitmap
    has are counted once. So a token held by a third of all records costs one bit per pair
    instead of a row, and a token held by few costs no bitmap.
    """
    listed, mapped = containers(vectors)
    keys = ["id", "copies", "slice", "power"]
    grid = _container_grid(vectors, listed, mapped)
    merged = _meeting_containers(vectors, mapped, grid).groupBy(keys).agg(
        F.bitmap_or_agg("bits").alias("bits"))
    places = (_meeting_containers(vectors, listed, grid)
              .select(*keys, F.explode("bits").alias("bit")).distinct())
    byte = F.conv(F.hex(F.substring("bits", (F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10)
    in_map = F.call_function("shiftright", byte.cast("int"),
                             (F.col("bit") % 8).cast("int")).bitwiseAND(1) == 1
    alone = (places.join(merged, keys, "left")
             .filter(F.col("bits").isNull() | ~in_map)
             .groupBy(keys).agg(F.count(F.lit(1)).alias("vectors")))
    counted = merged.select(*keys, F.bitmap_count("bits").alias("vectors")).unionByName(alone)
    weight = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("power"))
    pairs = F.sum(F.col("copies") * F.col("vectors") * weight)
    return counted.agg(F.coalesce(pairs, F.lit(0)).alias("candidate_pairs"))
