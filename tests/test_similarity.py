import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from larkspur.operators import quality, similarity as sim
from larkspur.plans import matching
from larkspur.session import stored

STOP = ("the", "a")


def make_records(seed, n, start):
    """Texts with one word in most of them, many rare words, copies and an empty text."""
    rng = random.Random(seed)
    texts = []
    for i in range(n):
        if texts and rng.random() < 0.25:
            texts.append(rng.choice(texts))
            continue
        common = ["every"] * rng.randint(0, 2) + ["often"] * rng.randint(0, 1)
        rare = [f"w{rng.randint(0, 60)}" for _ in range(rng.randint(0, 5))]
        texts.append(" ".join(common + rare + ["the"]))
    texts[-1] = "The a"
    return [(start + i, t) for i, t in enumerate(texts)]


LEFT, RIGHT = make_records(1, 40, 0), make_records(2, 70, 1000)
# Some texts occur on both sides.
RIGHT[:4] = [(1000 + i, LEFT[i][1]) for i in range(4)]


def vector(text, idf):
    words = [w for w in text.lower().split() if w not in STOP]
    return {w: c / len(words) * idf[w] for w, c in Counter(words).items()}


def brute_force():
    records = LEFT + RIGHT
    holds = Counter(w for _, t in records for w in set(t.lower().split()) - set(STOP))
    idf = {w: len(records) / n for w, n in holds.items()}
    scores = {}
    for i, x in LEFT:
        for j, y in RIGHT:
            a, b = vector(x, idf), vector(y, idf)
            shared = a.keys() & b.keys()
            if shared:
                size = (math.sqrt(sum(v * v for v in a.values()))
                        * math.sqrt(sum(v * v for v in b.values())))
                scores[i, j] = round(sum(a[w] * b[w] for w in shared) / size, 12)
    return idf, scores


IDF, SCORES = brute_force()
GOLD = [(i, 1000 + i) for i in range(4)] + [(5, 1005), (39, 1001), (7, 1069), (8, 1030)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id bigint, text string")


@pytest.fixture(scope="module")
def sides(spark):
    return frame(spark, LEFT), frame(spark, RIGHT)


@pytest.fixture(scope="module")
def vectors(sides):
    return sim.build_vectors(*sides, STOP)


@pytest.fixture(params=[None, 3])
def small_blocks(request, monkeypatch):
    """Run once as is and once with limits so small that every token counts as hot."""
    if request.param:
        monkeypatch.setattr(sim, "BLOCK", request.param)
        monkeypatch.setattr(sim, "PAIRS_PER_CELL", request.param)
        monkeypatch.setattr(sim, "LISTED", 2)
        monkeypatch.setattr(sim, "SLICE", 8)
        monkeypatch.setattr(sim, "SLICES_PER_CELL", 2)
        monkeypatch.setattr(sim, "BITMAP_BITS", 5)


def assert_scores(got, expected):
    assert got.keys() == expected.keys()
    for pair, score in expected.items():
        assert abs(got[pair] - score) < 2e-12


def record_scores(pairs, vectors):
    rows = sim.expand_copies(pairs, vectors).collect()
    got = {(r.left_id, r.right_id): r.score for r in rows}
    assert len(got) == len(rows)
    return got


@pytest.mark.parametrize("least", [0.0, 0.01, 0.2, 0.9])
def test_similar_pairs_are_complete(vectors, small_blocks, least):
    pairs = sim.similar_pairs(vectors, least)
    assert_scores(record_scores(pairs, vectors),
                  {p: s for p, s in SCORES.items() if s >= least})
    copies = pairs.agg(F.sum(F.col("left_copies") * F.col("right_copies"))).first()[0]
    assert copies == sum(s >= least for s in SCORES.values())


def test_candidate_count(vectors, small_blocks):
    assert sim.candidate_count(vectors).first().candidate_pairs == len(SCORES)


def test_candidate_count_without_any(spark):
    none = sim.build_vectors(frame(spark, [(1, "x")]), frame(spark, [(1, "y")]))
    assert sim.candidate_count(none).first().candidate_pairs == 0
    assert sim.similar_pairs(none, 0.0).isEmpty()


@pytest.mark.parametrize("built", [True, False])
def test_all_pairs_summary(vectors, sides, built):
    row = (sim.all_pairs_summary(vectors, *sides) if built
           else sim.records_summary(*sides, STOP)).first()
    assert row.pairs == len(LEFT) * len(RIGHT)
    assert abs(row.sum_score - sum(SCORES.values())) < 1e-8
    assert abs(row.mean_score - sum(SCORES.values()) / row.pairs) < 2e-12


def test_no_row_is_copied_to_an_empty_cell(vectors, monkeypatch):
    """Blocks follow from the heads that are left, and cells without a partner get no rows."""
    monkeypatch.setattr(sim, "BLOCK", 3)
    for least in (0.0, 0.1, 0.45):
        rows = sim.head_cells(vectors, least).collect()
        cells = {side: {(r.token, r.left_block, r.right_block) for r in rows if r.side == side}
                 for side in ("left", "right")}
        assert cells["left"] == cells["right"]
        assert len({(r.side, r.token, r.left_block, r.right_block, r.id) for r in rows}) == len(rows)
        sizes = Counter((r.side, r.token) for r in
                        {(r.side, r.token, r.id): r for r in rows}.values())
        blocks = {(r.token, r.left_block) for r in rows}
        assert all(sum(b[0] == t for b in blocks) <= -(-n // 3)
                   for (side, t), n in sizes.items() if side == "left")


def test_record_in_all_pairs_is_spread(spark, vectors, sides, monkeypatch):
    monkeypatch.setattr(sim, "PAIRS_PER_CELL", 5)
    ids = {r.id: r.vector_id for r in vectors.left_ids.collect()}
    pairs = sides[1].select(F.lit(ids[5]).alias("left_id"), F.col("id").alias("right_id"))
    spread = sim.with_vectors(pairs, vectors.left_packed, "left_id", "right_id", "vector")
    assert spread.count() == len(RIGHT)
    plan = spread._jdf.queryExecution().toString()
    assert "cell" in plan
    known = {(r.left_id, r.right_id): r.score for r in sim.pair_scores(
        pairs.withColumn("left_id", F.lit(5).cast("bigint")), vectors).collect()}
    assert_scores(known, {(5, j): SCORES.get((5, j), 0.0) for j, _ in RIGHT})


def test_containers_do_not_grow_with_slices(vectors, monkeypatch):
    """Lists and bitmaps hold every right-hand row once, however many slices there are."""
    monkeypatch.setattr(sim, "LISTED", 8)
    held = Counter(r.token for r in vectors.right.collect())
    sizes = []
    for size in (1 << 14, 16, 2):
        monkeypatch.setattr(sim, "SLICE", size)
        listed, mapped = sim.containers(vectors)
        places = listed.agg(F.sum(F.size("bits"))).first()[0] or 0
        sizes.append(places * 8 + (mapped.agg(F.sum(F.octet_length("bits"))).first()[0] or 0))
        assert sim.candidate_count(vectors).first().candidate_pairs == len(SCORES)
    assert sizes[0] >= sizes[1] >= sizes[2] and len(held) > 0


def test_score_of_one_pair(sides):
    for i, j in (GOLD[0], GOLD[5], GOLD[6]):
        row = sim.score_of(*sides, i, j, STOP).collect()
        assert len(row) == 1 and abs(row[0].score - SCORES.get((i, j), 0.0)) < 2e-12
    assert sim.score_of(*sides, 5, 999_999, STOP).isEmpty()


def test_pair_scores(spark, vectors):
    pairs = spark.createDataFrame(GOLD + GOLD[:1] + [(5, 999_999)], "left_id bigint, right_id bigint")
    known = {(r.left_id, r.right_id): (r.score, r.times)
             for r in sim.pair_scores(pairs, vectors).collect()}
    assert known.keys() == set(GOLD)
    assert known[GOLD[0]][1] == 2
    for pair in GOLD:
        assert abs(known[pair][0] - SCORES.get(pair, 0.0)) < 2e-12
    kept = sim.pair_scores(pairs, vectors, keep_unknown=True)
    assert sim.look_up(kept, 5, 999_999).first().score == 0.0
    assert sim.look_up(kept, 123, 456).isEmpty()


def test_simple_vectors_agree(sides):
    idf = matching.token_idf(*sides, STOP)
    assert {r.token: r.idf for r in idf.collect()} == IDF
    weighted = sim.weights(sim.term_frequencies(sides[0], STOP), idf)
    got = {(r.id, r.token): r.weight for r in weighted.collect()}
    expected = {(i, w): v for i, t in LEFT for w, v in vector(t, IDF).items()}
    assert_scores(got, expected)
    norms = {r.id: r.norm for r in sim.norms(weighted).collect()}
    assert_scores(norms, {i: math.sqrt(sum(v * v for v in vector(t, IDF).values()))
                          for i, t in LEFT if vector(t, IDF)})
    assert sim.postings(weighted).count() == len(expected)


def test_text_pairs(spark, sides):
    rows = [(f"{i} {j}", dict(LEFT)[i], dict(RIGHT)[j]) for i, j in GOLD]
    pairs = spark.createDataFrame(rows, "key string, left_text string, right_text string")
    scored = sim.text_pair_scores(pairs, matching.token_idf(*sides, STOP), STOP)
    got = {r.key: r.score for r in scored.collect()}
    for i, j in GOLD:
        empty = not vector(dict(LEFT)[i], IDF) or not vector(dict(RIGHT)[j], IDF)
        expected = None if empty else SCORES.get((i, j), 0.0)
        score = got[f"{i} {j}"]
        assert score is None if empty else abs(score - expected) < 2e-12


def test_token_statistics(sides):
    sizes = [(len([w for w in t.lower().split() if w not in STOP]), i) for i, t in LEFT]
    assert sim.token_total(sides[0], STOP).first().tokens == sum(n for n, _ in sizes)
    biggest = sim.biggest_record(sides[0], STOP).first()
    assert (biggest.n_tokens, -biggest.id) == max((n, -i) for n, i in sizes)
    idf = matching.token_idf(*sides, STOP)
    lowest = [r.token for r in matching.lowest_idf(idf, 3).orderBy("rank").collect()]
    assert lowest == [w for w, _ in sorted(IDF.items(), key=lambda x: (x[1], x[0]))[:3]]
    assert matching.idf_histogram(idf).agg(F.sum("n")).first()[0] == len(IDF)


def test_duplicate_averages(spark, vectors, sides):
    gold = spark.createDataFrame(GOLD, "left_id bigint, right_id bigint")
    rows = {r.is_match: r for r in
            quality.duplicate_averages(vectors, *sides, gold).collect()}
    every = {(i, j): SCORES.get((i, j), 0.0) for i, _ in LEFT for j, _ in RIGHT}
    matches = [every[p] for p in GOLD]
    others = [s for p, s in every.items() if p not in GOLD]
    for flag, scores in ((True, matches), (False, others)):
        assert rows[flag].pairs == len(scores)
        assert abs(rows[flag].mean_score - sum(scores) / len(scores)) < 2e-12


def test_quality_curve_against_the_definition(spark, sides, small_blocks):
    gold = spark.createDataFrame(GOLD, "left_id bigint, right_id bigint")
    histogram, curve = matching.matching_quality(*sides, gold, STOP)
    known = [SCORES.get(p, 0.0) for p in GOLD]
    bins = Counter(int(s * 100) for s in SCORES.values())
    bins.subtract(int(s * 100) for s in known)
    assert {r.bin: r.n for r in histogram.collect()} == {b: n for b, n in bins.items() if n}
    rows = curve.orderBy("threshold").collect()
    assert len(rows) == 100
    for step, row in enumerate(rows):
        limit = step / 100
        fp = sum(n for b, n in bins.items() if b / 100 >= limit)
        fn = sum(s < limit for s in known)
        tp = len(known) - fn
        assert (row.threshold, row.tp, row.fp, row.fn) == (limit, tp, fp, fn)
        p = tp / (tp + fp) if tp + fp else None
        assert row.precision == p and row.recall == tp / len(known)
        if p is None or not p + row.recall:
            assert row.f is None
        else:
            assert abs(row.f - 2 * p * row.recall / (p + row.recall)) < 1e-15


def test_missed_from_follows_float_comparison(spark):
    scores = [n / 100 for n in range(101)] + [0.29 - 1e-17, 0.58, 0.570000000001, 1 + 2e-16, 0.0]
    df = spark.createDataFrame([(s,) for s in scores], "s double")
    for s, step in df.select("s", quality.missed_from(F.col("s"))).collect():
        assert step == next(n for n in range(200) if s < n / 100)


def test_vectors_of_hand_written_texts(spark):
    """dot = 2*1 + 5*20 and norm = sqrt(38) for {foo 2, bar 3, baz 5} and {foo 1, baz 20}."""
    weights = spark.createDataFrame(
        [("x", "foo", 2.0), ("x", "bar", 3.0), ("x", "baz", 5.0),
         ("y", "foo", 1.0), ("y", "bar", 0.0), ("y", "baz", 20.0)],
        "id string, token string, weight double")
    norms = {r.id: r.norm for r in sim.norms(weights).collect()}
    assert norms["x"] == math.sqrt(38)
    x, y = (weights.filter(F.col("id") == i) for i in "xy")
    dot = x.join(y.select("token", F.col("weight").alias("other")), "token").agg(
        F.sum(F.col("weight") * F.col("other"))).first()[0]
    assert dot == 102
    assert [tuple(r) for r in sim.postings(weights.limit(1)).collect()] == [("foo", "x")]


def test_stored_table_reads_back(spark):
    kept = stored(spark.range(10).withColumn("side", F.lit("l")))
    assert kept.count() == 10 and kept.columns == ["id", "side"]


def test_term_frequencies_hold_a_bounded_number_of_tokens_in_a_task(spark, monkeypatch):
    """Partitions follow from the bytes of text, and texts of one id and length count together."""
    from larkspur import session
    from larkspur.operators.similarity import term_frequencies
    rows = [(i, f"a b a c{i} {'d ' * (i % 5)}") for i in range(200)] + [(3, "b b a c3 d d d")] * 2 + [
        (None, "x y"), (None, None), (201, ""), (202, "a")]
    records = spark.createDataFrame(rows, "id long, text string")
    monkeypatch.setattr(session, "TEXT_BYTES", 50)
    found = term_frequencies(records)
    assert found.rdd.getNumPartitions() >= sum(len(t or "") for _, t in rows) // 50
    expected = {}
    for i, text in rows:
        words = (text or "").split()
        for word in words:
            key = (i, len(words), word)
            expected[key] = expected.get(key, 0) + 1
    assert sorted(((r.id or -1), r.token, round(r.tf, 9)) for r in found.collect()) == sorted(
        ((i or -1), w, round(n / size, 9)) for (i, size, w), n in expected.items())


def test_tokens_of_a_distinct_text_are_counted_in_its_row(spark):
    from larkspur.operators.similarity import _distinct_vectors
    texts = ["b a b", "b a b", "c", "", None, "a a a a"]
    records = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    found = _distinct_vectors(records, ["c"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Aggregate(") == 2 and "n_tokens" not in "".join(
        line for line in plan.splitlines() if "Aggregate(" in line)
    assert sorted((r.id, r.copies, r.token, round(r.tf, 9)) for r in found.collect()) == [
        (0, 2, "a", round(1 / 3, 9)), (0, 2, "b", round(2 / 3, 9)), (5, 1, "a", 1.0)]


def test_records_are_packed_in_partitions_of_bounded_size(spark, monkeypatch):
    """Partitions follow from the bytes of text; tokens of one side count in norms alone."""
    from larkspur import session
    left = frame(spark, [(1, "p q"), (2, "q")])
    right = frame(spark, [(i, f"q own{i} other{i}") for i in range(10, 30)] + [(9, "p q"), (9, "z z")])
    monkeypatch.setattr(session, "TEXT_BYTES", 32)
    texts = left.unionByName(right).agg(F.sum(F.octet_length("text"))).first()[0]
    assert sim._meeting_weights(left, right, ()).rdd.getNumPartitions() >= texts // 32 > 8
    vectors = sim.build_vectors(left, right)
    packed = {r.id: r.entries for r in vectors.right_packed.collect()}
    assert len(packed) == 21
    # N = 24; df of q is 23, of each own word 1: the tail of q is q's own length.
    q = 24 / 23 / 3
    (entry,) = packed[10]
    assert abs(entry.unit - q / math.sqrt(q * q + 2 * 8 * 8)) < 1e-12 and abs(entry.tail - entry.unit) < 1e-12
    # Two texts of one id make one vector, as they did before.
    p, q, z = 24 / 2 / 2, 24 / 23 / 2, 24.0
    assert sorted(round(e.unit, 9) for e in packed[9]) == sorted(
        round(w / math.sqrt(p * p + q * q + z * z), 9) for w in (p, q))
    sums = [f.first().sum_score for f in (sim.records_summary(left, right.filter("id <> 9")),
                                          sim.all_pairs_summary(sim.build_vectors(
                                              left, right.filter("id <> 9")), left, right))]
    assert abs(sums[0] - sums[1]) < 1e-12
