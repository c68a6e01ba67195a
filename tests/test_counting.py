import gzip

from pyspark.sql import functions as F

from larkspur.operators import counting
from larkspur.operators.lines import number_rows, number_text_lines
from larkspur.plans import words as plans
from larkspur.plans.registry import QUERIES
from larkspur.sources.lines import read_lines

WORDS = ["cat", "elephant", "rat", "rat", "cat"]


def as_words(spark, values=WORDS):
    return spark.createDataFrame([(i % 2, w, 1) for i, w in enumerate(values)],
                                 "part int, word string, one int")


def test_word_count(spark):
    df = as_words(spark)
    counts = counting.count_by(df, "word")
    assert sorted(tuple(r) for r in counts.collect()) == [("cat", 2), ("elephant", 1), ("rat", 2)]
    mean = plans.mean_count_per_word(df).first()
    assert (mean.words, mean.unique_words, mean.mean_count) == (5, 3, 1.67)
    assert counting.distinct_count(df, "word", "n").first().n == 3


def test_grouped_values_stay_bounded_by_the_inner_column(spark):
    grouped = counting.grouped_values(as_words(spark), "word", "one", within="part")
    rows = sorted((r.word, r.part, r["values"]) for r in grouped.collect())
    assert rows == [("cat", 0, [1, 1]), ("elephant", 1, [1]), ("rat", 0, [1]), ("rat", 1, [1])]
    sums = counting.sum_grouped_values(grouped, "word")
    assert sorted(tuple(r) for r in sums.collect()) == [("cat", 2), ("elephant", 1), ("rat", 2)]


def test_top_breaks_ties_and_sorts_per_task(spark):
    best = counting.top_by_count(as_words(spark), "word", 2)
    assert [(r.word, r.n, r["rank"]) for r in best.orderBy("rank").collect()] == [
        ("cat", 2, 1), ("rat", 2, 2)]
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_share_sums_to_one(spark):
    shares = counting.with_share(counting.count_by(as_words(spark), "word"))
    assert abs(shares.agg(F.sum("share")).first()[0] - 1) < 1e-12


def test_exclude_words(spark):
    listed = spark.createDataFrame([("cat",), ("cat",)], "w string")
    left = counting.exclude_words(as_words(spark), "word", listed)
    assert sorted(r.word for r in left.collect()) == ["elephant", "rat", "rat"]


def test_multiset_difference(spark):
    one = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "n")], "k int, v string")
    two = spark.createDataFrame([(1, "a"), (3, "c"), (None, "n")], "k int, v string")
    rows = {(r.k, r.v): r.surplus for r in counting.multiset_difference(one, two).collect()}
    assert rows == {(1, "a"): 1, (2, "b"): 1, (3, "c"): -1}
    assert counting.multiset_difference(one, one).isEmpty()


def test_equal_width_histogram(spark):
    values = spark.createDataFrame([(float(v),) for v in (0, 1, 2, 5, 9, 10, 10)], "v double")
    bins = counting.equal_width_histogram(values, "v", 5)
    assert {r.bin: r.n for r in bins.collect()} == {0: 2, 1: 1, 2: 1, 4: 3}
    same = values.filter("v = 10")
    assert [tuple(r) for r in counting.equal_width_histogram(same, "v", 5).collect()] == [(0, 2)]


def test_number_rows_with_one_hot_key(spark):
    rows = [(0 if i % 3 else i, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, id int").repartition(7)
    numbered = number_rows(df, [F.col("k"), F.col("id")])
    got = sorted((r["index"], r.k, r.id) for r in numbered.collect())
    assert got == [(i, *row) for i, row in enumerate(sorted(rows))]


def test_number_text_lines_over_blocks_and_files(spark, tmp_path):
    first = [f"line {i} " + "x" * (i % 50) for i in range(4000)]
    second = [f"other {i}" for i in range(37)]
    (tmp_path / "a.txt").write_text("\n".join(first) + "\n")
    (tmp_path / "b.txt").write_text("\n".join(second) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        lines = read_lines(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 3
        got = number_text_lines(lines).orderBy("index").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [r["index"] for r in got] == list(range(4037))
    assert [r.value for r in got] == first + second


def test_number_text_lines_over_plain_and_compressed_files(spark, tmp_path):
    files = {"a.txt": [f"a {i} " + "x" * (i % 40) for i in range(3000)], "b.txt": ["one"],
             "c.txt": [], "d.txt.gz": [f"d {i}" for i in range(1500)],
             "e.txt": [f"e {i}" for i in range(200)]}
    for name, rows in files.items():
        opened = gzip.open if name.endswith(".gz") else open
        with opened(tmp_path / name, "wt") as out:
            out.writelines(row + "\n" for row in rows)
    sizes = {"spark.sql.files.maxPartitionBytes": "20000", "spark.sql.files.openCostInBytes": "100"}
    before = {key: spark.conf.get(key) for key in sizes}
    for key, value in sizes.items():
        spark.conf.set(key, value)
    try:
        lines = read_lines(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 3
        got = number_text_lines(lines).collect()
        own = number_text_lines(lines, "line", per_file=True).collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert sorted((r["index"], r.value) for r in got) == list(enumerate(sum(files.values(), [])))
    assert sorted((r.file.rsplit("/", 1)[1], r.line, r.value) for r in own) == [
        (name, i, row) for name, rows in files.items() for i, row in enumerate(rows)]


def test_word_totals_and_last_words(spark):
    lines = spark.createDataFrame([("Zounds, zounds!  a",), ("",)], "value string")
    totals = plans.word_totals(plans.cleaned_lines(lines)).first()
    assert (totals.pieces, totals.words) == (5, 3)
    assert [r.word for r in plans.last_words(lines, 2).orderBy("rank").collect()] == [
        "zounds", "zounds"]
    assert [(r.word, r.n) for r in plans.top_words(lines, 1).collect()] == [("zounds", 2)]


def test_grouped_values_repeat_and_drop_nulls(spark):
    rows = [("a", 1, 5), ("a", 1, 3), ("a", 1, 5), ("a", 2, None), ("a", 2, 7), ("b", 1, None),
            (None, None, 4), (None, None, 4)]
    df = spark.createDataFrame(rows, "word string, doc_id int, v int")
    grouped = counting.grouped_values(df, "word", "v", within="doc_id").collect()
    assert {(r.word, r.doc_id): r["values"] for r in grouped} == {
        ("a", 1): [3, 5, 5], ("a", 2): [7], ("b", 1): [], (None, None): [4, 4]}


def test_words_grouped_shuffles_texts_and_no_words(spark, tmp_path):
    rows = [(1, "b a b\nB!"), (2, "a"), (2, "a c"), (3, None), (None, "c c")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(
        f"{tmp_path}/documents.parquet")
    df = QUERIES["words_grouped"](spark, str(tmp_path))
    assert {tuple(r) for r in df.collect()} == {
        ("b", 1, "1,1,1"), ("a", 1, "1"), ("a", 2, "1,1"), ("c", 2, "1"), ("c", None, "1,1")}
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange ") == 1
