import datetime
import math
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from larkspur.functions import numbers, text, vectors

STOP = ["a", "the", "why", "being", "at", "over"]


def column_of(spark, values, schema, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {schema}")
    return [r.x for r in rows.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()]


def test_plural(spark):
    words = ["cat", "elephant", "rat", "rat", "cat"]
    assert column_of(spark, words, "string", text.pluralise) == [w + "s" for w in words]
    lengths = column_of(spark, words, "string", lambda v: F.length(text.pluralise(v)))
    assert lengths == [4, 9, 4, 4, 4]


def test_clean_text(spark):
    given_texts = [" The Elephant's 4 cats. ", "\t a+b \x0c", "' x '", "five fav",
                   " café　", ""]
    expected = ["the elephants 4 cats", "a+b", " x ", "five fav", "caf", ""]
    assert column_of(spark, given_texts, "string", text.clean_text) == expected


def test_split_keeps_empty_pieces(spark):
    assert column_of(spark, ["", " a  b "], "string", text.split_on_blank) == [
        [""], ["", "a", "", "b", ""]]


def test_tokens(spark):
    given_texts = ["A quick brown fox jumps over the lazy dog.", " ",
                   "!!!!123A/456_B/789C.123A", "fox fox", "naïve"]
    assert column_of(spark, given_texts, "string", text.tokens) == [
        "a quick brown fox jumps over the lazy dog".split(), [],
        ["123a", "456_b", "789c", "123a"], ["fox", "fox"], ["na", "ve"]]


def test_tokens_without_stopwords(spark):
    given_texts = ["Why a the?", "Being at the_?",
                   "A quick brown fox jumps over the lazy dog.", "fox fox"]
    assert column_of(spark, given_texts, "string", lambda v: text.tokens_without(v, STOP)) == [
        [], ["the_"], "quick brown fox jumps lazy dog".split(), ["fox", "fox"]]


ASCII_TEXT = st.lists(st.text(st.characters(max_codepoint=126, exclude_characters="\x00"),
                              max_size=40), min_size=1, max_size=30)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(ASCII_TEXT)
def test_text_functions_follow_their_rule(spark, texts):
    cleaned = [re.sub(r"[^A-Za-z0-9\s+]", "", t.strip().lower(), flags=re.A) for t in texts]
    assert column_of(spark, texts, "string", text.clean_text) == cleaned
    tokens = [[w for w in re.split(r"\W+", t.lower(), flags=re.A) if w] for t in texts]
    assert column_of(spark, texts, "string", text.tokens) == tokens


def test_quotes_lines_and_sort_keys(spark):
    assert column_of(spark, ['"b0"x"'], "string", text.remove_quotes) == ["b0x"]
    assert column_of(spark, ["hello"], "string",
                     lambda v: text.numbered_line(F.lit(3), v)) == ["3: hello"]
    assert column_of(spark, ["alpha"], "string",
                     lambda v: text.text_sort_key(F.lit(2), v)) == ["2 alpha"]
    assert column_of(spark, [12], "int", text.sha1_of) == [
        "7b52009b64fd0a2a49e6d8a939753077792b0554"]


def test_float_text_has_twelve_digits(spark):
    values = [4.145015105740181, 10.0, 0.5, 123.456, 1 / 3]
    assert column_of(spark, values, "double", text.float_text) == [
        "4.14501510574", "10.0", "0.5", "123.456", "0.333333333333"]


def test_numbers(spark):
    assert column_of(spark, [1, 49], "bigint", numbers.log_of_square) == [
        0.0, math.log(49 ** 2)]
    assert column_of(spark, [6.9, 7.0, 90.25], "double", numbers.percent_label) == [
        "", "7.0", "90.25"]
    assert column_of(spark, [2, 0], "bigint",
                     lambda v: numbers.whole_ratio(F.lit(7), v)) == [3, None]


def test_log_time(spark):
    values = ["01/Aug/1995:00:00:01 -0400", "31/Dec/2024:23:59:59", "32/Dec/2024:00:00:00",
              "01/aug/1995:00:00:01", "01/anF/1995:00:00:01", "nothing"]
    assert column_of(spark, values, "string", numbers.log_time) == [
        datetime.datetime(1995, 8, 1, 0, 0, 1), datetime.datetime(2024, 12, 31, 23, 59, 59),
        None, None, None, None]


def test_log_time_does_not_follow_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        # This hour does not exist in that zone.
        assert column_of(spark, ["31/Mar/2024:02:30:00"], "string", numbers.log_time) == [
            datetime.datetime(2024, 3, 31, 2, 30)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_map_vectors(spark):
    rows = [({"foo": 2., "bar": 3., "baz": 5.}, {"foo": 1., "bar": 0., "baz": 20.}),
            ({"x": 1.}, {"y": 1.}), ({"x": 1.}, {})]
    df = spark.createDataFrame(rows, "a map<string,double>, b map<string,double>")
    a, b = F.col("a"), F.col("b")
    got = [tuple(r) for r in df.select(vectors.dot_product(a, b), vectors.norm(a),
                                       vectors.cosine(a, b)).collect()]
    assert got[0] == (102.0, math.sqrt(38), 102 / (math.sqrt(38) * math.sqrt(401)))
    assert got[1] == (0.0, 1.0, 0.0) and got[2] == (0.0, 1.0, None)


def test_cleaning_pattern_lists_what_it_keeps(spark):
    every = [chr(c) for c in range(0x3100) if not 0xd800 <= c < 0xe000] + ["\U0001f600", "￿"]
    pattern = re.compile(r"[^A-Za-z0-9\s+]", re.ASCII)
    kept = [c for c in every if not pattern.match(c)]
    df = spark.createDataFrame([("".join(every),)], "t string")
    cleaned = F.regexp_replace("t", text.NOT_KEPT_WHEN_CLEANING, "")
    assert df.select(cleaned).first()[0] == "".join(kept)
    # A class of ranges is looked up far more slowly.
    assert "-" not in text.NOT_KEPT_WHEN_CLEANING
