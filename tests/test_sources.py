import datetime
import gzip

import pytest
from pyspark.sql import functions as F

from larkspur.sources import datasets, lines as source
from larkspur.sources.ratings import parse_movie_lines, parse_rating_lines
from larkspur.sources.records import FAILED, parse_match_lines, parse_product_lines
from larkspur.sources.weblog import parse_log_lines

PREFIX = "h.com - - [01/Aug/1995:00:00:01 -0400] "


def as_lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


@pytest.mark.parametrize("tail, endpoint, protocol, code, size", [
    ('"GET /foo HTTP/1.0" 200 12', "/foo", "HTTP/1.0", 200, 12),
    ('"GET /foo" 200 -', "/foo", None, 200, 0),
    ('"GET /foo " 404 7', "/foo", None, 404, 7),
    ('"GET / " 200 5', "/", None, 200, 5),
    ('"GET /a b c HTTP/1.0" 200 1', "/a", "HTTP/1.0", 200, 1),
    ('"GET  /x HTTP/1.0" 200 1', "/x", "HTTP/1.0", 200, 1),
    ('"GET /a"b HTTP/1.0" 200 1', '/a"b', "HTTP/1.0", 200, 1),
    ('"GET " 200 1', "", None, 200, 1),
    ('"GET /a' + " b" * 20_000 + ' HTTP/1.0" 200 1', "/a", "HTTP/1.0", 200, 1),
    ('"GET /x HTTP/1.0" 200 1 and $1 \\ more', "/x", "HTTP/1.0", 200, 1),
])
def test_log_line(spark, tail, endpoint, protocol, code, size):
    row = source.accepted(parse_log_lines(as_lines(spark, [PREFIX + tail]))).first()
    assert row.asDict() == {
        "host": "h.com", "client_identd": "-", "user_id": "-",
        "date_time": datetime.datetime(1995, 8, 1, 0, 0, 1), "method": "GET",
        "endpoint": endpoint, "protocol": protocol, "response_code": code, "content_size": size}


def test_log_rejects(spark):
    bad = [PREFIX + '"GET /a' + " b" * 100_000 + " HTTP/1.0 200 1",
           PREFIX + '"GET /x HTTP/1.0" 200 many',
           'h.com - - [40/Aug/1995:00:00:01 -0400] "GET /x HTTP/1.0" 200 1', "", "\n" * 7]
    parsed = parse_log_lines(as_lines(spark, bad + [PREFIX + '"GET /x HTTP/1.0" 200 1']))
    counts = source.ingest_counts(parsed, failed_status=0).first()
    assert (counts.lines_read, counts.lines_parsed, counts.lines_failed) == (6, 1, 5)
    assert sorted(r.value for r in source.rejected(parsed, 0).collect()) == sorted(bad)
    assert source.rejected_sample(parsed, 0, 2).count() == 2
    with pytest.raises(ValueError):
        source.check_ingest(parsed, 0)


def test_strict_form_needs_a_protocol_field(spark):
    parsed = parse_log_lines(as_lines(spark, [
        PREFIX + '"GET /foo" 200 1', PREFIX + '"GET /foo HTTP/1.0" 200 1',
        PREFIX + '"GET /foo " 200 1']), strict=True)
    rows = source.accepted(parsed).orderBy(F.asc_nulls_first("protocol")).collect()
    assert [(r.endpoint, r.protocol) for r in rows] == [("/foo", None), ("/foo", "HTTP/1.0")]
    assert source.rejected(parsed, 0).count() == 1


def test_product_lines(spark):
    parsed = parse_product_lines(as_lines(spark, [
        '"id","title",description,manufacturer,price',
        '"b1","a title, with comma",some "text","maker",9.99',
        "b2,\"t\",,,", "no product"]))
    rows = {r.id: r.product for r in source.accepted(parsed).collect()}
    assert rows == {"b1": 'a title, with comma some "text" "maker"', "b2": "t  "}
    counts = source.ingest_counts(parsed, FAILED).first()
    assert tuple(counts) == (4, 2, 1, 1)


def test_match_lines(spark):
    parsed = parse_match_lines(as_lines(spark, [
        '"idAmazon","idGoogleBase"', '"b1","http://x/1,2"', "nothing"]))
    assert [tuple(r) for r in source.accepted(parsed).collect()] == [("b1,http://x/1", "2")]
    assert tuple(source.ingest_counts(parsed, FAILED).first()) == (3, 1, 1, 1)


def test_check_ingest_with_header(spark):
    parsed = parse_match_lines(as_lines(spark, ['"idAmazon","idGoogleBase"', "a,b"]))
    assert source.check_ingest(parsed, FAILED, headers=1).count() == 1
    with pytest.raises(ValueError):
        source.check_ingest(parsed, FAILED, headers=0)


def test_rating_and_movie_files(spark, tmp_path):
    with gzip.open(tmp_path / "ratings.dat.gz", "wt") as f:
        f.write("1::10::4::978300760\n2::10::3.5::1\nbroken\n1::x::4::1\n")
    (tmp_path / "movies.dat").write_text("10::Toy Story (1995)::Comedy\n11\n")
    lines = source.read_lines(spark, str(tmp_path / "ratings.dat.gz"), 2)
    assert lines.rdd.getNumPartitions() == 2
    rated = parse_rating_lines(lines)
    assert sorted(tuple(r) for r in source.accepted(rated).collect()) == [
        (1, 10, 4.0), (2, 10, 3.5)]
    assert source.rejected(rated, 0).count() == 2
    movies = source.accepted(parse_movie_lines(
        source.read_lines(spark, str(tmp_path / "movies.dat"))))
    assert [tuple(r) for r in movies.collect()] == [(10, "Toy Story (1995)")]


def test_named_datasets(spark, tmp_path):
    (tmp_path / "log").write_text(PREFIX + '"GET /x HTTP/1.0" 200 1\nbroken\n')
    (tmp_path / "products.csv").write_text(
        '"id","title",description,manufacturer,price\n"b1","t",d,m,1\n')
    (tmp_path / "matches.csv").write_text('"idAmazon","idGoogleBase"\n"b1","u1"\n')
    (tmp_path / "movies.dat").write_text("1::Heat (1995)::Action\n")
    with gzip.open(tmp_path / "ratings.gz", "wt") as f:
        f.write("1::1::5::0\n")
    log = datasets.load_log(spark, str(tmp_path / "log"))
    assert source.accepted(log).count() == 1 and source.rejected(log, 0).first().value == "broken"
    assert tuple(datasets.load_products(spark, str(tmp_path / "products.csv")).first()) == (
        "b1", "t d m")
    assert tuple(datasets.load_matches(spark, str(tmp_path / "matches.csv")).first()) == (
        "b1", "u1")
    assert tuple(datasets.load_ratings(spark, str(tmp_path / "ratings.gz"), 2).first()) == (
        1, 1, 5.0)
    assert datasets.load_movies(spark, str(tmp_path / "movies.dat")).first().title == "Heat (1995)"
    with pytest.raises(ValueError):
        datasets.load_matches(spark, str(tmp_path / "log"))


def test_word_list_range_and_literals(spark, tmp_path):
    (tmp_path / "stop.txt").write_text("a\nthe\na\n")
    assert sorted(r.word for r in source.read_words(spark, str(tmp_path / "stop.txt")).collect()
                  ) == ["a", "the"]
    numbers = source.number_range(spark, 100_000)
    assert numbers.agg(F.sum("id")).first()[0] == 4_999_950_000
    assert numbers.filter("id % 7 = 0").agg(F.sum("id")).first()[0] == 714_264_285
    words = source.literal_rows(spark, [("cat",), ("rat",)], "word string", 4)
    assert words.count() == 2 and words.rdd.getNumPartitions() == 4


def test_one_match_per_line(spark):
    """Later filters must not run the pattern again."""
    parsed = source.accepted(parse_log_lines(as_lines(spark, ["x"]))).filter("response_code = 404")
    plan = parsed.groupBy("endpoint").count()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_replace(") == 1
