from larkspur import session
from larkspur.plans.registry import QUERIES
from larkspur.session import frames_released, release, stored


def held(spark):
    return spark._jsparkSession.sharedState().cacheManager().numCachedEntries()


def test_a_scope_releases_what_was_kept_in_it(spark, monkeypatch):
    monkeypatch.setattr(session, "shared_folder", lambda _: None)
    before = held(spark)
    with frames_released() as outer:
        first = stored(spark.range(10))
        first.count()
        with frames_released() as inner:
            second = stored(first.selectExpr("id * 2 AS id"))
            assert second.count() == 10 and inner == [second]
        assert outer == [first] and held(spark) == before + 1
        release(first)
        assert outer == [] and held(spark) == before
        assert first.count() == 10
    assert held(spark) == before


def test_tables_of_a_scope_are_deleted_even_after_an_error(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_folder", lambda _: str(tmp_path))
    try:
        with frames_released():
            assert stored(spark.range(10)).count() == 10
            assert len(list(tmp_path.iterdir())) == 1
            raise KeyError
    except KeyError:
        pass
    assert list(tmp_path.iterdir()) == []


def test_matching_and_rating_queries_leave_no_frames(spark, smallest_tables, tmp_path, monkeypatch):
    before = held(spark)
    monkeypatch.setattr(session, "shared_folder", lambda _: str(tmp_path))
    for name in ("inverted_similarity", "quality_curve", "mean_baseline_rmse"):
        with frames_released() as kept:
            assert QUERIES[name](spark, smallest_tables).count() and kept
        assert held(spark) == before and list(tmp_path.iterdir()) == [], name
