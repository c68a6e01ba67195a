"""Every query of the core registry on the smallest tables, against its SQL where it has one."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from check_queries import TABLES, normal
from larkspur.plans.oracle import SQL
from larkspur.plans.registry import QUERIES

# Factor models have no SQL counterpart.
WITHOUT_SQL = {"als_rank_selection", "als_test_rmse", "new_user_test_rmse",
               "new_user_recommendations"}


@pytest.fixture(scope="module")
def database(smallest_tables):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM '{smallest_tables}/{table}.parquet'")
    return connection


def test_every_query_has_sql_but_the_factor_models():
    assert QUERIES.keys() - SQL.keys() == WITHOUT_SQL
    assert SQL.keys() <= QUERIES.keys()
    assert QUERIES.items() <= entry_points.queries().items()
    assert SQL.items() <= entry_points.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, database, smallest_tables, name):
    df = QUERIES[name](spark, smallest_tables)
    result = database.execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert normal(df.columns, df.collect()) == normal(columns, result.fetchall())


@pytest.mark.parametrize("name", sorted(WITHOUT_SQL))
def test_factor_model_query_runs(spark, smallest_tables, name):
    assert QUERIES[name](spark, smallest_tables).count() > 0


def test_entry(spark, smallest_tables):
    assert entry_points.entry(spark).count() == 15
