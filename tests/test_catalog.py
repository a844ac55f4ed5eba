"""Named queries against their SQL equivalents, and the shape of their plans."""

import duckdb
import pytest

from tabkit.catalog import QUERIES, SQL
from tests.conftest import SMALL
from tools.check_queries import TABLES, ordered


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    cursor = duck.execute(SQL[name])
    want = ordered([d[0] for d in cursor.description], cursor.fetchall())
    assert ordered(df.columns, [tuple(r) for r in df.collect()]) == want


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["filter_class_subset", "stat_group_mean", "sql_guarded", "join_left"])
def test_scans_are_pruned(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    assert "l_shipdate" not in plan and "l_comment" not in plan


def test_filters_reach_the_scan(spark):
    assert "EqualTo(l_returnflag,R)" in plan_of(QUERIES["filter_class_subset"](spark, SMALL))


@pytest.mark.parametrize("name", sorted(n for n in SQL if n.startswith(("stat_", "met_", "viz_", "fe_", "agg_", "fn_"))))
def test_no_python_in_sql_expressible_queries(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan and "InPandas" not in plan


def test_entry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() == 11
