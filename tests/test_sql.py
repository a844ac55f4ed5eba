import pytest

from tabkit.errors import SQLValidationError
from tabkit.operators.sqltool import run_sql


@pytest.mark.parametrize(
    "query",
    [
        "SELECT count(*) AS n FROM dataset",
        "with x as (select pier from dataset) select pier, count(*) from x group by pier;",
        "SELECT 'please drop; or update' AS note, wait AS `load` FROM dataset",
        "SELECT * FROM dataset WHERE wait = (SELECT max(wait) FROM dataset)",
        "SELECT pier, late, count(*) FROM dataset GROUP BY CUBE (pier, late)",
        "SELECT a.wait FROM dataset a JOIN dataset b ON a.trip = b.trip",
    ],
)
def test_accepted(trips, query):
    assert run_sql(trips, query).rows.count() > 0


@pytest.mark.parametrize(
    "query",
    [
        "",
        "  ;",
        "DROP TABLE dataset",
        "SELECT 1; SELECT 2",
        "WITH x AS (SELECT 1) INSERT INTO dataset SELECT 1",
        "EXPLAIN SELECT * FROM dataset",
        "SELECT * FROM other_table",
        "SELECT nothing FROM dataset",
        "SELECT * FROM parquet.`/root/testdata/sf0.001/region.parquet`",
        "SELECT (SELECT max(wait) FROM secret) FROM dataset",
        "SELECT java_method('java.lang.System', 'getProperty', 'user.home') FROM dataset",
        "SELECT * FROM global_temp.leak",
        "SELECT FROM WHERE",
    ],
)
def test_rejected(spark, trips, query):
    spark.range(1).createOrReplaceTempView("secret")
    with pytest.raises(SQLValidationError):
        run_sql(trips, query).rows.collect()


def test_catalog_tables_are_out_of_reach(spark, trips, tmp_path):
    spark.sql(f"CREATE TABLE IF NOT EXISTS kept_apart USING parquet LOCATION '{tmp_path}/t' AS SELECT 1 AS a")
    try:
        for query in (
            "SELECT * FROM kept_apart",
            "SELECT * FROM dataset WHERE wait IN (SELECT a FROM kept_apart)",
            "SELECT (SELECT max(a) FROM default.kept_apart) AS a FROM dataset",
        ):
            with pytest.raises(SQLValidationError):
                run_sql(trips, query)
    finally:
        spark.sql("DROP TABLE kept_apart")


@pytest.mark.parametrize("n,truncated", [(500, False), (501, True)])
def test_row_cap(spark, n, truncated):
    result = run_sql(spark.range(n), "SELECT id FROM dataset")
    assert result.rows.count() == 500 and tuple(result.summary().first()) == (500, truncated)
