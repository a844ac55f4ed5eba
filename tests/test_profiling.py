import pytest
from pyspark.sql import functions as F

from tabkit.operators import profiling


def kinds(df, order_by=None):
    return {r["name"]: r["column_type"] for r in profiling.column_types(df, order_by).collect()}


def test_trip_types(trips):
    assert kinds(trips, ["trip"]) == {
        "trip": "text",
        "pier": "categorical",
        "wait": "numeric",
        "fare": "numeric",
        "day": "datetime",
        "late": "categorical",
    }


def test_numeric_threshold(spark):
    df = spark.range(1000).select((F.col("id") % 20).alias("twenty"), (F.col("id") % 21).alias("more"))
    assert kinds(df) == {"twenty": "categorical", "more": "numeric"}
    few = spark.range(100).select((F.col("id") % 6).alias("six"))
    assert kinds(few) == {"six": "numeric"}


def test_only_the_first_fifty_values_decide_on_dates(spark):
    rows = [(i, f"2024-01-{i % 28 + 1:02d}", None if i < 300 else "2024/05/06") for i in range(400)]
    rows[60] = (60, "not a date", None)
    df = spark.createDataFrame(rows, "i int, early string, sparse string")
    got = kinds(df, ["i"])
    assert got["early"] == "datetime" and got["sparse"] == "datetime"
    rows[10] = (10, "2023", None)
    assert kinds(spark.createDataFrame(rows, df.schema), ["i"])["early"] == "categorical"


def test_sparse_columns_are_searched_in_the_whole_table(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") > 990, F.col("id").cast("string")).alias("late"))
    got = {r["column"]: r["sample_values"] for r in profiling.sample_values(df, 3, ["id"]).collect()}
    assert got == {"id": ["0", "1", "2"], "late": ["991", "992", "993"]}


def test_profile_columns(trips):
    profile = {r["name"]: r for r in profiling.profile_columns(trips, ["trip"]).collect()}
    charges = profile["fare"]
    assert charges["missing_count"] == 4 and charges["missing_pct"] == 2.65
    assert set(charges["numeric_summary"]) == {"mean", "std", "min", "p25", "median", "p75", "max"}
    assert sum(profile["pier"]["top_categories"].values()) == 151
    assert profile["trip"]["sample_values"] == ["T0000", "T0000", "T0001"]
    assert profile["trip"]["numeric_summary"] is None


def test_profile_dataset_and_text(trips):
    row = profiling.profile_dataset(trips, ["trip"]).first()
    assert (row["n_rows"], row["n_columns"], row["duplicate_row_count"]) == (151, 6, 1)
    assert row["possible_target_columns"] == ["pier", "late"]
    text = profiling.profile_text(trips, ["trip"]).first()["summary"]
    assert "151 rows, 6 columns, 1 duplicate rows" in text and "fare (2.65%)" in text


@pytest.mark.parametrize("name,hit", [("is_fraud", True), ("Class", True), ("classes", False), ("amount", False)])
def test_target_names(spark, name, hit):
    df = spark.range(100).select((F.col("id") * 1.5).alias(name))
    assert (profiling.possible_targets(df).count() == 1) is hit


def test_boolean_and_empty(spark):
    df = spark.createDataFrame([(True, None)], "b boolean, s string")
    assert kinds(df) == {"b": "boolean", "s": "categorical"}
    assert kinds(df.limit(0)) == {"b": "boolean", "s": "categorical"}
