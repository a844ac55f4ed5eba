import numpy as np
import pytest
from pyspark.sql import functions as F

from tabkit import errors
from tabkit.operators import charts, stats
from tests.conftest import rows_of


def test_describe_numeric(spark, trips):
    r = stats.describe_column(trips, "fare").first()
    values = trips.toPandas()["fare"].dropna()
    assert (r["count"], r["missing"], r["error"]) == (147, 4, None)
    assert r["mean"] == pytest.approx(values.mean(), abs=1e-4)
    assert r["std"] == pytest.approx(values.std(), abs=1e-4)
    assert r["q75"] == pytest.approx(values.quantile(0.75), abs=1e-4)


def test_describe_edge_cases(spark):
    one = stats.describe_column(spark.createDataFrame([(2.5,)], "a double"), "a").first()
    assert one["std"] == 0.0 and one["median"] == 2.5
    none = stats.describe_column(spark.createDataFrame([(None,)], "a double"), "a").first()
    assert none["error"] and none["count"] == 0 and none["mean"] is None
    flags = stats.describe_column(spark.createDataFrame([(True,), (True,), (False,)], "a boolean"), "a").collect()
    assert [(r["value"], r["count"]) for r in flags] == [("true", 2), ("false", 1)]
    with pytest.raises(errors.InvalidArgumentsError):
        stats.describe_column(spark.range(1), "b")


def test_group_rates_sum_to_hundred(trips):
    out = stats.group_statistics(trips, "pier", "late").toPandas()
    assert np.allclose(out.groupby("pier")["pct"].sum(), 100, atol=0.02)
    yes = out[out["late"] == "Yes"].set_index("pier")["pct"]
    assert yes["East"] > yes["North"]
    sparse = stats.group_rates(trips, "pier", "late", dense=False)
    assert sparse.filter("n = 0").count() == 0


def test_group_aggregates(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0), (None, 1.0), ("b", None)], "g string, v double")
    assert rows_of(stats.group_statistics(df, "g", "v", "median")) == [("a", 2.0, 2), ("b", 5.0, 1)]
    assert rows_of(stats.group_statistics(df, "g", "v", "std")) == [("a", 1.4142, 2), ("b", None, 1)]
    with pytest.raises(errors.InvalidArgumentsError):
        stats.group_statistics(df, "g", "v", "variance")


def test_correlations(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, None, 5.0), (4.0, 7.0, 5.0)], "a double, b double, c double")
    got = {(r["column_1"], r["column_2"]): r["r"] for r in stats.correlation_matrix(df).collect()}
    assert got["a", "b"] == got["b", "a"] == pytest.approx(np.corrcoef([1, 2, 4], [2, 4, 7])[0, 1], abs=1e-4)
    assert got["a", "c"] is None and got["c", "c"] == 1.0
    with pytest.raises(errors.InsufficientDataError):
        stats.correlation_matrix(df.select("a"))


def test_variance_inflation(spark):
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=300), rng.normal(size=300)
    c = a + b + rng.normal(scale=0.5, size=300)
    df = spark.createDataFrame([(float(x), float(y), float(z)) for x, y, z in zip(a, b, c)], "a double, b double, c double")
    got = {r["feature"]: r["vif"] for r in stats.variance_inflation(df, ["a", "b", "c"]).collect()}
    want = np.diag(np.linalg.inv(np.corrcoef([a, b, c])))
    assert got == pytest.approx(dict(zip("abc", want)), abs=1e-3)


def test_histogram_counts_every_row_once(trips):
    out = charts.histogram(trips, "wait", "pier", bins=7).toPandas()
    assert out["n"].sum() == 151 and out["bin"].between(0, 6).all()
    flat = charts.histogram(trips.withColumn("one", F.lit(1)), "one").collect()
    assert [(r["bin"], r["n"]) for r in flat] == [(0, 151)]


def test_box_and_bar(trips):
    data = trips.toPandas()
    for r in charts.box(trips, "wait", "pier").collect():
        part = data.loc[data["pier"] == r["pier"], "wait"]
        assert r["n"] == len(part) and r["median"] == part.median()
    assert charts.box(trips, "wait").first()["n"] == 151
    counts = [r["count"] for r in charts.bar(trips, "pier").collect()]
    assert counts == sorted(counts, reverse=True)
    with pytest.raises(errors.InvalidArgumentsError):
        charts.bar(trips, "pier", "wait", "mode")


def test_points_and_cells_are_different_charts(trips):
    points = charts.scatter(trips, "wait", "fare")
    assert points.columns == ["wait", "fare"] and points.count() == 147
    assert charts.scatter_grid(trips, "wait", "fare").agg(F.sum("n")).first()[0] == 147
    line = charts.line_buckets(trips, "wait", "fare", buckets=5)
    assert line.agg(F.sum("n")).first()[0] == 151 and line.count() <= 5
    xs = [r["x"] for r in charts.line(trips, "wait", "fare").collect()]
    assert xs == sorted(xs) and len(xs) == 151


@pytest.mark.parametrize("rows", [100, 6000])
def test_a_chart_has_one_schema_at_every_size(spark, rows):
    df = spark.range(rows).select(
        "id", F.expr("date_add(DATE'2024-01-01', CAST(id % 300 AS INT))").alias("day"), F.col("id").cast("string").alias("name")
    )
    assert charts.scatter(df, "day", "id").count() == rows
    assert charts.line(df, "name", "id").columns == ["x", "y"]
    assert charts.line(df, "day", "id").count() == rows
    assert charts.line_buckets(df, "day", "id").columns == ["x", "x_last", "y", "n"]
    assert charts.scatter_grid(df, "day", "id").agg(F.sum("n")).first()[0] == rows
    with pytest.raises(errors.InvalidArgumentsError):
        charts.line_buckets(df, "name", "id")


def test_chart_dispatch(trips):
    assert charts.chart_data(trips, "category_comparison", category="pier", target="late").count() == 6
    with pytest.raises(errors.InvalidArgumentsError):
        charts.chart_data(trips, "pie", column="wait")
    with pytest.raises(errors.InvalidArgumentsError):
        charts.chart_data(trips, "histogram", column="nope")


def test_quartiles_of_a_null_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 2.0)], "g string, v double")
    got = {r["g"]: (r["q25"], r["median"], r["q75"]) for r in stats.numeric_summary(df, ["v"], ["g"]).collect()}
    assert got == {None: (1.5, 2.0, 2.5), "a": (2.0, 2.0, 2.0)}


def test_dense_rates_of_many_values(spark):
    df = spark.range(20_000).selectExpr("id % 2 AS g", "id AS t")
    dense = stats.group_rates(df, "g", "t")
    assert dense.count() == 40_000 and dense.agg({"n": "sum"}).first()[0] == 20_000
