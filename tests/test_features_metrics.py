import math
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabkit import errors
from tabkit.operators import features, metrics, relational
from tests.conftest import rows_of


def test_imputation(spark):
    df = spark.createDataFrame([(1.0, None, "x"), (None, None, None), (4.0, None, "y"), (9.0, None, "x")], "a double, b double, c string")
    got = rows_of(features.impute_category(features.impute_median(df, ["a", "b"]), ["c"]))
    assert got == sorted([(1.0, 0.0, "x"), (4.0, 0.0, "missing"), (4.0, 0.0, "y"), (9.0, 0.0, "x")], key=str)
    fitted = features.impute_median(df, ["a"], fit_on=df.filter("a > 2"))
    assert 6.5 in [r["a"] for r in fitted.collect()]


def test_encodings(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "s string")
    assert rows_of(features.label_encode(df, ["s"])) == [(0,), (1,), (1,), (None,)]
    assert features.one_hot(df, ["s"]).columns == ["s_a", "s_b"]
    houses = spark.createDataFrame([("Mixed-use",), ("Residential",)], "t string")
    assert features.one_hot(houses, ["t"], prefix="type").columns == ["type_mixed_use", "type_residential"]
    assert rows_of(df.select(features.ordinal("s", {"a": 1, "b": 2}))) == [(1,), (2,), (2,), (None,)]


def test_usable_features(spark, trips):
    assert "trip" not in features.usable_features(trips, "late")
    ids = trips.select("trip", "late")
    with pytest.raises(errors.InsufficientDataError):
        features.usable_features(ids, "late")


def test_problem_type(spark):
    df = spark.range(1000).select(
        (F.col("id") % 10).alias("ten"), (F.col("id") % 11).alias("eleven"), (F.col("id") > 5).alias("flag")
    )
    got = {c: features.problem_type(df, c).first()["problem_type"] for c in df.columns}
    assert got == {"ten": "classification", "eleven": "regression", "flag": "classification"}
    few = spark.range(100).select((F.col("id") % 5).alias("five"))
    assert features.problem_type(few, "five").first()["problem_type"] == "regression"


def test_standardize_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, c double")
    assert rows_of(features.standardize(df, ["a", "c"])) == [(-1.0, 0.0), (1.0, 0.0)]


def test_random_split_is_exact_stable_and_keeps_copies_together(spark):
    df = spark.range(1001).withColumn("y", F.when(F.col("id") % 10 == 0, "rare").otherwise("usual"))
    split = features.split_random(df, 0.25, 7, ["id"], stratify="y")
    sizes = {(r["y"], r["split"]): r["count"] for r in split.groupBy("y", "split").count().collect()}
    assert sizes["rare", "test"] == math.ceil(101 * 0.25) and sizes["usual", "test"] == math.ceil(900 * 0.25)
    again = features.split_random(df.repartition(9).withColumn("extra", F.lit(1)), 0.25, 7, ["id"], stratify="y")
    assert rows_of(again.drop("extra")) == rows_of(split)
    copies = spark.createDataFrame([("hot",)] * 500 + [(f"v{i}",) for i in range(500)], "v string")
    sides = features.split_random(copies, 0.3, 1).groupBy("v").agg(F.count_distinct("split").alias("n"))
    assert sides.filter("n > 1").count() == 0


@pytest.mark.parametrize("partitions", [None, 3])
def test_time_split(spark, partitions):
    day = datetime(2024, 1, 1)
    rows = [(i, day + timedelta(days=min(i // 10, 5))) for i in range(205)]
    df = spark.createDataFrame(rows, "id int, ts timestamp")
    split = features.split_time(df, "ts", 0.2, ["id"], partitions=partitions)
    train = split.filter("split = 'train'")
    assert train.count() == int(205 * 0.8)
    assert train.agg(F.max("ts")).first()[0] <= split.filter("split = 'test'").agg(F.min("ts")).first()[0]
    thirds = features.carve_validation(split, 0.15, key=["id"]).groupBy("split").count()
    assert {r["split"]: r["count"] for r in thirds.collect()} == {"train": 164 - 25, "validation": 25, "test": 41}


def test_vectors(spark):
    df = spark.createDataFrame([([1.0, 3.0, 2.0],)], "v array<double>")
    scaled = df.select(features.minmax_row(F.col("v"))).first()[0]
    assert scaled == pytest.approx([0, 1, 0.5], abs=1e-6)
    mean, std = F.array(*[F.lit(1.0)] * 3), F.array(*[F.lit(2.0)] * 3)
    assert df.select(features.normalize(F.col("v"), mean, std)).first()[0] == [0.0, 1.0, 0.5]
    back = df.select(features.denormalize(features.normalize(F.col("v"), mean, std), mean, std)).first()[0]
    assert back == [1.0, 1.0, 1.0]


# --- metrics against plain definitions --------------------------------------------------------


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(3)
    y = (rng.random(300) < 0.3).astype(int)
    s = np.round(y * 0.3 + rng.random(300), 1)
    return [int(v) for v in y], [float(v) for v in s], spark.createDataFrame(list(zip(map(int, y), map(float, s))), "y int, s double")


def plain_auc(y, s):
    pos = [b for a, b in zip(y, s) if a]
    neg = [b for a, b in zip(y, s) if not a]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def plain_curve(y, s):
    for t in sorted(set(s), reverse=True):
        tp = sum(1 for a, b in zip(y, s) if b >= t and a)
        fp = sum(1 for a, b in zip(y, s) if b >= t and not a)
        yield t, tp, fp


def test_ranking_metrics(scored):
    y, s, df = scored
    assert metrics.roc_auc(df, "y", "s").first()["roc_auc"] == pytest.approx(plain_auc(y, s), abs=1e-6)
    n, before, ap, best = sum(y), 0, 0.0, (0, 0)
    for t, tp, fp in plain_curve(y, s):
        ap += (tp - before) / n * tp / (tp + fp)
        before = tp
        best = max(best, (2 * tp / (tp + fp + n), -t))
    got = metrics.evaluate_best(df, "y", "s").first()
    assert got["pr_auc"] == pytest.approx(ap, abs=1e-6)
    assert (got["f1"], got["threshold"]) == (pytest.approx(best[0], abs=1e-6), -best[1])
    ranged = metrics.evaluate_best(df, "y", "s", partitions=4).first()
    assert tuple(ranged) == tuple(got)
    gains = [(tp / n - fp / (len(y) - n), t) for t, tp, fp in plain_curve(y, s)]
    assert metrics.youden(df, "y", "s").first()["threshold"] == max(gains)[1]


def test_ties_and_single_class(spark):
    # among equal F1 values the lowest threshold wins
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (0, 0.7), (1, 0.6)], "y int, s double")
    assert tuple(metrics.best_threshold(df, "y", "s").first()) == (0.6, pytest.approx(2 / 3, abs=1e-6))
    tied = spark.createDataFrame([(1, 0.9), (0, 0.1), (1, 0.1), (0, 0.05), (0, 0.9)], "y int, s double")
    assert metrics.youden(tied, "y", "s").first()["threshold"] == 0.1
    one = spark.createDataFrame([(0, 0.3), (0, 0.4)], "y int, s double")
    assert metrics.roc_auc(one, "y", "s").first()[0] == 0.5
    assert metrics.roc_auc(one, "y", "s", single_class=None).first()[0] is None
    assert metrics.youden(one, "y", "s").first()["threshold"] is None


def test_class_metrics(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "b")], "y string, p string")
    report = {r["class"]: r for r in metrics.class_report(df, "y", "p").collect()}
    assert report["c"]["precision"] == 0.0 and report["c"]["f1"] == 0.0 and report["c"]["support"] == 1
    assert report["b"]["precision"] == pytest.approx(1 / 3, abs=1e-6)
    assert report["macro avg"]["recall"] == pytest.approx((0.5 + 1 + 0) / 3, abs=1e-6)
    assert metrics.multiclass(df, "y", "p").first()["accuracy"] == 0.5
    none = spark.createDataFrame([(0, 0)], "y int, p int")
    got = metrics.confusion(none, "y", F.col("p")).first()
    assert (got["tn"], got["precision"], got["recall"], got["f1"]) == (1, 0.0, 0.0, 0.0)


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (3.0, 5.0)], "y double, p double")
    r = metrics.regression(df, "y", "p").first()
    assert (r["mae"], r["rmse"], r["r2"]) == (1.0, pytest.approx(math.sqrt(5 / 3), abs=1e-6), pytest.approx(1 - 5 / 2))


def test_element_auc_and_variants(spark):
    df = spark.createDataFrame([([0.1, 0.9], [0.0, 1.0]), ([0.2, 0.3], None), ([0.5, 0.4], [0.0, 0.6])], "s array<double>, m array<double>")
    assert metrics.element_auc(df, "s", "m").first()[0] == plain_auc([0, 1, 0, 1], [0.1, 0.9, 0.5, 0.4])
    p = spark.createDataFrame([("raw", 1, 0.9), ("raw", 0, 0.1), ("scaled", 1, 0.8), ("scaled", 0, 0.2)], "v string, y int, s double")
    assert tuple(metrics.pick_variant(p, "y", "s", "v", "raw").first()) == ("raw", 1.0)


def test_best_so_far(spark):
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate([5.0, 7.0, 3.0, 4.0])], "k string, i int, v double")
    for partitions in (None, 3):
        curve = relational.best_so_far(df, "i", "v", ["k"], partitions=partitions)
        assert [r["best_so_far"] for r in curve.orderBy("i").collect()] == [5.0, 5.0, 3.0, 3.0]


def test_wide_levels_become_a_sparse_vector(spark):
    df = spark.range(20_000).selectExpr("id", "concat('v', id) AS wide", "if(id % 2 = 0, 'even', null) AS few")
    got = {r["id"]: r["levels"] for r in features.one_hot_vector(df, ["wide", "few"]).where("id IN (0, 1, 19999)").collect()}
    order = sorted(f"v{i}" for i in range(20_000))
    assert all(v.size == 20_001 for v in got.values())
    assert list(got[0].indices) == [order.index("v0"), 20_000] and list(got[1].indices) == [order.index("v1")]
    unknown = features.one_hot_vector(df.limit(3), ["wide"], fit_on=df.where("id > 10")).select("levels").first()[0]
    assert unknown.size == 19_989 and len(unknown.indices) == 0


def test_codes_of_all_columns_at_once(spark):
    df = spark.createDataFrame([("b", 2, None), ("a", 10, "x"), (None, 2, "x")], "s string, n int, t string")
    assert rows_of(features.label_codes(df, ["s", "n", "t"])) == [("n", "10", 0), ("n", "2", 1), ("s", "a", 0), ("s", "b", 1), ("t", "x", 0)]
    assert rows_of(features.label_encode(df, ["s", "t"])) == [(0, 10, 0), (1, 2, None), (None, 2, 0)]
