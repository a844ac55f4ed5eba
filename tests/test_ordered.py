"""The range-partitioned plans must give what the one-window plans give."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabkit.plans.ordered import dense_codes, digest_cuts, quantiles_long, row_digest, row_index, running_totals
from tabkit.plans.sizing import is_small, lookup_side
from tests.conftest import rows_of


@pytest.fixture(scope="module")
def skewed(spark):
    """One key and one value hold a third of all rows each; some values are missing."""
    rng = np.random.default_rng(1)
    rows = []
    for i in range(600):
        key = "hot" if i % 3 == 0 else f"k{rng.integers(0, 9)}"
        value = 7.0 if i % 3 == 1 else None if i % 50 == 0 else float(np.round(rng.normal(), 2))
        rows.append((key, value, int(rng.integers(0, 5))))
    return spark.createDataFrame(rows, "k string, v double, w int")


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("keys", [[], ["k"]])
def test_running_totals_agree(skewed, keys, descending):
    measures = {"n": ("sum", F.lit(1)), "lo": ("min", F.col("w")), "hi": ("max", F.col("w"))}
    whole = running_totals(skewed, "v", measures, keys, descending)
    for count in (1, 5, 13):
        ranged = running_totals(skewed, "v", measures, keys, descending, partitions=count)
        assert rows_of(ranged, *whole.columns) == rows_of(whole)


def test_running_totals_hand_checked(spark):
    df = spark.createDataFrame([(1, 10), (2, 5), (2, 1), (4, 2)], "v int, w int")
    got = rows_of(running_totals(df, "v", {"s": ("sum", F.col("w"))}, partitions=3))
    assert got == [(1, 10, 10, 18), (2, 6, 16, 18), (4, 2, 18, 18)]


@pytest.mark.parametrize("partitions", [None, 1, 6])
def test_quantiles(skewed, partitions):
    wanted = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    got = quantiles_long(skewed, ["v", "w"], wanted, ["k"], partitions)
    data = skewed.toPandas()
    for r in got.collect():
        values = data.loc[data["k"] == r["k"], r["column"]].dropna()
        for name, p in wanted.items():
            assert r[name] == pytest.approx(np.quantile(values, p))
    assert got.count() == 2 * data["k"].nunique()


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None, 1.0)], "a double, b double")
    for partitions in (None, 2):
        got = dict(quantiles_long(df, ["a", "b"], {"m": 0.5}, partitions=partitions).collect())
        assert got == {"a": None, "b": 1.0}


def test_dense_codes(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",), ("c",)], "s string")
    for partitions in (None, 3):
        assert rows_of(dense_codes(df, "s", partitions=partitions)) == [("a", 0), ("b", 1), ("c", 2)]


def test_row_index_is_dense_and_keeps_copies(spark):
    df = spark.createDataFrame([(1, "x")] * 40 + [(i, "y") for i in range(60)], "a int, b string")
    for partitions in (None, 4):
        indexed = row_index(df, ["a"], partitions=partitions)
        got = indexed.collect()
        assert sorted(r["row_index"] for r in got) == list(range(100))
        assert rows_of(indexed, "a", "b") == rows_of(df)


@pytest.mark.parametrize("share", [0.0, 0.1, 0.5, 1.0])
def test_digest_cuts(spark, share):
    df = spark.range(1000).withColumn("k", F.col("id") % 3)
    tagged = df.withColumn("d", row_digest(df, 3, ["id"]))
    cuts = {r["k"]: r["cut"] for r in digest_cuts(tagged, "d", F.ceil(F.col("n") * share), ["k"]).collect()}
    for k in range(3):
        digests = sorted(r["d"] for r in tagged.filter(F.col("k") == k).collect())
        want = math.ceil(len(digests) * share)
        assert (cuts.get(k) or "") == (digests[want - 1] if want else "")


def test_lookup_side_checks_its_size(spark):
    assert "Broadcast" in spark.range(50).join(lookup_side(spark.range(5)), "id")._jdf.queryExecution().toString()
    big = spark.range(100)
    assert lookup_side(big, max_rows=10) is big


def test_size_limit_is_configurable(spark):
    df = spark.range(100_000)
    assert is_small(df)
    spark.conf.set("spark.tabkit.smallBytes", "10")
    try:
        assert not is_small(df)
        assert rows_of(quantiles_long(df, ["id"], {"m": 0.5})) == [("id", 49999.5)]
    finally:
        spark.conf.unset("spark.tabkit.smallBytes")


def test_bracketed_quantiles_and_their_fallback(spark, monkeypatch):
    from tabkit.plans import ordered

    rng = np.random.default_rng(12)
    rows = [("hot" if i % 3 else f"k{i % 7}", float(rng.normal()), 1.0 if i % 2 else float(i)) for i in range(3000)]
    df = spark.createDataFrame(rows + [("empty", None, None)], "k string, v double, w double")
    wanted = {"lo": 0.01, "mid": 0.5, "hi": 0.999}
    data = df.toPandas()

    def check(got):
        for r in got.collect():
            values = data.loc[data["k"] == r["k"], r["column"]].dropna()
            for name, p in wanted.items():
                want = np.quantile(values, p) if len(values) else None
                assert r[name] == (pytest.approx(want) if want is not None else None)

    picked = df.select("k", "v", "w")
    found = ordered._bracketed_quantiles(picked, ["v", "w"], wanted, ["k"])
    assert found is not None and found.count() == 2 * data["k"].nunique()
    check(found)
    monkeypatch.setattr(ordered, "MAX_BROADCAST_ROWS", 2)
    assert ordered._bracketed_quantiles(picked, ["v", "w"], wanted, ["k"]) is None
    check(quantiles_long(df, ["v", "w"], wanted, ["k"]))
