import math

import pytest
from pyspark.sql import functions as F

from tabkit import errors
from tabkit.operators import charts, features, metrics, quality, relational, stats
from tabkit.operators.sqltool import run_sql
from tabkit.operators.toolbox import Toolbox
from tabkit.sources import tables as src

NAN = float("nan")


def write(path, text):
    path.write_text(text)
    return str(path)


def test_empty_pairs_keep_to_their_split(spark):
    images = spark.createDataFrame([(f"{s}/images/{n}.jpg",) for s in ("train", "valid") for n in "ab"], "path string")
    labels = [("train/labels/a.txt", 0), ("train/labels/b.txt", 9), ("valid/labels/a.txt", 7), ("valid/labels/b.txt", 0)]
    clean, removed = quality.drop_empty_pairs(images, spark.createDataFrame(labels, "path string, size long"))
    assert sorted(r.path for r in clean.collect()) == ["train/images/b.jpg", "valid/images/a.jpg"]
    assert removed.first()["removed"] == 2
    both = spark.createDataFrame([("train/labels/a.txt", 0), ("valid/labels/a.txt", 0)], "path string, size long")
    assert quality.drop_empty_pairs(images, both)[1].first()["removed"] == 2


def test_near_ties_skip_what_is_no_number(spark):
    rows = [(1.0,), (1.05,), (NAN,), (math.inf,), (math.inf,), (-math.inf,), (None,), (5.0,), (1e300,), (1e300,)]
    got = quality.near_ties(spark.createDataFrame(rows, "s double"), "s", 0.1, partitions=2)
    assert sorted(tuple(r) for r in got.collect()) == [(1.0, 2, 2), (1e300, 1, 2)]


def test_digest_tells_separators_in_texts(spark):
    rows = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("a\\", "|b|c"), (None, "x"), ("\\N", "x")], "p string, q string")
    assert relational.random_pairs(rows, ["p", "q"], seed=3).count() == 5


def test_nan_is_missing(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", NAN, 5.0), ("a", 3.0, 6.0), ("b", None, 1.0)], "g string, v double, w double")
    means = {r["g"]: r["mean"] for r in stats.mean_by_group(df, "g", "v").collect()}
    assert means == {"a": 2.0, "b": None}
    scaled = [r.v for r in features.standardize(df, ["v"]).collect()]
    assert scaled[0] == -1.0 and scaled[2] == 1.0 and math.isnan(scaled[1]) and scaled[3] is None
    assert stats.column_means(df, ["v"]).first()["v"] == 2.0
    assert stats.correlation_with_target(df, "w", ["v"]).first()["r"] == 1.0
    many = spark.createDataFrame([(float(i % 5),) for i in range(40)] + [(NAN,)] * 5 + [(90.0,)], "v double")
    assert quality.iqr_report(many).first()["outliers"] == 1


def test_density_keeps_the_nameless_group(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), (None, 1.0), (None, 3.0)], "g string, v double")
    assert {r["g"] for r in charts.density(df, "v", "g", bins=2).collect()} == {"a", None}


def test_variants_differ_beyond_the_sixth_digit(spark):
    rows = [("x", 1, 2.0), ("x", 0, 1.0), ("y", 1, 2.0), ("y", 0, 1.0)]
    df = spark.createDataFrame(rows, "variant string, y int, s double")
    assert metrics.pick_variant(df, "y", "s", "variant", "y").first()["variant"] == "y"


def test_csv_values_and_rows_are_checked(spark, tmp_path):
    good = write(tmp_path / "a.csv", 'i,s,b,t\n1,12D,Yes,"x\ny"\n2,3F,No,z\n')
    got = src.read_csv(spark, good, multi_line=True)
    assert dict(got.dtypes) == {"i": "bigint", "s": "string", "b": "string", "t": "string"}
    assert [tuple(r) for r in got.orderBy("i").collect()] == [(1, "12D", "Yes", "x\ny"), (2, "3F", "No", "z")]
    flags = src.read_csv(spark, write(tmp_path / "b.csv", "f,n,x\ntrue,1.5,NA\nFALSE,-2e3,4\n"))
    assert dict(flags.dtypes) == {"f": "boolean", "n": "double", "x": "bigint"}
    schema = spark.createDataFrame([], "i long, s string").schema
    assert src.read_csv(spark, write(tmp_path / "c.csv", "i,s\n1,a\nNA,b\n"), schema).count() == 2
    for name, text in (("d", "i,s\noops,a\n"), ("e", "i,s\n1,a,surplus\n"), ("f", "i,s\n1\n")):
        with pytest.raises(errors.InvalidCSVError):
            src.read_csv(spark, write(tmp_path / f"{name}.csv", text), schema)


def test_half_written_cache_is_not_used(spark, tmp_path):
    facts = spark.createDataFrame([(1, "a")], "k long, v string")
    path = str(tmp_path / "cache")
    facts.limit(0).write.parquet(path)
    (tmp_path / "cache" / "_SUCCESS").unlink()
    assert src.cached_join(facts, None, "k", path).count() == 1
    assert src.cached_join(facts.limit(0), None, "k", path).count() == 1


def test_retention_reads_only_young_partitions(spark, tmp_path):
    log = spark.sql("SELECT id, timestamp'2024-01-01' + make_interval(0, 0, 0, int(id)) AS ts FROM range(100)")
    log.withColumn("log_date", F.to_date("ts")).write.partitionBy("log_date").parquet(str(tmp_path / "log"))
    stored = spark.read.parquet(str(tmp_path / "log"))
    kept, counts = quality.apply_retention(stored, F.lit("2024-04-09").cast("timestamp"), 10, date="log_date")
    assert kept.count() == 11 and tuple(counts.first()) == (11, 89)
    assert "PartitionFilters: [(isnull(log_date" in kept._jdf.queryExecution().toString() or "log_date" in kept._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1][:80]


def test_pages_tell_whether_they_are_whole(spark):
    df = spark.range(2000)
    page = Toolbox(df).call("run_sql", query="SELECT id FROM dataset").page()
    assert (page["row_count"], page["truncated"], page["columns"], len(page["rows"])) == (500, True, ["id"], 500)
    record = run_sql(df, "SELECT id FROM dataset WHERE id < 500").record()
    assert (record["row_count"], record["truncated"]) == (500, False)
