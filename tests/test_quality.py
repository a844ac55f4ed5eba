from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from tabkit import errors
from tabkit.operators import quality, relational
from tabkit.sources import tables as src
from tests.conftest import rows_of


def test_validation_errors(spark):
    with pytest.raises(errors.InvalidCSVError):
        quality.validate(spark.createDataFrame([()], T.StructType([])))
    empty = spark.createDataFrame([], "a int, b int")
    with pytest.raises(errors.EmptyDatasetError):
        quality.validate(empty)
    df = spark.range(10)
    assert quality.validate(df, 10) is df
    with pytest.raises(errors.DatasetTooLargeError):
        quality.validate(df, 9)
    with pytest.raises(errors.InvalidArgumentsError):
        quality.validate_target(df, "nope")


def test_duplicates_count_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a"), (2, "a"), (1, None)], "a int, b string")
    assert quality.duplicate_rows(df).first()[0] == 2
    assert quality.duplicate_rows(df.limit(0)).first()[0] == 0
    spark.conf.set("spark.tabkit.smallBytes", "1")
    try:
        assert quality.duplicate_rows(df).first()[0] == 2
        many = spark.range(25_000).select((F.col("id") % 12_000).alias("v"))
        assert quality.duplicate_rows(many).first()[0] == 13_000
    finally:
        spark.conf.unset("spark.tabkit.smallBytes")


def test_null_counts_see_nan(spark, trips):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "a double")
    assert quality.null_counts(df).first()["missing"] == 2
    counts = {r["column"]: r["missing"] for r in quality.null_counts(trips).collect()}
    assert counts["fare"] == 4 and counts["wait"] == 0


def test_sparse_threshold_is_strict(spark):
    df = spark.range(10).select(
        "id", F.when(F.col("id") < 3, 1).alias("at"), F.when(F.col("id") < 2, 1).alias("above")
    )
    assert quality.drop_sparse_columns(df, 0.70).columns == ["id", "at"]


def test_iqr_filter_is_sequential(spark):
    df = spark.createDataFrame([(float(v), float(w)) for v, w in zip([1, 2, 3, 4, 100], [1, 2, 3, 50, 60])], "a double, b double")
    once = quality.iqr_filter(df, "a")
    assert sorted(r["a"] for r in once.collect()) == [1, 2, 3, 4]
    twice = quality.iqr_filter(df, "a", "b")
    b = np.array([1, 2, 3, 50.0])
    q1, q3 = np.quantile(b, [0.25, 0.75])
    kept = [x for x in b if q1 - 1.5 * (q3 - q1) <= x <= q3 + 1.5 * (q3 - q1)]
    assert sorted(r["b"] for r in twice.collect()) == kept


def brute_near_ties(scores, tolerance):
    groups, anchor = [], None
    for s in sorted(scores):
        if anchor is None or s - anchor >= tolerance:
            anchor = s
            groups.append([])
        groups[-1].append(s)
    return sorted((g[0], len(set(g)), len(g)) for g in groups if len(g) > 1)


@pytest.mark.parametrize("partitions", [1, 2, 7, 20])
@pytest.mark.parametrize("spread", [5.0, 0.5, 0.01])
def test_near_ties_match_a_plain_walk(spark, partitions, spread):
    rng = np.random.default_rng(5)
    scores = [float(x) for x in np.round(rng.random(400) * spread, 5)] + [0.25] * 100
    df = spark.createDataFrame([(s,) for s in scores], "s double")
    got = sorted(tuple(r) for r in quality.near_ties(df, "s", 0.01, partitions).collect())
    assert got == brute_near_ties(scores, 0.01)


def test_empty_pairs(spark):
    images = spark.createDataFrame(
        [("train/a.jpg",), ("train/a.png",), ("train/b.PNG",), ("train/c.jpg",), ("train/d.gif",)], "path string"
    )
    labels = spark.createDataFrame([("train/a.txt", 0), ("train/b.txt", 0), ("train/c.txt", 9), ("train/d.txt", 0)], "path string, size long")
    clean, removed = quality.drop_empty_pairs(images, labels)
    assert sorted(r[0] for r in clean.collect()) == ["train/a.png", "train/c.jpg", "train/d.gif"]
    assert removed.first()[0] == 2


def test_retention(spark):
    log = spark.createDataFrame([(1, datetime(2024, 1, 1)), (2, datetime(2024, 3, 31)), (3, None)], "id int, ts timestamp")
    kept, counts = quality.apply_retention(log, datetime(2024, 4, 1), 90)
    assert rows_of(kept, "id") == [(2,), (3,)]
    assert tuple(counts.first()) == (2, 1)


def test_csv_round_trip_and_missing_tokens(spark, tmp_path):
    path = str(tmp_path / "in.csv")
    with open(path, "w") as f:
        f.write('id,amount,name,flag\n1,1.5,"a, b",true\n2,NA,n/a,false\n3,,x,true\n')
    df = src.read_csv(spark, path)
    assert df.dtypes == [("id", "bigint"), ("amount", "double"), ("name", "string"), ("flag", "boolean")]
    assert rows_of(df) == [(1, 1.5, "a, b", True), (2, None, None, False), (3, None, "x", True)]
    with pytest.raises(errors.DatasetTooLargeError):
        src.read_csv(spark, path, max_rows=2)
    with pytest.raises(errors.InvalidCSVError):
        src.read_csv(spark, str(tmp_path / "absent.csv"))


def test_file_listing_keeps_empty_files(spark, tmp_path):
    for name, size in (("a.txt", 0), ("b.txt", 4), ("c.csv", 3)):
        (tmp_path / name).write_bytes(b"x" * size)
    folders = spark.createDataFrame([(str(tmp_path),)], "path string")
    listing = src.list_files(folders)
    assert sorted((r["path"].split("/")[-1], r["size"]) for r in listing.collect()) == [("a.txt", 0), ("b.txt", 4), ("c.csv", 3)]
    uri = src.list_files(spark.createDataFrame([(f"file://{tmp_path}/",)], "path string")).collect()
    assert sorted((r["path"], r["size"]) for r in uri) == [(f"file://{tmp_path}/{n}", s) for n, s in (("a.txt", 0), ("b.txt", 4), ("c.csv", 3))]
    assert src.admissible_files(listing, [".csv"], 10).count() == 1
    assert src.admissible_files(listing, [".csv"], 2).count() == 0


def test_manifest(spark):
    manifest = spark.createDataFrame(
        [("cup", "train", "normal", "1"), ("cup", "train", "defect", "2"), ("cup", "test", "defect", "3")],
        " Object string, SPLIT string, label string, image string".replace(" Object", "Object"),
    )
    assert [r["image"] for r in src.manifest_rows(manifest, "train", "cup").collect()] == ["1"]
    assert [r["image"] for r in src.manifest_rows(manifest, "test").collect()] == ["3"]
    with pytest.raises(errors.EmptyDatasetError):
        src.manifest_rows(manifest, "test", "plate")


def test_intents_document(spark, tmp_path):
    path = str(tmp_path / "intents.json")
    with open(path, "w") as f:
        f.write('{"intents": [{"tag": "hi", "patterns": ["hello", "hey"], "responses": ["yo"]},\n{"tag": "bye", "patterns": ["bye"], "responses": []}]}')
    docs = src.read_intents(spark, path)
    assert rows_of(src.explode_examples(docs)) == [("bye", "bye"), ("hi", "hello"), ("hi", "hey")]


def test_cached_join_is_reused(spark, tmp_path):
    facts = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    side = spark.createDataFrame([(1, 9)], "id int, w int")
    path = str(tmp_path / "cache")
    assert rows_of(src.cached_join(facts, side, "id", path)) == [(1, "a", 9), (2, "b", None)]
    assert rows_of(src.cached_join(facts.limit(0), side, "id", path)) == [(1, "a", 9), (2, "b", None)]
    assert src.cached_join(facts, None, "id", str(tmp_path / "other")).columns == ["id", "v"]


def test_random_pairs(spark):
    df = spark.range(200)
    pairs = relational.random_pairs(df, ["id"], seed=1).collect()
    assert sorted(r["id"] for r in pairs) == list(range(200))
    same = [r for r in pairs if r["same_row"]]
    assert 60 < len(same) < 140
    assert all((r["id"] == r["pair_id"]) == r["same_row"] for r in pairs)
    again = relational.random_pairs(df.repartition(7), ["id"], seed=1, partitions=3)
    assert rows_of(again) == sorted([tuple(r) for r in pairs], key=str)


def test_pairs_of_a_named_split(spark):
    images = spark.createDataFrame([("d/train_1/x.jpg",), ("d/valid_1/x.jpg",)], "path string")
    labels = spark.createDataFrame([("l/train_2/x.txt", 0), ("l/valid_2/x.txt", 9)], "path string, size long")
    clean, removed = quality.drop_empty_pairs(images, labels, split=r"/(train|valid)_")
    assert [r["path"] for r in clean.collect()] == ["d/valid_1/x.jpg"] and removed.first()[0] == 1
    with pytest.raises(Exception, match="no split in path"):
        quality.drop_empty_pairs(images, labels, split=r"/(test)_")[0].collect()


def test_quoted_line_breaks_in_many_blocks(spark, tmp_path):
    rng = np.random.default_rng(8)
    words = ["a", "line\nbreak", 'quo"te', "\n\n", "comma, x", "", "two\r\nlines", "plain"]
    rows = [(i, "".join(words[k] for k in rng.integers(0, len(words), int(rng.integers(0, 60))))) for i in range(600)]
    rows[300] = (300, "long\n" * 5000)
    path = str(tmp_path / "q.csv")
    with open(path, "w", newline="") as f:
        f.write("id,text\n" + "".join(f'{i},"{t.replace(chr(34), chr(34) * 2)}"\n' for i, t in rows))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        assert spark.read.text(path).rdd.getNumPartitions() > 5
        df = src.read_csv(spark, path, multi_line=True)
        got = {r["id"]: r["text"] for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert df.dtypes == [("id", "bigint"), ("text", "string")] and len(got) == 600
    for i, t in rows:
        assert (got[i] or "") == (t if t.strip(" ") not in src.NA_TOKENS else "")


def test_quoted_records_move_only_long_records(spark, tmp_path):
    """Lines are counted where they are read: no shuffle has the texts of records of one line."""
    rows = [(i, f'a "quoted" {i}' if i % 3 else f'line {i}\n"two"\n\nthree') for i in range(4000)]
    path = src.write_csv(spark.createDataFrame(rows, "id int, text string").repartition(3), str(tmp_path / "texts"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        records = src.quoted_records(spark, path)
        plan = records._jdf.queryExecution().optimizedPlan().toString()
        assert sorted(map(tuple, src.read_csv(spark, path, schema=T.StructType([T.StructField("id", T.IntegerType()), T.StructField("text", T.StringType())]), multi_line=True).collect())) == rows
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert "Window" not in plan and plan.count("Aggregate") == 1  # of the lines of long records
