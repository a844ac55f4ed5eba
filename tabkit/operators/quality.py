"""Validation and hygiene: size checks, missing values, duplicates, outlier fences, pairs, retention."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tabkit.errors import DatasetTooLargeError, EmptyDatasetError, InvalidArgumentsError, InvalidCSVError
from tabkit.functions.columns import missing, numeric_columns, require_columns, stack_rows
from tabkit.plans.ordered import quantiles_long
from tabkit.plans.sizing import is_small, lookup_side, range_partitions
from tabkit.session import checkpointed


def size_check(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """One row (n_columns, has_rows, too_large). Looks at no more than ``max_rows + 1`` rows."""
    wanted = 1 if max_rows is None else max_rows + 1
    seen = df.limit(wanted).agg(F.count(F.lit(1)).alias("__n"))
    return seen.select(
        F.lit(len(df.columns)).alias("n_columns"),
        (F.col("__n") > 0).alias("has_rows"),
        (F.lit(False) if max_rows is None else F.col("__n") > max_rows).alias("too_large"),
    )


def validate(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """The table itself, or a typed error if it has no columns, no rows or too many rows."""
    if not df.columns:
        raise InvalidCSVError("the table has no columns")
    state = size_check(df, max_rows).first()
    if not state["has_rows"]:
        raise EmptyDatasetError("the table has no rows")
    if state["too_large"]:
        raise DatasetTooLargeError(f"the table has more than {max_rows} rows")
    return df


def validate_target(df: DataFrame, target: str) -> None:
    if target not in df.columns:
        raise InvalidArgumentsError(f"target column {target!r} not found; available: {df.columns}")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """How many rows repeat an earlier one. Nulls equal each other.

    A large table is first counted by an 8-byte hash, so that only rows whose hash repeats have to
    be shuffled whole. If too many repeat, all rows are grouped; both ways are exact.
    """
    if not is_small(df):
        digest = F.xxhash64(*df.columns)
        repeated = df.groupBy(digest.alias("__h")).agg(F.count(F.lit(1)).alias("__c")).filter(F.col("__c") > 1)
        side = repeated.select("__h")
        fitting = lookup_side(side)
        if fitting is not side:
            df = df.join(fitting, digest == F.col("__h"), "left_semi")
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__c"))
    return copies.agg(F.coalesce(F.sum(F.col("__c") - 1), F.lit(0)).cast("long").alias("duplicate_rows"))


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values per column, one pass: (column, missing, total)."""
    wide = df.agg(
        *[F.count_if(missing(df, c)).alias(f"{c}__missing") for c in df.columns],
        *[F.count(F.lit(1)).alias(f"{c}__total") for c in df.columns],
    )
    return stack_rows(wide, df.columns, ["missing", "total"])


def missing_top(df: DataFrame, n: int = 30) -> DataFrame:
    """Columns with the largest share of missing values, and how many columns have any."""
    counts = null_counts(df).filter(F.col("missing") > 0)
    affected = counts.agg(F.count(F.lit(1))).scalar()
    return (
        counts.select(
            "column",
            F.round(F.col("missing") / F.col("total") * 100, 4).alias("missing_pct"),
            affected.alias("columns_with_missing"),
        )
        .orderBy(F.desc("missing_pct"), "column")
        .limit(n)
    )


def drop_sparse_columns(df: DataFrame, threshold: float = 0.70) -> DataFrame:
    """Drop columns whose missing share is strictly above ``threshold``."""
    row = df.agg(
        F.count(F.lit(1)).alias("__n"), *[F.count_if(missing(df, c)).alias(c) for c in df.columns]
    ).first()
    n = max(row["__n"], 1)
    return df.drop(*[c for c in df.columns if row[c] / n > threshold])


def iqr_fences(df: DataFrame, columns: Sequence[str], factor: float = 1.5, keys: Sequence[str] = ()) -> DataFrame:
    """Per column the quartiles and the values beyond which a row is an outlier.

    Columns: keys, column, q25, median, q75, lower, upper.
    """
    quartiles = quantiles_long(df, columns, {"q25": 0.25, "median": 0.5, "q75": 0.75}, keys)
    spread = factor * (F.col("q75") - F.col("q25"))
    return quartiles.withColumn("lower", F.col("q25") - spread).withColumn("upper", F.col("q75") + spread)


def iqr_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Outliers per numeric column (strictly outside the fences), only columns that have some."""
    names = list(columns or numeric_columns(df))
    require_columns(df, names)
    # one fence per table column: the driver sees as many numbers as the schema has columns
    fences = {r["column"]: r for r in iqr_fences(df, names).collect()}
    counts = df.agg(
        *[
            F.count_if(
                ~missing(df, c) & ((F.col(c) < F.lit(fences[c]["lower"])) | (F.col(c) > F.lit(fences[c]["upper"])))
            ).alias(
                f"{c}__outliers"
            )
            for c in names
        ],
        *[F.count(F.lit(1)).alias(f"{c}__total") for c in names],
    )
    long = stack_rows(counts, names, ["outliers", "total"]).filter(F.col("outliers") > 0)
    return long.select("column", "outliers", F.round(F.col("outliers") / F.col("total") * 100, 4).alias("outlier_pct"))


def iqr_filter(df: DataFrame, *columns: str, factor: float = 1.5) -> DataFrame:
    """Keep rows inside the fences of each column, one after the other.

    Each fence is computed on the rows the earlier ones left.
    """
    require_columns(df, columns)
    for c in columns:
        fences = iqr_fences(df, [c], factor).select(F.struct("lower", "upper")).scalar()
        df = df.filter(F.col(c).between(fences["lower"], fences["upper"]))
    return df


def stem_of(path: Column) -> Column:
    """File name without folder and extension."""
    return F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1)


def split_of(path: Column) -> Column:
    """The folder of a path without its ``images`` or ``labels`` part: ``train`` for ``train/images/x.jpg``, ``images/train/x.jpg`` and ``train/x.jpg``."""
    folder = F.regexp_extract(path, r"^(.*)/[^/]*$", 1)
    return F.trim(F.regexp_replace(folder, r"(^|/)(images|labels)(?=/|$)", ""), F.lit("/"))


def drop_empty_pairs(images: DataFrame, labels: DataFrame, split: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Clean manifest, and the count of removed images.

    ``images`` has a path, ``labels`` a path and a size; files belong together if split and stem are equal. The split is the folder without its
    ``images`` or ``labels`` part, or what group 1 of the pattern ``split`` finds in the path; a path without a match is an error. An
    image goes if its label file is empty; when a stem has several image files only the first existing of
    .jpg, .jpeg, .png goes. An image without a label file stays.
    """
    pair = ["__split", "__stem"]
    path = F.col("path")
    if split is None:
        named = split_of(path)
    else:
        without = F.raise_error(F.concat(F.lit("no split in path "), path))
        named = F.when(path.rlike(split), F.regexp_extract(path, split, 1)).otherwise(without)
    preference = F.array_position(F.array(F.lit("jpg"), F.lit("jpeg"), F.lit("png")), F.col("__suffix"))
    tagged = images.select(
        "path", named.alias("__split"), stem_of(path).alias("__stem"),
        F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).alias("__suffix"),
    )
    empty = labels.select(named.alias("__split"), stem_of(path).alias("__stem"), "size").filter(F.col("size") == 0).select(*pair).distinct()
    hit = tagged.filter(preference > 0).join(empty, pair, "left_semi")
    removed = hit.groupBy(*pair).agg(F.min_by("path", preference).alias("path"))
    clean = images.join(removed.select("path"), "path", "left_anti")
    return clean, removed.agg(F.count(F.lit(1)).alias("removed"))


def split_counts(files: DataFrame) -> DataFrame:
    """Images, labels and empty labels per split of a listing (split, kind, size)."""
    label = F.col("kind") == "label"
    return (
        files.groupBy("split")
        .agg(
            F.count_if(F.col("kind") == "image").alias("n_images"),
            F.count_if(label).alias("n_labels"),
            F.count_if(label & (F.col("size") == 0)).alias("n_empty"),
        )
        .withColumn("empty_pct", F.round(100 * F.try_divide(F.col("n_empty"), F.col("n_labels")), 4))
    )


def repeated_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their count."""
    require_columns(df, keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def apply_retention(
    log: DataFrame, now: datetime | Column, days: int = 90, ts: str = "ts", date: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows young enough to stay, and one row with the counts of kept and removed rows.

    ``date`` names a partition column that holds the date of ``ts``: older partitions are then not read for
    the rows that stay. The counts need the whole log.
    """
    limit = (now if isinstance(now, Column) else F.lit(now)) - F.make_interval(days=F.lit(days))
    expired = F.col(ts) < limit
    counts = log.agg(
        F.count_if(~expired | expired.isNull()).alias("kept"), F.count_if(expired).alias("removed")
    )
    stays = log.filter(~expired | expired.isNull())
    if date is not None:
        stays = stays.filter((F.col(date) >= limit.cast("date")) | F.col(date).isNull())
    return stays, counts


def near_ties(df: DataFrame, score: str, tolerance: float = 1e-4, partitions: int | None = None) -> DataFrame:
    """Groups of scores closer than ``tolerance`` to the first score of their group.

    Result: (anchor, n_scores, n_rows) for groups of two rows and more. Null, NaN and infinite scores are in
    no group. The first score of a group
    depends on the group before it, all the way down. Distinct scores are therefore range-partitioned;
    every partition reports, for each possible first anchor near its start, where its last group
    opens. The driver links these few numbers, and a second pass marks all partitions at once.
    """
    require_columns(df, [score])
    value = F.col(score).cast("double")
    finite = value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))
    distinct = df.filter(finite).groupBy(value.alias("score")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    if partitions is None:
        distinct = checkpointed(distinct)
    count = partitions or range_partitions(distinct, distinct.count())
    ranged = checkpointed(distinct.repartitionByRange(count, "score").withColumn("part", F.spark_partition_id()))

    def next_group(values: np.ndarray) -> np.ndarray:
        """For every score, the position where the group it opens has ended."""
        step = np.searchsorted(values, values + tolerance, side="left")
        at = np.minimum(step, len(values) - 1)
        # rounding in value + tolerance must not contradict the test score - anchor < tolerance
        step = np.where((step < len(values)) & (values[at] - values < tolerance), step + 1, step)
        back = np.maximum(step - 1, 0)
        step = np.where((back > np.arange(len(values))) & (values[back] - values >= tolerance), back, step)
        return np.maximum(step, np.arange(len(values)) + 1)

    def exits(pdf: pd.DataFrame) -> pd.DataFrame:
        values = np.sort(pdf["score"].to_numpy())
        step = next_group(values)
        last = np.arange(len(values))
        for i in range(len(values) - 1, -1, -1):
            if step[i] < len(values):
                last[i] = last[step[i]]
        # the first group to open here starts at most one tolerance after the first score
        starts = np.searchsorted(values, values[0] + tolerance, side="left") + 2
        final = values[last][:starts]
        turns = np.append(final[1:] != final[:-1], True)
        return pd.DataFrame(
            {
                "part": pdf["part"].iloc[0],
                "start": values[:starts][turns],
                "anchor": final[turns],
                "high": values[-1],
            }
        )

    rows = (
        ranged.groupBy("part").applyInPandas(exits, "part int, start double, anchor double, high double").collect()
    )
    by_part: dict[int, list] = {}
    for r in sorted(rows, key=lambda r: (r["part"], r["start"])):
        by_part.setdefault(r["part"], []).append(r)
    opening: dict[int, float | None] = {}
    anchor: float | None = None
    for part in sorted(by_part):
        opening[part] = anchor
        options = by_part[part]
        if anchor is not None and options[0]["high"] - anchor < tolerance:
            continue
        reach = next((r for r in options if anchor is None or r["start"] - anchor >= tolerance), options[-1])
        anchor = reach["anchor"]

    def mark(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("score")
        values = pdf["score"].to_numpy()
        inherited = opening[int(pdf["part"].iloc[0])]
        first = 0 if inherited is None else int(np.argmax(np.append(values - inherited >= tolerance, True)))
        step = next_group(values)
        anchors = np.full(len(values), np.nan if inherited is None else inherited)
        at = first
        while at < len(values):
            anchors[at : step[at]] = values[at]
            at = step[at]
        return pd.DataFrame({"anchor": anchors, "rows": pdf["rows"].to_numpy()})

    marked = ranged.groupBy("part").applyInPandas(mark, "anchor double, rows long")
    groups = marked.groupBy("anchor").agg(F.count(F.lit(1)).alias("n_scores"), F.sum("rows").alias("n_rows"))
    return groups.filter(F.col("n_rows") > 1)
