"""Column, group and correlation statistics."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tabkit.errors import InsufficientDataError, InvalidArgumentsError
from tabkit.functions.columns import distinct_key, is_boolean, is_numeric, known, missing, numeric_columns, pearson, require_columns, stack_rows
from tabkit.plans.ordered import quantiles_long

QUARTILES = {"q25": 0.25, "median": 0.5, "q75": 0.75}
AGGREGATES = ("mean", "median", "std", "min", "max", "count", "sum")
_SIMPLE = {
    "mean": F.avg,
    "std": F.stddev_samp,
    "min": F.min,
    "max": F.max,
    "count": F.count,
    "sum": F.sum,
}


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(F.try_divide(100 * part, whole), digits)


def numeric_summary(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """count, missing, mean, std, min, quartiles and max per column: one pass plus the quartiles."""
    fields = ["count", "missing", "mean", "std", "min", "max"]
    aggregates: list[Column] = []
    for c in columns:
        value = F.when(~missing(df, c), F.col(f"`{c}`").cast("double"))
        aggregates += [
            F.count(value).alias(f"{c}__count"),
            F.count_if(missing(df, c)).alias(f"{c}__missing"),
            F.avg(value).alias(f"{c}__mean"),
            F.stddev_samp(value).alias(f"{c}__std"),
            F.min(value).alias(f"{c}__min"),
            F.max(value).alias(f"{c}__max"),
        ]
    wide = df.groupBy(*keys).agg(*aggregates)
    moments = stack_rows(wide, columns, fields, keys)
    clean = df.select(
        *keys, *[F.when(~missing(df, c), F.col(f"`{c}`").cast("double")).alias(c) for c in columns]
    )
    quartiles = quantiles_long(clean, columns, QUARTILES, keys)
    found = quartiles.select(*[F.col(k).alias(f"__k_{k}") for k in keys], F.col("column").alias("__column"), *[c for c in quartiles.columns if c not in (*keys, "column")])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys], F.col("column") == F.col("__column"))
    return moments.join(found, same, "left").drop("__column", *[f"__k_{k}" for k in keys])


def describe_numeric(df: DataFrame, column: str) -> DataFrame:
    """One row of rounded statistics. A column without values gets an ``error`` instead of numbers."""
    require_columns(df, [column])
    s = numeric_summary(df, [column])
    r = {f: F.round(f, 4).alias(f) for f in ("mean", "median", "min", "max", "q25", "q75")}
    return s.select(
        "column",
        "count",
        "missing",
        r["mean"],
        r["median"],
        F.when(F.col("count") > 0, F.round(F.coalesce("std", F.lit(0.0)), 4)).alias("std"),
        r["min"],
        r["max"],
        r["q25"],
        r["q75"],
        F.when(F.col("count") == 0, F.concat(F.lit("no values in column "), "column")).alias("error"),
    )


def describe_categorical(df: DataFrame, column: str, top: int = 20) -> DataFrame:
    """The ``top`` most frequent values with their share of the non-missing rows."""
    require_columns(df, [column])
    counts = (
        df.select(F.when(~missing(df, column), F.col(column)).cast("string").alias("value"))
        .groupBy("value")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    present = F.when(F.col("value").isNotNull(), F.col("count"))
    totals = counts.agg(
        F.struct(
            F.coalesce(F.sum(present), F.lit(0)).alias("count"),
            F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("count"))), F.lit(0)).alias("missing"),
            F.count(present).alias("n_unique"),
        )
    ).scalar()
    return (
        counts.filter(F.col("value").isNotNull())
        .orderBy(F.desc("count"), "value")
        .limit(top)
        .select(
            "value",
            "count",
            percent(F.col("count"), totals["count"]).alias("pct"),
            totals["count"].alias("total"),
            totals["missing"].alias("missing"),
            totals["n_unique"].alias("n_unique"),
        )
    )


def describe_column(df: DataFrame, column: str) -> DataFrame:
    """Numbers get :func:`describe_numeric`; everything else, booleans too, the categorical form."""
    require_columns(df, [column])
    if is_numeric(df, column) and not is_boolean(df, column):
        return describe_numeric(df, column)
    return describe_categorical(df, column)


def describe_frame(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The statistics of every numeric column, one row each."""
    return numeric_summary(df, list(columns or numeric_columns(df)))


def group_statistics(df: DataFrame, group_by: str, target: str, agg: str = "mean") -> DataFrame:
    """Per group the aggregate of a numeric target and the group size.

    A text target gives the share of each target value per group instead, see :func:`group_rates`.
    """
    require_columns(df, [group_by, target])
    if not is_numeric(df, target):
        return group_rates(df, group_by, target)
    if agg not in AGGREGATES:
        raise InvalidArgumentsError(f"unknown aggregate {agg!r}; choose one of {AGGREGATES}")
    rows = df.select(group_by, target).filter(~missing(df, group_by) & ~missing(df, target))
    if agg == "median":
        sizes = rows.groupBy(group_by).agg(F.count(F.lit(1)).alias("group_size"))
        medians = quantiles_long(rows, [target], {"value": 0.5}, [group_by])
        return medians.join(sizes, group_by).select(group_by, F.round("value", 4).alias("value"), "group_size")
    value = _SIMPLE[agg](F.col(target))
    rounded = value if agg == "count" else F.round(value.cast("double"), 4)
    return rows.groupBy(group_by).agg(rounded.alias("value"), F.count(F.lit(1)).alias("group_size"))


def group_rates(df: DataFrame, group_by: str, target: str, digits: int = 2, dense: bool = True) -> DataFrame:
    """Share of each target value within each group, long form.

    Dense output shows absent combinations as zero, so it grows with groups times values by definition; the sparse form
    holds only what occurs.
    """
    require_columns(df, [group_by, target])
    counts = (
        df.filter(~missing(df, group_by) & ~missing(df, target))
        .groupBy(group_by, target)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    sizes = counts.groupBy(group_by).agg(F.sum("n").alias("group_size"))
    if dense:
        # the result itself is the product of both sets
        full = sizes.crossJoin(counts.select(target).distinct())
        joined = full.join(counts, [group_by, target], "left")
    else:
        joined = counts.join(sizes, group_by)
    return joined.select(
        group_by,
        target,
        F.coalesce("n", F.lit(0)).alias("n"),
        "group_size",
        percent(F.coalesce("n", F.lit(0)), F.col("group_size"), digits).alias("pct"),
    )


def correlation_pairs(df: DataFrame, columns: Sequence[str] | None = None, digits: int | None = 4) -> DataFrame:
    """Pearson correlation of every column pair i < j, pairwise complete, in one aggregation."""
    names = numeric_columns(df, columns)
    if len(names) < 2:
        raise InsufficientDataError("a correlation needs at least two numeric columns")
    value = {c: F.when(~missing(df, c), F.col(f"`{c}`").cast("double")) for c in names}
    pairs = list(combinations(names, 2))
    wide = df.agg(*[pearson(value[a], value[b]).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    rows = F.array(
        *[
            F.struct(F.lit(a).alias("column_1"), F.lit(b).alias("column_2"), F.col(f"r{i}").alias("r"))
            for i, (a, b) in enumerate(pairs)
        ]
    )
    long = wide.select(F.inline(rows))
    return long if digits is None else long.withColumn("r", F.round("r", digits))


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None, digits: int = 4) -> DataFrame:
    """Both triangles and the diagonal, long form (column_1, column_2, r)."""
    upper = correlation_pairs(df, columns, digits)
    both = F.array(
        F.struct(F.col("column_1"), F.col("column_2"), F.col("r")),
        F.struct(F.col("column_2").alias("column_1"), F.col("column_1").alias("column_2"), F.col("r")),
    )
    diagonal = df.sparkSession.createDataFrame(
        [(c, c, 1.0) for c in numeric_columns(df, columns)], "column_1 string, column_2 string, r double"
    )
    return upper.select(F.inline(both)).unionByName(diagonal)


def correlation_lower(df: DataFrame, columns: Sequence[str] | None = None, digits: int = 4) -> DataFrame:
    """The lower triangle: row column after column column, no diagonal."""
    return correlation_pairs(df, columns, digits).select(
        F.col("column_2").alias("column_1"), F.col("column_1").alias("column_2"), "r"
    )


def correlation_with_target(df: DataFrame, target: str, features: Sequence[str] | None = None) -> DataFrame:
    """Correlation of each feature with the target, strongest first."""
    require_columns(df, [target])
    names = [c for c in (features or numeric_columns(df)) if c != target]
    require_columns(df, names)
    wide = df.agg(*[pearson(known(df, c).cast("double"), known(df, target).cast("double")).alias(f"{c}__r") for c in names])
    long = stack_rows(wide, names, ["r"]).select(F.col("column").alias("feature"), F.round("r", 4).alias("r"))
    return long.orderBy(F.desc(F.abs("r")), "feature")


def correlation_compare(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The correlations of two populations side by side, with their difference."""
    a = correlation_pairs(left, columns, None).withColumnRenamed("r", "r_left")
    b = correlation_pairs(right, columns, None).withColumnRenamed("r", "r_right")
    return a.join(b, ["column_1", "column_2"]).select(
        "column_1",
        "column_2",
        F.round("r_left", 4).alias("r_left"),
        F.round("r_right", 4).alias("r_right"),
        F.round(F.col("r_right") - F.col("r_left"), 4).alias("difference"),
    )


def variance_inflation(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """VIF per feature: the diagonal of the inverse correlation matrix, which is k by k."""
    names = list(features)
    require_columns(df, names)
    complete = df.select(*[F.col(c).cast("double").alias(c) for c in names]).dropna()
    r = np.eye(len(names))
    for row in correlation_pairs(complete, names, None).collect():
        i, j = names.index(row["column_1"]), names.index(row["column_2"])
        r[i, j] = r[j, i] = np.nan if row["r"] is None else row["r"]
    if np.isnan(r).any():
        raise InsufficientDataError("a feature is constant, its variance inflation is undefined")
    try:
        vif = np.diag(np.linalg.inv(r))
    except np.linalg.LinAlgError:
        vif = np.full(len(names), np.inf)
    rows = [(name, float(v)) for name, v in zip(names, vif)]
    frame = df.sparkSession.createDataFrame(rows, "feature string, vif double")
    return frame.select("feature", F.round("vif", 4).alias("vif")).orderBy(F.desc("vif"), "feature")


def mean_by_group(df: DataFrame, group_by: str, target: str) -> DataFrame:
    """Mean of the target per group, highest first; with a 0/1 target this is the event rate."""
    require_columns(df, [group_by, target])
    return (
        df.groupBy(group_by)
        .agg(F.round(F.avg(known(df, target)), 4).alias("mean"), F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("mean"), group_by)
    )


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    require_columns(df, keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).orderBy(*keys)


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Count and share of every class, largest first."""
    require_columns(df, [label])
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.select(label, "n", F.round(F.col("n") / total, 6).alias("share")).orderBy(F.desc("n"), label)


def positive_weight(df: DataFrame, positive: Column) -> DataFrame:
    """Rows of both classes and the weight neg/pos that balances them."""
    return df.agg(F.count_if(positive).alias("n_pos"), F.count_if(~positive).alias("n_neg")).withColumn(
        "pos_weight", F.round(F.try_divide(F.col("n_neg"), F.col("n_pos")), 6)
    )


def distinct_counts(df: DataFrame, *columns: str, approximate: bool = False) -> DataFrame:
    """Distinct non-missing values per column; ``approximate`` trades exactness for one light pass."""
    require_columns(df, columns)
    count = F.approx_count_distinct if approximate else F.count_distinct
    wide = df.agg(*[count(distinct_key(df, c)).cast("long").alias(f"{c}__n_distinct") for c in columns])
    return stack_rows(wide, list(columns), ["n_distinct"])


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    require_columns(df, columns)
    return df.select(*columns).distinct().orderBy(*columns)


def column_means(df: DataFrame, columns: Sequence[str], digits: int = 3) -> DataFrame:
    """Mean of each metric column over all runs."""
    require_columns(df, columns)
    return df.agg(*[F.round(F.avg(known(df, c)), digits).alias(c) for c in columns])
