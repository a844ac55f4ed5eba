"""The bounded aggregates behind charts. Drawing them is left to the reader's plotting tool."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tabkit.errors import InvalidArgumentsError
from tabkit.functions.columns import missing, require_columns
from tabkit.operators import stats
from tabkit.operators.quality import iqr_fences
from tabkit.plans.sizing import lookup_side



def _span(df: DataFrame, value: Column) -> Column:
    return df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()


def _bin(value: Column, span: Column, bins: int) -> Column:
    """Equal-width bin number; the maximum belongs to the last bin."""
    width = span["hi"] - span["lo"]
    raw = F.floor((value - span["lo"]) / width * bins)
    return F.when(width == 0, F.lit(0)).otherwise(F.least(raw, F.lit(bins - 1))).cast("int")


def histogram(
    df: DataFrame,
    column: str,
    color_by: str | None = None,
    bins: int = 30,
    clip_upper: float | None = None,
) -> DataFrame:
    """Counts per equal-width bin (and colour). ``clip_upper`` first pulls larger values down to it."""
    require_columns(df, [column, color_by])
    keys = [color_by] if color_by else []
    value = F.col(column).cast("double")
    if clip_upper is not None:
        value = F.least(value, F.lit(float(clip_upper)))
    rows = df.filter(~missing(df, column)).select(*keys, value.alias("__v"))
    span = _span(rows, F.col("__v"))
    width = (span["hi"] - span["lo"]) / bins
    counts = rows.groupBy(*keys, _bin(F.col("__v"), span, bins).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(
        *keys,
        "bin",
        F.round(span["lo"] + F.col("bin") * width, 6).alias("left"),
        F.round(span["lo"] + (F.col("bin") + 1) * width, 6).alias("right"),
        "n",
    )


def density(df: DataFrame, column: str, by: str, bins: int = 30) -> DataFrame:
    """Binned density of each population, on common bins so that curves can be laid over each other."""
    counts = histogram(df, column, by, bins)
    totals = lookup_side(counts.groupBy(F.col(by).alias("__by")).agg(F.sum("n").alias("__n")))
    return counts.join(totals, F.col(by).eqNullSafe(F.col("__by"))).select(
        by, "bin", "left", "right",
        F.round(F.try_divide("n", F.col("__n") * (F.col("right") - F.col("left"))), 6).alias("density"),
    )


def box(df: DataFrame, column: str, group_by: str | None = None) -> DataFrame:
    """Quartiles, whiskers (extreme values inside the fences) and outlier count per group."""
    require_columns(df, [column, group_by])
    keys = [group_by] if group_by else []
    value = F.col(column).cast("double")
    rows = df.filter(~missing(df, column)).select(*keys, value.alias(column))
    fences = iqr_fences(rows, [column], keys=keys).drop("column")
    if keys:
        key = f"__{group_by}"
        fences = lookup_side(fences.withColumnRenamed(group_by, key))
        joined = rows.join(fences, F.col(group_by).eqNullSafe(F.col(key)))
    else:
        box_of_all = fences.select(F.struct("*")).scalar()
        joined = rows.select(column, box_of_all.alias("b")).select(column, "b.*")
    inside = F.col(column).between(F.col("lower"), F.col("upper"))
    return joined.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.first("q25"), 4).alias("q25"),
        F.round(F.first("median"), 4).alias("median"),
        F.round(F.first("q75"), 4).alias("q75"),
        F.round(F.min(F.when(inside, F.col(column))), 4).alias("whisker_low"),
        F.round(F.max(F.when(inside, F.col(column))), 4).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"),
    )


def scatter_grid(df: DataFrame, x: str, y: str, color_by: str | None = None, cells: int = 50) -> DataFrame:
    """Row counts on a regular grid over the value range of both columns."""
    require_columns(df, [x, y, color_by])
    keys = [color_by] if color_by else []
    rows = df.filter(~missing(df, x) & ~missing(df, y)).select(
        *keys, _position(df, x, x).alias("__x"), _position(df, y, y).alias("__y")
    )
    sx, sy = _span(rows, F.col("__x")), _span(rows, F.col("__y"))
    return rows.groupBy(
        *keys, _bin(F.col("__x"), sx, cells).alias("x_cell"), _bin(F.col("__y"), sy, cells).alias("y_cell")
    ).agg(F.count(F.lit(1)).alias("n"))


def scatter(df: DataFrame, x: str, y: str, color_by: str | None = None) -> DataFrame:
    """All points, whatever their number; :func:`scatter_grid` has counts of cells instead."""
    require_columns(df, [x, y, color_by])
    columns = list(dict.fromkeys([x, y] + ([color_by] if color_by else [])))
    return df.select(*columns).filter(~missing(df, x) & ~missing(df, y))


def bar(df: DataFrame, category: str, value: str | None = None, agg: str = "count") -> DataFrame:
    """Counts per category (largest first), or an aggregate of a value column per category."""
    require_columns(df, [category, value])
    if value is None:
        counts = df.filter(~missing(df, category)).groupBy(category).agg(F.count(F.lit(1)).alias("count"))
        return counts.orderBy(F.desc("count"), category)
    if agg not in stats.AGGREGATES:
        raise InvalidArgumentsError(f"unknown aggregate {agg!r}; choose one of {stats.AGGREGATES}")
    grouped = stats.group_statistics(df.select(category, F.col(value).cast("double").alias(value)), category, value, agg)
    return grouped.select(category, F.col("value").cast("double").alias(value)).orderBy(category)


def line(df: DataFrame, x: str, y: str, color_by: str | None = None) -> DataFrame:
    """All points sorted by x, whatever their number; :func:`line_buckets` has means of ranges instead."""
    require_columns(df, [x, y, color_by])
    keys = [color_by] if color_by else []
    rows = df.filter(~missing(df, x)).select(*keys, F.col(x).alias("x"), F.col(y).cast("double").alias("y"))
    return rows.orderBy("x", "y", *keys)


def _position(df: DataFrame, column: str, name: str) -> Column:
    """A number that orders an axis: the value, microseconds of a time, days of a date."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(name).cast("timestamp")).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(name).cast("double")
    if isinstance(kind, T.NumericType):
        return F.col(name).cast("double")
    raise InvalidArgumentsError(f"{column!r} is neither a number nor a time, so its axis has no ranges")


def line_buckets(df: DataFrame, x: str, y: str, color_by: str | None = None, buckets: int = 200) -> DataFrame:
    """The mean of y per bucket of x, with the bucket's range. ``x`` is a number, a date or a time."""
    require_columns(df, [x, y, color_by])
    keys = [color_by] if color_by else []
    rows = df.filter(~missing(df, x)).select(*keys, F.col(x).alias("x"), F.col(y).cast("double").alias("y"))
    position = _position(df, x, "x")
    span = _span(rows, position)
    return (
        rows.groupBy(*keys, _bin(position, span, buckets).alias("__bin"))
        .agg(
            F.min("x").alias("x"),
            F.max("x").alias("x_last"),
            F.round(F.avg("y"), 6).alias("y"),
            F.count(F.lit(1)).alias("n"),
        )
        .drop("__bin")
        .orderBy("x")
    )


def correlation_heatmap(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return stats.correlation_matrix(df, columns, digits=3)


def category_comparison(df: DataFrame, category: str, target: str) -> DataFrame:
    """Row percentages of a category by target table, long form, zero-filled."""
    return stats.group_rates(df, category, target, digits=4).select(category, target, F.col("pct").alias("percent"))


def metric_bars(table: DataFrame, name: str, metrics: Sequence[str]) -> DataFrame:
    """A metrics table in the long form grouped bars need."""
    require_columns(table, [name, *metrics])
    return table.select(name, *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(
        [name], list(metrics), "metric", "value"
    )


CHARTS: dict[str, Callable[..., DataFrame]] = {
    "histogram": histogram,
    "box": box,
    "scatter": scatter,
    "scatter_grid": scatter_grid,
    "bar": bar,
    "line": line,
    "line_buckets": line_buckets,
    "correlation_heatmap": correlation_heatmap,
    "category_comparison": category_comparison,
}


def chart_data(df: DataFrame, chart_type: str, **arguments) -> DataFrame:
    """Data of a chart by type name."""
    if chart_type not in CHARTS:
        raise InvalidArgumentsError(f"unknown chart type {chart_type!r}; choose one of {tuple(CHARTS)}")
    return CHARTS[chart_type](df, **arguments)
