"""Dataset profiling: semantic column types, summaries, candidate targets."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tabkit.functions.columns import distinct_key, is_boolean, is_numeric, missing
from tabkit.operators.quality import duplicate_rows
from tabkit.operators.stats import numeric_summary

# Name parts that suggest a target column.
TARGET_HINTS = ("churn", "target", "label", "class", "outcome", "default", "fraud", "converted")
MAX_CATEGORICAL_UNIQUE = 20
MAX_CATEGORICAL_RATIO = 0.05
TEXT_RATIO = 0.5
TEXT_UNIQUE = 50
DATE_SAMPLE = 50
# English names of months and days, of which the first three letters will do.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
DAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
_WORD = r"([A-Za-z]{3,9})\.?"
_DAY_NAME = "(?i:(?:" + "|".join(f"{d[:3]}(?:{d[3:]})?" for d in DAYS) + r"),? +)?"
#: Orders of the fields of a date; the last group is the time of day. A date has separators, so bare numbers are none.
_ORDERS = {
    "ymd": rf"^(\d{{4}})([-/.])(\d{{1,2}})\2(\d{{1,2}})((?:[T ].*)?)$",
    "xxy": rf"^{_DAY_NAME}(\d{{1,2}})([-/.])(\d{{1,2}})\2(\d{{4}})((?: .*)?)$",
    "dby": rf"^{_DAY_NAME}(\d{{1,2}})(?:st|nd|rd|th)?[- ]{_WORD},?[- ](\d{{4}})((?: .*)?)$",
    "bdy": rf"^{_DAY_NAME}{_WORD} +(\d{{1,2}})(?:st|nd|rd|th)?,? +(\d{{4}})((?: .*)?)$",
}
_TIME = r"^(?:[T ] *(\d{1,2}):(\d{2})(?::(\d{2}(?:[.,]\d{1,9})?))? *([AaPp][Mm])? *(Z|UTC|GMT|[+-]\d{2}:?\d{2})?)?$"
_HEAD = 200


def _month(name: Column) -> Column:
    """Number of a month by its full name or first three letters (four for September), else null."""
    known = {m: i + 1 for i, m in enumerate(MONTHS)} | {m[:3]: i + 1 for i, m in enumerate(MONTHS)} | {"sept": 9}
    return F.create_map(*[F.lit(x) for item in known.items() for x in item])[F.lower(name)]


def parse_date(text: Column) -> Column:
    """Timestamp of a date in any common spelling, else null.

    A date is year, month and day between equal separators (``-``, ``/`` or ``.``), or day, month and year: of two numbers before the year the first is the
    month, unless it is above 12 or the separator is a dot; or day and month name in either order, a day name before it or not. A time may
    follow: hours and minutes, seconds with a fraction, AM or PM, and a zone (Z, UTC, GMT or an offset). Fields out of range are no date.
    """
    moved = {"ymd": "$1|$3|$4|$2|$5", "xxy": "$1|$3|$4|$2|$5", "dby": "$1|$2|$3||$4", "bdy": "$1|$2|$3||$4"}
    fields = F.coalesce(*[F.when(text.rlike(p), F.concat(F.lit(f"{o}|"), F.regexp_replace(text, p, moved[o]))) for o, p in _ORDERS.items()])

    def dated(f: Column) -> Column:
        """From order, three fields, separator and time of day."""
        a, b, c = (f[i].try_cast("int") for i in (1, 2, 3))
        day_first = (f[4] == ".") | (a > 12)
        year = F.when(f[0] == "ymd", a).otherwise(c)
        month = F.when(f[0] == "ymd", b).when(f[0] == "xxy", F.when(day_first, b).otherwise(a)).when(f[0] == "dby", _month(f[2])).otherwise(_month(f[1]))
        day = F.when(f[0] == "ymd", c).when(f[0] == "xxy", F.when(day_first, a).otherwise(b)).when(f[0] == "dby", a).otherwise(b)
        time = F.split(F.regexp_replace(f[5], _TIME, "$1|$2|$3|$4|$5"), r"\|", 5)
        return F.when(f[5].rlike(_TIME), _bound(F.struct(year.alias("y"), month.alias("m"), day.alias("d"), time.alias("t")), _stamp))

    return _bound(F.split(fields, r"\|", 6), dated)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _stamp(s: Column) -> Column:
    """A timestamp from year, month, day and hour, minute, second, half of the day and zone; null if a field is out of range."""
    of_time = lambda i: F.nullif(s["t"][i], F.lit(""))
    hour, half, zone = F.coalesce(of_time(0).cast("int"), F.lit(0)), F.lower(of_time(3)), of_time(4)
    hour = F.when(half.isNull(), hour).when(hour.between(1, 12), hour % 12 + F.when(half == "pm", 12).otherwise(0))
    second = F.coalesce(F.replace(of_time(2), F.lit(","), F.lit(".")), F.lit("0")).cast("decimal(16,6)")
    clock = (s["y"], s["m"], s["d"], hour, F.coalesce(of_time(1).cast("int"), F.lit(0)), second)
    offset = F.when(zone.isin("Z", "UTC", "GMT"), F.lit("UTC")).otherwise(F.concat(F.substring(zone, 1, 3), F.lit(":"), F.substring(zone, -2, 2)))
    return F.when(zone.isNull(), F.try_make_timestamp(*clock)).otherwise(F.try_make_timestamp(*clock, offset))


def _orderable(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]


def _as_text(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    return [
        F.when(~missing(df, c), F.to_json(F.struct(c)) if _nested(df, c) else F.col(f"`{c}`").cast("string")).alias(c)
        for c in columns
    ]


def _nested(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, (T.ArrayType, T.MapType, T.StructType))


def first_values(
    df: DataFrame, n: int, columns: Sequence[str] | None = None, order_by: Sequence[str] | None = None
) -> DataFrame:
    """The first ``n`` non-missing values of every column: (column, position, value).

    "First" follows ``order_by`` (default: all columns). The first rows of the table answer this
    for all but sparse columns; only those are then looked up in the whole table.
    """
    names = list(columns or df.columns)
    order = list(order_by or _orderable(df))
    struct = F.struct(*order).alias("__order")

    def ranked(rows: DataFrame, some: Sequence[str]) -> DataFrame:
        long = rows.select(struct, *_as_text(rows, some)).unpivot("__order", list(some), "column", "value")
        by = Window.partitionBy("column").orderBy("__order")
        numbered = long.filter(F.col("value").isNotNull()).withColumn("position", F.row_number().over(by))
        return numbered.filter(F.col("position") <= n).select("column", "position", "value")

    # a few rows, wanted by the type detection and by the samples
    head = df.orderBy(*order).limit(max(_HEAD, n)).persist()
    seen = head.agg(
        F.count(F.lit(1)).alias("__n"), *[F.count_if(~missing(head, c)).alias(c) for c in names]
    ).first()
    complete = seen["__n"] < max(_HEAD, n)  # the head is the whole table
    dense = [c for c in names if complete or seen[c] >= n]
    sparse = [c for c in names if c not in dense]
    if not sparse:
        return ranked(head, dense)
    found = ranked(df, sparse)
    return ranked(head, dense).unionByName(found) if dense else found


def sample_values(df: DataFrame, n: int = 3, order_by: Sequence[str] | None = None) -> DataFrame:
    """(column, sample_values): the first values as text."""
    ordered = F.array_sort(F.collect_list(F.struct("position", "value")))
    return (
        first_values(df, n, order_by=order_by)
        .groupBy("column")
        .agg(F.transform(ordered, lambda s: s["value"]).alias("sample_values"))
    )


def date_columns(df: DataFrame, order_by: Sequence[str] | None = None) -> list[str]:
    """String columns whose first values (at most fifty) are all dates."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not texts:
        return []
    checked = (
        first_values(df, DATE_SAMPLE, texts, order_by)
        .groupBy("column")
        .agg(F.bool_and(parse_date(F.trim("value")).isNotNull()).alias("all_dates"))
    )
    found = {r["column"] for r in checked.filter("all_dates").collect()}
    return [c for c in texts if c in found]


def _kind(df: DataFrame, column: str, n_rows: int, unique: int, dates: Sequence[str]) -> str:
    dtype = df.schema[column].dataType
    ratio = unique / n_rows if n_rows else 0.0
    if is_boolean(df, column):
        return "boolean"
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)) or column in dates:
        return "datetime"
    if is_numeric(df, column):
        few = unique <= MAX_CATEGORICAL_UNIQUE and ratio <= MAX_CATEGORICAL_RATIO
        return "categorical" if few else "numeric"
    if isinstance(dtype, T.StringType):
        return "text" if ratio > TEXT_RATIO and unique > TEXT_UNIQUE else "categorical"
    return "unknown"


def column_types(df: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """Semantic type, missing values and cardinality per column.

    One aggregation over all columns plus the look at the first values of string columns.
    """
    countable = [c for c in df.columns if not isinstance(df.schema[c].dataType, (T.MapType, T.VariantType))]
    counts = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.struct(*[F.count_if(missing(df, c)).alias(c) for c in df.columns]).alias("missing"),
        F.struct(*[F.count_distinct(distinct_key(df, c)).alias(c) for c in countable]).alias("unique"),
    ).first()
    dates = date_columns(df, order_by)
    n = counts["n"]
    rows = []
    for i, field in enumerate(df.schema.fields):
        gaps = counts["missing"][field.name]
        unique = counts["unique"][field.name] if field.name in countable else 0
        rows.append(
            (i, field.name, field.dataType.simpleString(), _kind(df, field.name, n, unique, dates), n, gaps, unique)
        )
    frame = df.sparkSession.createDataFrame(
        rows,
        "position int, name string, dtype string, column_type string, n_rows long, missing_count long, "
        "unique_count long",
    )
    return frame.select(
        "*",
        F.coalesce(F.round(F.try_divide(F.col("missing_count") * 100, "n_rows"), 2), F.lit(0.0)).alias("missing_pct"),
        F.coalesce(F.round(F.try_divide("unique_count", "n_rows"), 4), F.lit(0.0)).alias("cardinality_ratio"),
    )


def top_categories(df: DataFrame, columns: Sequence[str], n: int = 10) -> DataFrame:
    """The ``n`` most frequent values of each column: (column, rank, value, count)."""
    long = df.select(*_as_text(df, columns)).unpivot([], list(columns), "column", "value")
    counts = long.filter(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
    by = Window.partitionBy("column").orderBy(F.desc("count"), "value")
    # the filter on row_number lets Spark keep only n rows per column before the shuffle
    return counts.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= n).select(
        "column", "rank", "value", "count"
    )


def numeric_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, mean, std, min, p25, median, p75, max), four decimals, undefined ones as zero."""
    s = numeric_summary(df, columns).filter(F.col("count") > 0)
    names = {"mean": "mean", "std": "std", "min": "min", "q25": "p25", "median": "median", "q75": "p75", "max": "max"}
    return s.select("column", *[F.coalesce(F.round(a, 4), F.lit(0.0)).alias(b) for a, b in names.items()])


def profile_columns(df: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """One row per column: type, missing values, cardinality, samples, summary or top values.

    The number of jobs does not depend on the number of columns.
    """
    types = column_types(df, order_by)
    kinds = {r["name"]: r["column_type"] for r in types.select("name", "column_type").collect()}
    out = types.join(sample_values(df, 3, order_by), F.col("name") == F.col("column"), "left").drop("column")
    numeric = [c for c, k in kinds.items() if k == "numeric"]
    grouped = [c for c, k in kinds.items() if k in ("categorical", "boolean")]
    if numeric:
        fields = ("mean", "std", "min", "p25", "median", "p75", "max")
        pairs = [part for f in fields for part in (F.lit(f), F.col(f))]
        summary = numeric_profile(df, numeric).select("column", F.create_map(*pairs).alias("numeric_summary"))
        out = out.join(summary, F.col("name") == F.col("column"), "left").drop("column")
    else:
        out = out.withColumn("numeric_summary", F.lit(None).cast("map<string,double>"))
    if grouped:
        entries = F.array_sort(F.collect_list(F.struct("rank", "value", "count")))
        tops = top_categories(df, grouped).groupBy("column").agg(
            F.map_from_entries(F.transform(entries, lambda e: F.struct(e["value"], e["count"]))).alias("top_categories")
        )
        out = out.join(tops, F.col("name") == F.col("column"), "left").drop("column")
    else:
        out = out.withColumn("top_categories", F.lit(None).cast("map<string,bigint>"))
    return out.withColumn("sample_values", F.coalesce("sample_values", F.array().cast("array<string>")))


def possible_target(name: Column, column_type: Column, unique: Column) -> Column:
    """Does a profile row look like a target column?"""
    hints = F.array(*[F.lit(h) for h in TARGET_HINTS])
    hinted = F.arrays_overlap(F.split(F.lower(name), "[^a-z0-9]+"), hints)
    return hinted | (column_type.isin("categorical", "boolean") & (unique <= 10))


def possible_targets(df: DataFrame, types: DataFrame | None = None) -> DataFrame:
    types = column_types(df) if types is None else types
    keep = possible_target(F.col("name"), F.col("column_type"), F.col("unique_count"))
    return types.filter(keep).orderBy("position").select("position", "name")


def profile_dataset(df: DataFrame, order_by: Sequence[str] | None = None, columns: DataFrame | None = None) -> DataFrame:
    """One row for the whole table: sizes, duplicates, column names by type, candidate targets."""
    columns = column_types(df, order_by) if columns is None else columns

    def names(condition: Column) -> Column:
        picked = F.array_sort(F.collect_list(F.when(condition, F.struct("position", "name"))))
        return F.transform(picked, lambda s: s["name"])

    target = possible_target(F.col("name"), F.col("column_type"), F.col("unique_count"))
    kinds = ("numeric", "categorical", "datetime", "boolean", "text")
    return columns.agg(
        F.coalesce(F.max("n_rows"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_columns"),
        *[names(F.col("column_type") == k).alias(f"{k}_columns") for k in kinds],
        names(target).alias("possible_target_columns"),
    ).withColumn("duplicate_row_count", duplicate_rows(df).scalar())


def profile_text(df: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """The profile in a few lines of text."""
    types = column_types(df, order_by)
    gaps = types.filter(F.col("missing_count") > 0).agg(
        F.array_sort(F.collect_list(F.format_string("%s (%s%%)", "name", "missing_pct")))
    )
    overview = profile_dataset(df, order_by, types).withColumn("gaps", gaps.scalar())

    def listed(title: str, column: str) -> Column:
        return F.concat(F.lit(f"{title}: "), F.array_join(column, ", "))

    return overview.select(
        F.concat_ws(
            "\n",
            F.format_string("%d rows, %d columns, %d duplicate rows", "n_rows", "n_columns", "duplicate_row_count"),
            listed("numeric", "numeric_columns"),
            listed("categorical", "categorical_columns"),
            listed("datetime", "datetime_columns"),
            listed("boolean", "boolean_columns"),
            listed("possible targets", "possible_target_columns"),
            F.when(F.size("gaps") > 0, listed("missing values in", "gaps")),
        ).alias("summary")
    )


def type_breakdown(types: DataFrame) -> DataFrame:
    """How many columns there are of each type."""
    return types.groupBy("column_type").agg(F.count(F.lit(1)).alias("n_columns"))

