"""Schema-driven column choices and argument checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tabkit.errors import InvalidArgumentsError


def require_columns(df: DataFrame, columns: Sequence[str | None]) -> None:
    """Fail early, before any job, when a named column does not exist."""
    missing = [c for c in columns if c is not None and c not in df.columns]
    if missing:
        raise InvalidArgumentsError(f"columns not found: {missing}; available: {df.columns}")


def columns_of(df: DataFrame, *kinds: type) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def numeric_columns(df: DataFrame, among: Sequence[str] | None = None) -> list[str]:
    """Numeric columns in table order; booleans are not numbers here."""
    if among is not None:
        require_columns(df, among)
    return [c for c in columns_of(df, T.NumericType) if among is None or c in among]


def other_columns(df: DataFrame) -> list[str]:
    numbers = set(numeric_columns(df))
    return [c for c in df.columns if c not in numbers]


def is_numeric(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.NumericType)


def is_boolean(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.BooleanType)


def missing(df: DataFrame, column: str) -> Column:
    """Null, or NaN in a floating-point column."""
    c = F.col(f"`{column}`")
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def known(df: DataFrame, column: str) -> Column:
    """The column with NaN as null, so that aggregates skip it."""
    return F.when(~missing(df, column), F.col(f"`{column}`"))


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN counts as missing everywhere; one projection makes it null."""
    floats = set(columns_of(df, T.DoubleType, T.FloatType))
    return df.select(
        *[F.when(~F.isnan(c), F.col(c)).alias(c) if c in floats else F.col(f"`{c}`") for c in df.columns]
    )


def stack_rows(wide: DataFrame, columns: Sequence[str], fields: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Turn one wide aggregate row (``column__field``) into one row per column."""
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column"), *[F.col(f"`{c}__{f}`").alias(f) for f in fields])
            for c in columns
        ]
    )
    return wide.select(*keys, F.explode(rows).alias("__r")).select(*keys, "__r.*")


def pearson(a: Column, b: Column) -> Column:
    """Pairwise-complete correlation aggregate; null, not an error, when one side is constant."""
    spread = F.stddev_pop(F.when(b.isNotNull(), a)) * F.stddev_pop(F.when(a.isNotNull(), b))
    return F.try_divide(F.covar_pop(a, b), spread)


def distinct_key(df: DataFrame, column: str) -> Column:
    """What to count distinctly for a column: its value, or for long texts a SHA-256 of it.

    Distinct counts shuffle every distinct value; this way a value never weighs more than 64 bytes.
    """
    c = F.col(f"`{column}`")
    value = F.when(~missing(df, column), c)
    if isinstance(df.schema[column].dataType, T.StringType):
        return F.when(F.length(c) > 64, F.sha2(c, 256)).otherwise(value)
    return value
