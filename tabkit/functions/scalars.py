"""Column expressions for the scalar functions the operators share. All of them stay in the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def tokens(text: Column) -> Column:
    """Lower-case runs of letters a-z and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit("([a-z0-9]+)"), F.lit(1))


def numbers_in(text: Column) -> Column:
    """Number tokens of a text, in order."""
    return F.regexp_extract_all(text, F.lit(r"(\d+(?:\.\d+)?)"), F.lit(1))


def truncated(text: Column, limit: int = 300) -> Column:
    """At most ``limit`` characters, with dots where text was cut off."""
    return F.when(F.length(text) > limit, F.concat(F.left(text, F.lit(limit)), F.lit("..."))).otherwise(text)


def suffix(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"(\.[^./]+)$", 1))


def name_part(text: Column) -> Column:
    """A name in lower case with '-' and blanks as '_'."""
    return F.replace(F.replace(F.lower(F.trim(text)), F.lit("-"), F.lit("_")), F.lit(" "), F.lit("_"))


def clipped(value: Column, low: float | None = None, high: float | None = None) -> Column:
    if low is not None:
        value = F.greatest(value, F.lit(low))
    return value if high is None else F.least(value, F.lit(high))


def days_before(moment: Column, days: int) -> Column:
    return moment - F.make_interval(days=F.lit(days))


def iso_time(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss")


def argmax(values: Column) -> Column:
    """0-based position of the first maximum."""
    return F.array_position(values, F.array_max(values)) - 1


def mean(values: Column) -> Column:
    return F.try_divide(F.aggregate(values, F.lit(0.0), lambda s, v: s + v), F.size(values))


def any_nonzero(values: Column) -> Column:
    return F.exists(values, lambda v: v != 0)


def as_map(entries: Sequence[tuple[str, Column]]) -> Column:
    return F.create_map(*[part for name, value in entries for part in (F.lit(name), value)])


def ratio(a: Column, b: Column, default: float = 0.0) -> Column:
    """a / b, or the default where b is zero or missing."""
    return F.coalesce(F.try_divide(a, b), F.lit(default))
