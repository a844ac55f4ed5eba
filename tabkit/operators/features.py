"""Feature preparation: imputation, encoding, scaling and reproducible splits.

Everything that is learned (medians, levels, codes, means) is learned from ``fit_on``, which
defaults to the frame itself; pass the training rows to keep test rows out of it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tabkit.errors import InsufficientDataError, InvalidArgumentsError
from tabkit.functions.columns import distinct_key, is_boolean, is_numeric, known, missing, numeric_columns, require_columns
from tabkit.plans.ordered import digest_cuts, quantiles_long, row_digest, running_totals
from tabkit.plans.sizing import MAX_BROADCAST_ROWS, lookup_side
from tabkit.session import checkpointed

MAX_LEVELS = 20
MAX_CLASS_VALUES = 10
MAX_CLASS_RATIO = 0.05


def flag(condition: Column) -> Column:
    """A condition as a 0/1 byte."""
    return condition.cast("byte")


def impute_median(df: DataFrame, columns: Sequence[str] | None = None, fit_on: DataFrame | None = None) -> DataFrame:
    """Missing numbers become the exact column median; a column without any value becomes 0."""
    names = list(columns or numeric_columns(df))
    require_columns(df, names)
    base = df if fit_on is None else fit_on
    clean = base.select(*[F.when(~missing(base, c), F.col(c).cast("double")).alias(c) for c in names])
    # one number per table column comes to the driver, so the plan of the result stays small
    found = {r["column"]: r["median"] for r in quantiles_long(clean, names, {"median": 0.5}).collect()}
    return df.withColumns(
        {
            c: F.coalesce(F.when(~missing(df, c), F.col(c).cast("double")), F.lit(float(found[c] or 0.0)))
            for c in names
        }
    )


def impute_category(df: DataFrame, columns: Sequence[str], token: str = "missing") -> DataFrame:
    """Missing categories become a category of their own."""
    require_columns(df, columns)
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(token)) for c in columns})


def label_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Codes 0..n-1 of each column's values in lexicographic order: (column, value, code), for all columns at once."""
    require_columns(df, columns)
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], list(columns), "column", "value").filter(F.col("value").isNotNull())
    ranks = running_totals(long.distinct(), "value", {"n": ("sum", F.lit(1))}, ["column"])
    return ranks.select("column", "value", (F.col("cum_n") - 1).cast("long").alias("code"))


def label_encode(df: DataFrame, columns: Sequence[str], codes: DataFrame | None = None) -> DataFrame:
    """Replace values by their codes; values unknown to ``codes`` become null. A few codes are fetched once for all columns and broadcast."""
    codes = checkpointed(label_codes(df, columns)) if codes is None else codes
    few = codes.limit(MAX_BROADCAST_ROWS + 1).collect()
    out = df
    for c in columns:
        if len(few) <= MAX_BROADCAST_ROWS:
            own = [(r["value"], r["code"]) for r in few if r["column"] == c]
            mine = F.broadcast(df.sparkSession.createDataFrame(own, f"`__v_{c}` string, `__c_{c}` long"))
        else:
            mine = codes.filter(F.col("column") == c).select(F.col("value").alias(f"__v_{c}"), F.col("code").alias(f"__c_{c}"))
        out = out.join(mine, F.col(c).cast("string") == F.col(f"__v_{c}"), "left")
    kept = [F.col(f"__c_{c}").alias(c) if c in columns else F.col(c) for c in df.columns]
    return out.select(*kept)


def one_hot_vector(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None, column: str = "levels") -> DataFrame:
    """Indicators of all levels of all columns as one sparse vector, for any number of levels.

    A column's levels come in lexicographic order, the columns one after the other; missing values and levels that ``fit_on`` does not have are zero everywhere.
    """
    codes = checkpointed(label_codes(df if fit_on is None else fit_on, columns))
    sizes = {r["column"]: r["n"] for r in codes.groupBy("column").agg(F.count("*").alias("n")).collect()}
    names = [f"__h_{c}" for c in columns]
    coded = label_encode(df.select("*", *[F.col(c).alias(h) for c, h in zip(columns, names)]), names, codes.withColumn("column", F.concat(F.lit("__h_"), "column")))
    # what has no code gets one more, which the encoder leaves out
    coded = coded.withColumns({h: F.coalesce(h, F.lit(sizes.get(c, 0))).cast("double") for c, h in zip(columns, names)})
    most = df.sparkSession.createDataFrame([tuple(float(sizes.get(c, 0)) for c in columns)], ", ".join(f"`{h}` double" for h in names))
    encoder = OneHotEncoder(inputCols=names, outputCols=[f"{h}_v" for h in names], dropLast=True).fit(most)
    joined = VectorAssembler(inputCols=[f"{h}_v" for h in names], outputCol=column).transform(encoder.transform(coded))
    return joined.drop(*names, *[f"{h}_v" for h in names])


def ordinal(column: str, mapping: Mapping[str, int]) -> Column:
    """Fixed value-to-number mapping as one literal lookup."""
    pairs = [F.lit(part) for item in mapping.items() for part in item]
    return F.create_map(*pairs)[F.col(column)]


def levels_of(df: DataFrame, column: str, limit: int = 1000) -> list:
    """Sorted distinct values; refuses columns with more than ``limit``."""
    found = [r[0] for r in df.select(column).dropna().distinct().limit(limit + 1).collect()]
    if len(found) > limit:
        raise InvalidArgumentsError(f"{column!r} has more than {limit} levels")
    return sorted(found)


def one_hot(
    df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None, prefix: str | None = None
) -> DataFrame:
    """Indicator columns for every level, named ``column_level``.

    With ``prefix`` the name is ``prefix_level`` with the level in lower case and '-' as '_'.
    """
    require_columns(df, columns)
    added: list[Column] = []
    for c in columns:
        for level in levels_of(df if fit_on is None else fit_on, c):
            name = f"{c}_{level}" if prefix is None else f"{prefix}_{str(level).lower().replace('-', '_')}"
            added.append(F.coalesce(F.col(c) == F.lit(level), F.lit(False)).cast("byte").alias(name))
    return df.select(*[c for c in df.columns if c not in columns], *added)


def usable_features(df: DataFrame, target: str, max_levels: int = MAX_LEVELS) -> list[str]:
    """Numeric and boolean columns, and others with at most ``max_levels`` values (one pass)."""
    require_columns(df, [target])
    others = [c for c in df.columns if c != target]
    scalar = (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType)
    open_ones = [c for c in others if isinstance(df.schema[c].dataType, scalar)]
    few: dict[str, int] = {}
    if open_ones:
        few = df.agg(*[F.count_distinct(distinct_key(df, c)).alias(c) for c in open_ones]).first().asDict()
    usable = [c for c in others if is_numeric(df, c) or is_boolean(df, c) or few.get(c, max_levels + 1) <= max_levels]
    if not usable:
        raise InsufficientDataError("no usable feature columns")
    return usable


def feature_choice(df: DataFrame, target: str, max_levels: int = MAX_LEVELS) -> DataFrame:
    """Which columns :func:`usable_features` keeps, as a frame (column, usable)."""
    keep = set(usable_features(df, target, max_levels))
    rows = [(c, c in keep) for c in df.columns if c != target]
    return df.sparkSession.createDataFrame(rows, "column string, usable boolean")


def problem_type(df: DataFrame, target: str) -> DataFrame:
    """classification or regression, with the numbers behind the choice (one row)."""
    require_columns(df, [target])
    facts = df.agg(F.count_distinct(distinct_key(df, target)).alias("n_unique"), F.count(F.lit(1)).alias("n_rows"))
    few = (F.col("n_unique") <= MAX_CLASS_VALUES) & (
        F.col("n_unique") / F.greatest("n_rows", F.lit(1)) < MAX_CLASS_RATIO
    )
    if is_numeric(df, target) and not is_boolean(df, target):
        kind = F.when(few, "classification").otherwise("regression")
    else:
        kind = F.lit("classification")
    return facts.select(F.lit(target).alias("target"), "n_unique", "n_rows", kind.alias("problem_type"))


def standardize(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Subtract the mean and divide by the population deviation (a constant column is only centred)."""
    require_columns(df, columns)
    base = df if fit_on is None else fit_on
    stats = base.agg(
        *[F.avg(known(base, c)).alias(f"{c}__mean") for c in columns],
        *[F.stddev_pop(known(base, c)).alias(f"{c}__std") for c in columns],
    ).first()
    return df.withColumns(
        {c: (F.col(c) - F.lit(stats[f"{c}__mean"])) / F.lit(stats[f"{c}__std"] or 1.0) for c in columns}
    )


def with_value(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def minmax_row(values: Column, epsilon: float = 1e-8) -> Column:
    """Scale one row's vector to 0..1."""

    def scaled(r: Column) -> Column:
        return F.transform(r["v"], lambda x: (x - r["low"]) / (r["high"] - r["low"] + epsilon))

    def ranged(v: Column) -> Column:
        return F.struct(v.alias("v"), F.array_min(v).alias("low"), F.array_max(v).alias("high"))

    return with_value(with_value(values, ranged), scaled)


def normalize(values: Column, mean: Column, std: Column) -> Column:
    """Channel-wise (x - mean) / std."""
    return F.zip_with(values, F.arrays_zip(mean.alias("m"), std.alias("s")), lambda x, p: (x - p["m"]) / p["s"])


def denormalize(values: Column, mean: Column, std: Column) -> Column:
    """Undo :func:`normalize` and clamp to 0..1."""
    return F.zip_with(
        values,
        F.arrays_zip(mean.alias("m"), std.alias("s")),
        lambda x, p: F.greatest(F.lit(0.0), F.least(F.lit(1.0), x * p["s"] + p["m"])),
    )


# --- splits -----------------------------------------------------------------------------------


def split_random(
    df: DataFrame,
    test_size: float = 0.2,
    seed: int = 42,
    key: Sequence[str] | None = None,
    stratify: str | None = None,
    column: str = "split",
) -> DataFrame:
    """Mark ``ceil(n * test_size)`` rows (per class when stratified) as test, the others as train.

    Rows are ordered by a hash of ``key``, so the same seed splits every projection of a table the
    same way. Copies of a row always land on the same side.
    """
    require_columns(df, [stratify, *(key or [])])
    keys = [stratify] if stratify else []
    tagged = df.withColumn("__digest", row_digest(df, seed, key))
    wanted = F.ceil(F.col("n") * F.lit(float(test_size)))
    cuts = digest_cuts(tagged.select(*keys, "__digest"), "__digest", wanted, keys)
    if stratify:
        cuts = lookup_side(cuts.withColumnRenamed(stratify, "__class"))
        marked = tagged.join(cuts, F.col(stratify).eqNullSafe(F.col("__class")), "left")
        test = F.col("__digest") <= F.col("cut")
    else:
        marked = tagged
        test = F.col("__digest") <= cuts.scalar()
    return marked.select(*df.columns, F.when(test, "test").otherwise("train").alias(column))


def split_time(
    df: DataFrame,
    time: str,
    test_size: float = 0.2,
    key: Sequence[str] | None = None,
    seed: int = 0,
    column: str = "split",
    partitions: int | None = None,
) -> DataFrame:
    """The first ``int(n * (1 - test_size))`` rows in time order are train, the later ones test.

    Rows at the very cut instant are divided by a hash of ``key``. Only counts per instant are
    ordered globally, never the rows.
    """
    require_columns(df, [time, *(key or [])])
    counts = running_totals(df, time, {"n": ("sum", F.lit(1))}, partitions=partitions)
    wanted = F.floor(F.col("tot_n") * F.lit(1.0 - test_size))
    row = counts.filter(F.col("cum_n") >= wanted).orderBy(time).select(
        F.col(time).alias("at"), (wanted - F.col("cum_n") + F.col("n")).alias("left")
    )
    edge = row.limit(1).first()
    if edge is None:
        raise InsufficientDataError("cannot split a table without rows")
    edge_value = F.lit(edge["at"]).cast(df.schema[time].dataType)
    tagged = df.withColumn("__digest", row_digest(df, seed, key))
    at_edge = tagged.filter(F.col(time).eqNullSafe(edge_value)).select("__digest")
    cut = digest_cuts(at_edge, "__digest", F.lit(edge["left"])).scalar()
    before = F.col(time).isNull() | (F.col(time) < edge_value)
    train = F.coalesce(before | ((F.col(time) == edge_value) & (F.col("__digest") <= cut)), F.lit(False))
    return tagged.select(*df.columns, F.when(train, "train").otherwise("test").alias(column))


def carve_validation(df: DataFrame, size: float = 0.15, seed: int = 43, key: Sequence[str] | None = None) -> DataFrame:
    """Turn part of the train rows into validation rows."""
    require_columns(df, ["split"])
    train = df.filter(F.col("split") == "train").drop("split")
    marked = split_random(train, size, seed, key)
    renamed = marked.withColumn("split", F.when(F.col("split") == "test", "validation").otherwise("train"))
    return renamed.unionByName(df.filter(F.col("split") != "train"))
