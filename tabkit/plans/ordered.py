"""Global order without a single-partition window.

Every operator here first collapses equal order values with a map-side combined ``groupBy``. If few
distinct values are left, one window orders them. Otherwise they are range-partitioned by (keys,
order value), written once to the checkpoint folder, summed per partition, and get the totals of
the earlier partitions added. A key that holds a third of all rows is cut into as many ranges as
its share asks for.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window, functions as F, types as T

from tabkit.functions.columns import columns_of, stack_rows
from tabkit.plans.sizing import (
    MAX_BROADCAST_ROWS,
    TINY_BYTES,
    estimated_bytes,
    is_small,
    lookup_side,
    range_partitions,
    rows_fit,
)
from tabkit.session import checkpointed

_COMBINE = {"sum": F.sum, "min": F.min, "max": F.max}
_NEUTRAL = {"sum": lambda c: F.coalesce(c, F.lit(0)), "min": lambda c: c, "max": lambda c: c}
_MERGE = {"sum": lambda a, b: a + b, "min": F.least, "max": F.greatest}


def running_totals(
    df: DataFrame,
    order: str,
    measures: Mapping[str, tuple[str, Column]],
    keys: Sequence[str] = (),
    descending: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """One row per (keys, order value) with running and total measures.

    ``measures`` maps a name to ``(kind, column)``, kind being sum, min or max. For each name the
    result has ``name`` (this order value alone), ``cum_name`` (up to and including it) and
    ``tot_name`` (the whole key). ``partitions`` forces the range-partitioned plan.
    """
    keys = list(keys)
    grouped = df.groupBy(*keys, order).agg(
        *[_COMBINE[kind](column).alias(name) for name, (kind, column) in measures.items()]
    )
    direction = F.desc if descending else F.asc
    small = partitions is None and is_small(df.select(*keys, order))
    if partitions is None and not small:
        # estimates of joins are too high: store the distinct values once and look at their number
        grouped = checkpointed(grouped)
        n = grouped.count()
        small = rows_fit(grouped, n)
        partitions = range_partitions(grouped, n)
    if small:
        whole = Window.partitionBy(*keys)
        upto = whole.orderBy(direction(order)).rowsBetween(Window.unboundedPreceding, 0)
        return grouped.select(
            *keys,
            order,
            *measures,
            *[_COMBINE[kind](name).over(upto).alias(f"cum_{name}") for name, (kind, _) in measures.items()],
            *[_COMBINE[kind](name).over(whole).alias(f"tot_{name}") for name, (kind, _) in measures.items()],
        )

    ranged = checkpointed(
        grouped.repartitionByRange(partitions, *keys, direction(order)).withColumn("__part", F.spark_partition_id())
    )
    inside = (
        Window.partitionBy("__part", *keys).orderBy(direction(order)).rowsBetween(Window.unboundedPreceding, 0)
    )
    detail = ranged.select(
        "__part",
        *keys,
        order,
        *measures,
        *[_COMBINE[kind](name).over(inside).alias(f"__in_{name}") for name, (kind, _) in measures.items()],
    )
    blocks = ranged.groupBy(*keys, "__part").agg(
        *[_COMBINE[kind](name).alias(f"__b_{name}") for name, (kind, _) in measures.items()]
    )
    before = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    offsets = blocks.select(
        *[F.col(k).alias(f"__k_{k}") for k in keys],
        F.col("__part").alias("__k_part"),
        *[
            _NEUTRAL[kind](_COMBINE[kind](f"__b_{name}").over(before)).alias(f"__off_{name}")
            for name, (kind, _) in measures.items()
        ],
        *[_COMBINE[kind](f"__b_{name}").over(whole).alias(f"tot_{name}") for name, (kind, _) in measures.items()],
    )
    same = reduce(
        lambda a, b: a & b,
        [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys],
        F.col("__part") == F.col("__k_part"),
    )
    # without keys there is one offset row per range partition, so the size is known
    joined = detail.join(offsets if keys else lookup_side(offsets, partitions), same)
    return joined.select(
        *keys,
        order,
        *measures,
        *[
            _MERGE[kind](F.col(f"__in_{name}"), F.col(f"__off_{name}")).alias(f"cum_{name}")
            for name, (kind, _) in measures.items()
        ],
        *[f"tot_{name}" for name in measures],
    )


def quantiles_long(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Mapping[str, float],
    keys: Sequence[str] = (),
    partitions: int | None = None,
) -> DataFrame:
    """Exact linearly interpolated quantiles: one row per (keys, column), one field per probability.

    Tiny inputs use the built-in ``percentile``, which keeps all distinct values of a group in one
    task. Others take :func:`_bracketed_quantiles`, unless there are too many groups for it;
    :func:`_ranked_quantiles` then orders all distinct values (``partitions`` forces this way).
    """
    keys = list(keys)
    names = list(probabilities)
    picked = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])
    if partitions is None and estimated_bytes(picked) <= TINY_BYTES:
        points = F.array(*[F.lit(float(p)) for p in probabilities.values()])
        wide = picked.groupBy(*keys).agg(*[F.percentile(c, points).alias(c) for c in columns])
        flat = wide.select(*keys, *[F.col(c)[i].alias(f"{c}__{n}") for c in columns for i, n in enumerate(names)])
        return stack_rows(flat, list(columns), names, keys)
    if partitions is None:
        found = _bracketed_quantiles(picked, list(columns), probabilities, keys)
        if found is not None:
            return found
    return _ranked_quantiles(picked, list(columns), probabilities, keys, partitions)


#: A quantile sketch of this accuracy misses a rank by at most one row in as many.
SKETCH_ACCURACY = 10_000


def _bracketed_quantiles(
    df: DataFrame, columns: list[str], probabilities: Mapping[str, float], keys: list[str]
) -> DataFrame | None:
    """Quantiles from three light scans, or None if that is not possible.

    A sketch gives two values around each wanted rank, a second scan counts the rows below, and a
    third one looks only at the few rows in between. The counts prove that the bracket held the
    rank; if one did not, or there are more groups than may be broadcast, the answer is None.
    """
    # a bracket must reach past its rank by the sketch's error and by two rows; how far depends on
    # the size of the group, so three widths are asked for and one is chosen
    margins = (2.0 / SKETCH_ACCURACY, 0.05, 1.0)
    points = [
        min(max(p + side, 0.0), 1.0) for p in probabilities.values() for m in margins for side in (-m, m)
    ]
    sketch = df.groupBy(*keys).agg(
        *[F.count(c).alias(f"n__{c}") for c in columns],
        *[F.percentile_approx(c, points, SKETCH_ACCURACY).alias(f"b__{c}") for c in columns],
    )
    groups = sketch.limit(MAX_BROADCAST_ROWS + 1).collect()
    if len(groups) > MAX_BROADCAST_ROWS:
        return None
    spark = df.sparkSession

    def chosen(row: Row, c: str) -> list[float] | None:
        n, found = row[f"n__{c}"], row[f"b__{c}"]
        width = 0 if n >= 4 * SKETCH_ACCURACY else 1 if n >= 200 else 2
        step = 2 * len(margins)
        return found and [found[step * i + 2 * width + side] for i in range(len(probabilities)) for side in (0, 1)]

    brackets = [(*[r[k] for k in keys], *[chosen(r, c) for c in columns]) for r in groups]
    fields = [df.schema[k] for k in keys]
    fields += [T.StructField(f"b__{c}", T.ArrayType(T.DoubleType())) for c in columns]
    known = spark.createDataFrame(brackets, T.StructType(fields))
    cells = [(c, i, name) for c in columns for i, name in enumerate(probabilities)]
    if keys:
        side = F.broadcast(known.select(*[F.col(k).alias(f"__k_{k}") for k in keys], *[f"b__{c}" for c in columns]))
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys])
        rows = df.join(side, same)
        bound = {(c, j): f"`b__{c}`[{j}]" for c in columns for j in range(2 * len(probabilities))}
    else:
        rows = df
        bounds = {c: chosen(groups[0], c) or [None] * (2 * len(probabilities)) for c in columns}
        bound = {
            (c, j): "double(NULL)" if v is None else f"double('{v!r}')" for c in columns for j, v in enumerate(bounds[c])
        }
    below = rows.groupBy(*keys).agg(
        *[F.expr(f"count_if(`{c}` < {bound[c, 2 * i]})").alias(f"{c}__{name}") for c, i, name in cells]
    )
    inside = {(c, i): f"(`{c}` BETWEEN {bound[c, 2 * i]} AND {bound[c, 2 * i + 1]})" for c, i, _ in cells}
    entries = [
        f"named_struct('column', '{c}', 'name', '{name}', 'value', IF({inside[c, i]}, `{c}`, NULL))"
        for c, i, name in cells
    ]
    near = rows.filter(" OR ".join(inside.values())).select(
        *keys, F.expr(f"explode(array({', '.join(entries)}))").alias("e")
    )
    flat = near.select(*keys, "e.*").filter(F.col("value").isNotNull())
    run = running_totals(flat, "value", {"n": ("sum", F.lit(1))}, [*keys, "column", "name"])
    start = {(*[r[k] for k in keys], c, name): r[f"{c}__{name}"] for r in below.collect() for c, _, name in cells}
    sizes = {tuple(r[k] for k in keys): r for r in groups}
    targets = []
    for key, r in sizes.items():
        for c, _, name in cells:
            n, first = r[f"n__{c}"], start.get((*key, c, name), 0)
            position = (n - 1) * float(probabilities[name])
            targets.append((*key, c, name, math.floor(position) - first, math.ceil(position) - first))
    schema = T.StructType(
        [df.schema[k] for k in keys]
        + [T.StructField(n, T.StringType()) for n in ("column", "name")]
        + [T.StructField(n, T.LongType()) for n in ("lo", "hi")]
    )
    # one row per group, column and probability: as bounded as the groups are
    wanted = spark.createDataFrame(targets, schema).select(
        *[F.col(k).alias(f"__k_{k}") for k in keys], F.col("column").alias("__c"), F.col("name").alias("__n"), "lo", "hi"
    )
    same = reduce(
        lambda a, b: a & b,
        [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys],
        (F.col("column") == F.col("__c")) & (F.col("name") == F.col("__n")),
    )
    picks = (
        run.join(F.broadcast(wanted), same)
        .groupBy(*keys, "column", "name")
        .agg(
            F.min(F.when(F.col("cum_n") > F.col("lo"), F.col("value"))).alias("at_lo"),
            F.min(F.when(F.col("cum_n") > F.col("hi"), F.col("value"))).alias("at_hi"),
            F.first("lo").alias("lo"),
        )
        .collect()
    )
    at = {(*[r[k] for k in keys], r["column"], r["name"]): r for r in picks}
    table = []
    for key, r in sizes.items():
        for c in columns:
            values = []
            for name, p in probabilities.items():
                n, hit = r[f"n__{c}"], at.get((*key, c, name))
                if n == 0:
                    values.append(None)
                    continue
                if hit is None or hit["lo"] < 0 or hit["at_lo"] is None or hit["at_hi"] is None:
                    return None
                position = (n - 1) * float(p)
                part = position - math.floor(position)
                values.append(hit["at_lo"] + part * (hit["at_hi"] - hit["at_lo"]))
            table.append((*key, c, *values))
    fields = [df.schema[k] for k in keys] + [T.StructField("column", T.StringType())]
    fields += [T.StructField(n, T.DoubleType()) for n in probabilities]
    return spark.createDataFrame(table, T.StructType(fields))


def _ranked_quantiles(
    df: DataFrame, columns: list[str], probabilities: Mapping[str, float], keys: list[str], partitions: int | None
) -> DataFrame:
    """Quantiles from the ranks of all distinct values."""
    names = list(probabilities)
    long = df.unpivot(keys, list(columns), "column", "value")
    ranks = running_totals(
        long.filter(F.col("value").isNotNull()),
        "value",
        {"n": ("sum", F.lit(1))},
        [*keys, "column"],
        partitions=partitions,
    )
    picks = []
    for name, p in probabilities.items():
        position = (F.col("tot_n") - 1) * F.lit(float(p))
        for side, rank in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            picks.append(F.min(F.when(F.col("cum_n") > rank, F.col("value"))).alias(f"__{side}_{name}"))
    found = ranks.groupBy(*keys, "column").agg(F.max("tot_n").alias("__n"), *picks)
    result = [
        (
            F.col(f"__lo_{name}")
            + ((F.col("__n") - 1) * F.lit(float(p)) - F.floor((F.col("__n") - 1) * F.lit(float(p))))
            * (F.col(f"__hi_{name}") - F.col(f"__lo_{name}"))
        ).alias(name)
        for name, p in probabilities.items()
    ]
    every = df.select(*keys).distinct() if keys else df.sparkSession.range(1)
    every = every.select(*keys, F.explode(F.array(*[F.lit(c) for c in columns])).alias("column"))
    # an all-null column keeps its row, as in the one-pass plan
    renamed = found.select(*[F.col(k).alias(f"__k_{k}") for k in keys], F.col("column").alias("__k_column"), *result)
    same = reduce(
        lambda a, b: a & b,
        [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys],
        F.col("column") == F.col("__k_column"),
    )
    return every.join(renamed, same, "left").select(*keys, "column", *names)


def row_digest(df: DataFrame, seed: int, key: Sequence[str] | None = None) -> Column:
    """A reproducible pseudo-random hex string per row, from its key (or from all its columns).

    Fields are joined by ``|``; within texts, ``|`` and backslashes are escaped, so that different rows never join alike.
    """
    names = list(key) if key else df.columns
    texts = set(columns_of(df, T.StringType))
    parts = []
    for c in names:
        text = F.col(f"`{c}`").cast("string")
        if c in texts or isinstance(df.schema[c].dataType, (T.ArrayType, T.MapType, T.StructType)):
            text = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))
        parts.append(F.coalesce(text, F.lit("\\N")))
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def digest_cuts(df: DataFrame, digest: str, wanted: Column, keys: Sequence[str] = ()) -> DataFrame:
    """Per key, the digest that separates the first ``wanted`` rows (in digest order) from the rest.

    ``wanted`` is an expression over ``n``, the row count of the key. Two counting passes: the first
    over 4-digit prefixes finds the prefix holding the cut, the second looks only at that 1/65536 of
    the rows. Equal digests (copies of a row) always stay on one side. Columns: keys, ``cut``.
    """
    keys = list(keys)
    by_prefix = df.groupBy(*keys, F.substring(digest, 1, 4).alias("__prefix")).agg(F.count(F.lit(1)).alias("__c"))
    run = Window.partitionBy(*keys).orderBy("__prefix").rowsBetween(Window.unboundedPreceding, 0)
    ranked = by_prefix.select(
        *keys,
        "__prefix",
        (F.sum("__c").over(run) - F.col("__c")).alias("__before"),
        F.sum("__c").over(run).alias("__upto"),
        F.sum("__c").over(Window.partitionBy(*keys)).alias("n"),
    ).withColumn("__want", wanted)
    prefix = lookup_side(
        ranked.filter((F.col("__before") < F.col("__want")) & (F.col("__upto") >= F.col("__want"))).select(
            *[F.col(k).alias(f"__k_{k}") for k in keys],
            F.col("__prefix").alias("__k_prefix"),
            (F.col("__want") - F.col("__before")).alias("__left"),
        )
    )
    same = reduce(
        lambda a, b: a & b,
        [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys],
        F.substring(digest, 1, 4) == F.col("__k_prefix"),
    )
    near = df.join(prefix, same).groupBy(*keys, digest, "__left").agg(F.count(F.lit(1)).alias("__c"))
    run = Window.partitionBy(*keys).orderBy(digest).rowsBetween(Window.unboundedPreceding, 0)
    reached = near.withColumn("__upto", F.sum("__c").over(run))
    return (
        reached.filter(F.col("__upto") - F.col("__c") < F.col("__left"))
        .groupBy(*keys)
        .agg(F.max(digest).alias("cut"))
    )


def dense_codes(df: DataFrame, column: str, name: str = "code", partitions: int | None = None) -> DataFrame:
    """Codes 0..n-1 of the distinct non-null values in ascending order: columns (column, name)."""
    values = df.select(column).filter(F.col(column).isNotNull()).distinct()
    ranks = running_totals(values, column, {"n": ("sum", F.lit(1))}, partitions=partitions)
    return ranks.select(column, (F.col("cum_n") - 1).cast("long").alias(name))


def row_index(
    df: DataFrame, key: Sequence[str], name: str = "row_index", seed: int = 0, partitions: int | None = None
) -> DataFrame:
    """Dense 0-based index in digest order of ``key``.

    Copies of a row are counted first and laid out afterwards in chunks, so that no task has to
    sort or expand all of them.
    """
    digest = F.concat(row_digest(df, seed, key), row_digest(df, seed))
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__copies")).withColumn("__digest", digest)
    starts = running_totals(
        counted.select("__digest", "__copies"), "__digest", {"n": ("sum", F.col("__copies"))}, partitions=partitions
    ).select("__digest", (F.col("cum_n") - F.col("n")).alias("__start"))
    size = 100_000
    chunk = F.explode(F.sequence(F.lit(0), ((F.col("__copies") - 1) / size).cast("int")))
    chunks = counted.join(starts, "__digest").withColumn("__chunk", chunk).repartition("__digest", "__chunk")
    first = (F.col("__chunk") * size).cast("long")
    last = F.least(first + size, F.col("__copies")) - 1
    return chunks.withColumn("__copy", F.explode(F.sequence(first, last))).select(
        *df.columns, (F.col("__start") + F.col("__copy")).alias(name)
    )
