"""Queries on statistics, profiling, charts and guarded SQL."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, functions as F

from tabkit.catalog.registry import Tables, query
from tabkit.operators import charts, profiling, relational, sqltool, stats

_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _summary_sql(table: str, c: str, where: str = "") -> str:
    return f"""SELECT '{c}' AS "column", count({c}) AS count, count(*) - count({c}) AS missing,
        round(avg({c}), 4) AS mean, round(median({c}), 4) AS median, round(stddev_samp({c}), 4) AS std,
        round(min({c}), 4)::DOUBLE AS min, round(max({c}), 4)::DOUBLE AS max,
        round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.75), 4) AS q75 FROM {table} {where}"""


# --- statistics -------------------------------------------------------------------------------


@query(
    "stat_describe_numeric",
    "WITH x AS (SELECT nullif(l_tax, 0) AS l_tax FROM lineitem) "
    + _summary_sql("x", "l_tax").replace(" FROM x", ", NULL::VARCHAR AS error FROM x"),
)
def _(t: Tables) -> DataFrame:
    return stats.describe_column(t.lineitem.select(F.nullif("l_tax", F.lit(0.0)).alias("l_tax")), "l_tax")


@query(
    "stat_describe_categorical",
    """WITH x AS (SELECT nullif(p_brand, 'Brand#7') AS v FROM part),
       c AS (SELECT v AS value, count(*) AS count FROM x WHERE v IS NOT NULL GROUP BY v)
       SELECT value, count, round(100 * count / (SELECT count(v) FROM x), 2) AS pct,
              (SELECT count(v) FROM x) AS total, (SELECT count(*) - count(v) FROM x) AS missing,
              (SELECT count(*) FROM c) AS n_unique
       FROM c ORDER BY count DESC, value LIMIT 20""",
)
def _(t: Tables) -> DataFrame:
    return stats.describe_column(t.part.select(F.nullif("p_brand", F.lit("Brand#7")).alias("p_brand")), "p_brand")


@query("stat_describe_frame", " UNION ALL ".join(_summary_sql("lineitem", c) for c in _NUM))
def _(t: Tables) -> DataFrame:
    s = stats.describe_frame(t.lineitem, _NUM)
    rounded = [F.round(f, 4).alias(f) for f in ("mean", "median", "std", "min", "max", "q25", "q75")]
    return s.select("column", "count", "missing", *rounded)


_AGG_SQL = {
    "mean": "round(avg(l_extendedprice), 4)",
    "median": "round(median(l_extendedprice), 4)",
    "std": "round(stddev_samp(l_extendedprice), 4)",
    "min": "round(min(l_extendedprice), 4)",
    "max": "round(max(l_extendedprice), 4)",
    "count": "count(l_extendedprice)",
    "sum": "round(sum(l_extendedprice), 2)",
}


def _group_query(agg: str) -> None:
    @query(
        f"stat_group_{agg}",
        f"""SELECT l_returnflag, {_AGG_SQL[agg]} AS value, count(*) AS group_size FROM lineitem
            WHERE l_returnflag IS NOT NULL AND l_extendedprice IS NOT NULL GROUP BY l_returnflag""",
    )
    def _(t: Tables) -> DataFrame:
        out = stats.group_statistics(t.lineitem, "l_returnflag", "l_extendedprice", agg)
        return out.withColumn("value", F.round("value", 2)) if agg == "sum" else out


for _agg in stats.AGGREGATES:
    _group_query(_agg)


def _rates_sql(table: str, g: str, v: str, digits: int) -> str:
    return f"""SELECT g.{g}, v.{v}, count(x.{v}) AS n, any_value(g.group_size) AS group_size,
        round((100 * count(x.{v}) / any_value(g.group_size))::DECIMAL(18, 9), {digits})::DOUBLE AS pct
      FROM (SELECT {g}, count(*) AS group_size FROM {table} GROUP BY 1) g
      CROSS JOIN (SELECT DISTINCT {v} FROM {table}) v
      LEFT JOIN {table} x ON x.{g} = g.{g} AND x.{v} = v.{v} GROUP BY 1, 2"""


@query("stat_group_rate", _rates_sql("lineitem", "l_linestatus", "l_returnflag", 2))
def _(t: Tables) -> DataFrame:
    return stats.group_statistics(t.lineitem, "l_linestatus", "l_returnflag")


def _corr_sql(pairs: list[tuple[str, str]], digits: int, table: str = "lineitem") -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS column_1, '{b}' AS column_2, round(corr({a}, {b}), {digits}) AS r FROM {table}"
        for a, b in pairs
    )


_ALL_PAIRS = [(a, b) for a in _NUM for b in _NUM if a != b]
_DIAGONAL = " UNION ALL ".join(f"SELECT '{c}', '{c}', 1.0::DOUBLE" for c in _NUM)


@query("stat_corr_matrix", _corr_sql(_ALL_PAIRS, 4) + " UNION ALL " + _DIAGONAL)
def _(t: Tables) -> DataFrame:
    return stats.correlation_matrix(t.lineitem, _NUM)


@query(
    "stat_corr_target",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(corr({c}, l_extendedprice), 4) AS r FROM lineitem"
        for c in ("l_quantity", "l_discount", "l_tax", "l_linenumber")
    ),
)
def _(t: Tables) -> DataFrame:
    names = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
    return stats.correlation_with_target(t.lineitem, "l_extendedprice", names)


@query("stat_corr_lower", _corr_sql([(b, a) for a, b in combinations(_NUM, 2)], 4))
def _(t: Tables) -> DataFrame:
    return stats.correlation_lower(t.lineitem, _NUM)


@query(
    "stat_corr_compare",
    " UNION ALL ".join(
        f"""SELECT '{a}' AS column_1, '{b}' AS column_2,
            round(corr({a}, {b}) FILTER (l_returnflag = 'R'), 4) AS r_left,
            round(corr({a}, {b}) FILTER (l_returnflag <> 'R'), 4) AS r_right,
            round(corr({a}, {b}) FILTER (l_returnflag <> 'R') - corr({a}, {b}) FILTER (l_returnflag = 'R'), 4)
              AS difference FROM lineitem"""
        for a, b in combinations(_NUM, 2)
    ),
)
def _(t: Tables) -> DataFrame:
    rows = t.lineitem
    return stats.correlation_compare(
        rows.filter("l_returnflag = 'R'"), rows.filter("l_returnflag <> 'R'"), _NUM
    )


@query(
    "stat_vif",
    """SELECT unnest(['l_quantity', 'l_extendedprice']) AS feature,
              round(1 / (1 - corr(l_quantity, l_extendedprice) ** 2), 4) AS vif FROM lineitem""",
)
def _(t: Tables) -> DataFrame:
    return stats.variance_inflation(t.lineitem, ["l_quantity", "l_extendedprice"])


@query(
    "agg_mean_sorted",
    """SELECT o_orderpriority, round(avg(o_totalprice), 4) AS mean, count(*) AS n FROM orders
       GROUP BY o_orderpriority ORDER BY mean DESC""",
)
def _(t: Tables) -> DataFrame:
    return stats.mean_by_group(t.orders, "o_orderpriority", "o_totalprice")


@query(
    "agg_count_keys",
    """SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2
       UNION ALL SELECT l_returnflag, NULL, count(*) FROM lineitem GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    two = stats.count_by(t.lineitem, "l_returnflag", "l_linestatus")
    return two.unionByName(stats.count_by(t.lineitem, "l_returnflag"), allowMissingColumns=True)


@query(
    "agg_class_balance",
    """SELECT o_orderstatus, count(*) AS n, round(count(*) / (SELECT count(*) FROM orders), 6) AS share
       FROM orders GROUP BY o_orderstatus""",
)
def _(t: Tables) -> DataFrame:
    return stats.class_balance(t.orders, "o_orderstatus")


@query(
    "agg_pos_weight",
    """SELECT count(*) FILTER (toxic = 1) AS n_pos, count(*) FILTER (toxic <> 1) AS n_neg,
              round(count(*) FILTER (toxic <> 1) / count(*) FILTER (toxic = 1), 6) AS pos_weight FROM labels""",
)
def _(t: Tables) -> DataFrame:
    return stats.positive_weight(t.labels, F.col("toxic") == 1)


@query(
    "agg_distinct",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM lineitem"
        for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate")
    ),
)
def _(t: Tables) -> DataFrame:
    return stats.distinct_counts(t.lineitem, "l_orderkey", "l_partkey", "l_suppkey", "l_shipdate")


@query("agg_distinct_pairs", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def _(t: Tables) -> DataFrame:
    return stats.distinct_values(t.lineitem, "l_returnflag", "l_linestatus")


@query(
    "win_best_so_far",
    """SELECT user_id, event_id, value, min(value) OVER (PARTITION BY user_id ORDER BY event_id) AS best_so_far
       FROM events""",
)
def _(t: Tables) -> DataFrame:
    return relational.best_so_far(t.events, "event_id", "value", ["user_id"])


# --- profiling --------------------------------------------------------------------------------

_PROFILED = {"orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]}
_NUMBERS = {"o_orderkey", "o_custkey", "o_totalprice"}
_TYPES_SQL = "SELECT *, round(unique_count / n_rows, 4) AS cardinality_ratio FROM (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS name, count(*) AS n_rows, count(*) - count({c}) AS missing_count,
        count(DISTINCT {c}) AS unique_count, CASE """
    + (
        "WHEN true THEN 'datetime'"
        if c == "o_orderdate"
        else f"WHEN count(DISTINCT {c}) <= 20 AND count(DISTINCT {c}) / count(*) <= 0.05 THEN 'categorical' ELSE 'numeric'"
        if c in _NUMBERS
        else f"WHEN count(DISTINCT {c}) / count(*) > 0.5 AND count(DISTINCT {c}) > 50 THEN 'text' ELSE 'categorical'"
    )
    + " END AS column_type FROM orders"
    for c in _PROFILED["orders"]
) + ")"

#: A column of dates in four spellings.
_SPELLED_SQL = """SELECT *, round(unique_count / n_rows, 4) AS cardinality_ratio FROM (SELECT 'spelled' AS name, count(*) AS n_rows, 0::BIGINT AS missing_count,
    count(DISTINCT CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%d.%m.%Y')
      WHEN 2 THEN strftime(o_orderdate, '%B %-d, %Y') ELSE strftime(o_orderdate, '%-m/%-d/%Y 3:15 PM') END) AS unique_count, 'datetime' AS column_type FROM orders)"""


@query("prof_types", f"{_TYPES_SQL} UNION ALL {_SPELLED_SQL}")
def _(t: Tables) -> DataFrame:
    spellings = ["yyyy-MM-dd", "dd.MM.yyyy", "MMMM d, yyyy", "M/d/yyyy '3:15 PM'"]
    spelled = F.coalesce(*[F.when(F.col("o_orderkey") % 4 == i, F.date_format("o_orderdate", p)) for i, p in enumerate(spellings)])
    types = profiling.column_types(t.orders.withColumn("spelled", spelled), ["o_orderkey"])
    return types.select("name", "n_rows", "missing_count", "unique_count", "cardinality_ratio", "column_type")


@query(
    "prof_numeric",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
            min({c}) AS min, round(quantile_cont({c}, 0.25), 4) AS p25, round(median({c}), 4) AS median,
            round(quantile_cont({c}, 0.75), 4) AS p75, max({c}) AS max FROM lineitem"""
        for c in _NUM
    ),
)
def _(t: Tables) -> DataFrame:
    return profiling.numeric_profile(t.lineitem, _NUM)


@query(
    "prof_top_categories",
    " UNION ALL ".join(
        f"""SELECT * FROM (SELECT '{c}' AS "column", row_number() OVER (ORDER BY count(*) DESC, {c}::VARCHAR)::INT AS rank,
            {c}::VARCHAR AS value, count(*) AS count FROM part GROUP BY {c}) WHERE rank <= 10"""
        for c in ("p_brand", "p_type", "p_size")
    ),
)
def _(t: Tables) -> DataFrame:
    return profiling.top_categories(t.part, ["p_brand", "p_type", "p_size"])


@query(
    "prof_samples",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", (SELECT string_agg({c}::VARCHAR, '|' ORDER BY p_partkey)
            FROM (SELECT * FROM part ORDER BY p_partkey LIMIT 3)) AS samples"""
        for c in ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    ),
)
def _(t: Tables) -> DataFrame:
    samples = profiling.sample_values(t.part, 3, ["p_partkey"])
    return samples.select("column", F.array_join("sample_values", "|").alias("samples"))


@query(
    "prof_columns",
    f"""WITH p AS ({_TYPES_SQL}),
        n AS ({" UNION ALL ".join(
            f"SELECT '{c}' AS name, round(avg({c}), 4) AS mean, round(median({c}), 4) AS median FROM orders"
            for c in ("o_orderkey", "o_custkey", "o_totalprice"))}),
        k AS ({" UNION ALL ".join(
            f"SELECT '{c}' AS name, max(n) AS top_count FROM (SELECT count(*) AS n FROM orders GROUP BY {c})"
            for c in ("o_orderstatus", "o_orderpriority"))})
        SELECT p.name, p.column_type, p.missing_count, 0.0::DOUBLE AS missing_pct, p.unique_count, p.cardinality_ratio,
               n.mean, n.median, k.top_count
        FROM p LEFT JOIN n USING (name) LEFT JOIN k USING (name)""",
)
def _(t: Tables) -> DataFrame:
    profile = profiling.profile_columns(t.orders, ["o_orderkey"])
    return profile.select(
        "name",
        "column_type",
        "missing_count",
        "missing_pct",
        "unique_count",
        "cardinality_ratio",
        F.col("numeric_summary")["mean"].alias("mean"),
        F.col("numeric_summary")["median"].alias("median"),
        F.array_max(F.map_values("top_categories")).alias("top_count"),
    )


@query(
    "prof_targets",
    f"WITH p AS ({_TYPES_SQL}) SELECT name FROM p WHERE column_type IN ('categorical', 'boolean') AND unique_count <= 10",
)
def _(t: Tables) -> DataFrame:
    spellings = ["yyyy-MM-dd", "dd.MM.yyyy", "MMMM d, yyyy", "M/d/yyyy '3:15 PM'"]
    spelled = F.coalesce(*[F.when(F.col("o_orderkey") % 4 == i, F.date_format("o_orderdate", p)) for i, p in enumerate(spellings)])
    types = profiling.column_types(t.orders.withColumn("spelled", spelled), ["o_orderkey"])
    return profiling.possible_targets(t.orders, types).select("name")


_NAMES_SQL = """(SELECT coalesce(string_agg(name, ',' ORDER BY pos), '') FROM q WHERE column_type = '{k}')"""


@query(
    "prof_dataset",
    f"""WITH p AS ({_TYPES_SQL}),
        q AS (SELECT *, list_position({_PROFILED["orders"]}, name) AS pos FROM p)
        SELECT (SELECT max(n_rows) FROM q) AS n_rows, (SELECT count(*) FROM q) AS n_columns,
               (SELECT count(*) - count(DISTINCT o_orderkey) FROM orders) AS duplicate_row_count,
               {_NAMES_SQL.format(k="numeric")} AS numeric_columns,
               {_NAMES_SQL.format(k="categorical")} AS categorical_columns,
               {_NAMES_SQL.format(k="datetime")} AS datetime_columns,
               (SELECT string_agg(name, ',' ORDER BY pos) FROM q
                WHERE column_type IN ('categorical', 'boolean') AND unique_count <= 10) AS possible_target_columns""",
)
def _(t: Tables) -> DataFrame:
    lists = ("numeric_columns", "categorical_columns", "datetime_columns", "possible_target_columns")
    return profiling.profile_dataset(t.orders, ["o_orderkey"]).select(
        "n_rows", "n_columns", "duplicate_row_count", *[F.array_join(c, ",").alias(c) for c in lists]
    )


@query("prof_summary_text")
def _(t: Tables) -> DataFrame:
    return profiling.profile_text(t.lineitem)


@query(
    "prof_type_breakdown",
    f"WITH p AS ({_TYPES_SQL}) SELECT column_type, count(*) AS n_columns FROM p GROUP BY column_type",
)
def _(t: Tables) -> DataFrame:
    return profiling.type_breakdown(profiling.column_types(t.orders, ["o_orderkey"]))


# --- charts -----------------------------------------------------------------------------------


def _hist_sql(table: str, v: str, bins: int, color: str | None) -> str:
    c = f"{color}, " if color else ""
    return f"""WITH x AS (SELECT {c}{v} AS v FROM {table}), s AS (SELECT min(v) AS lo, max(v) AS hi FROM x),
        b AS (SELECT {c}least(floor((v - lo) / (hi - lo) * {bins}), {bins - 1})::INT AS bin, lo, hi FROM x, s)
        SELECT {c}bin, round(any_value(lo) + bin * ((any_value(hi) - any_value(lo)) / {bins}), 6) AS "left",
               round(any_value(lo) + (bin + 1) * ((any_value(hi) - any_value(lo)) / {bins}), 6) AS "right",
               count(*) AS n FROM b GROUP BY {c}bin"""


@query("viz_histogram", _hist_sql("lineitem", "l_extendedprice", 30, "l_returnflag"))
def _(t: Tables) -> DataFrame:
    return charts.chart_data(t.lineitem, "histogram", column="l_extendedprice", color_by="l_returnflag")


@query("viz_hist_clipped", _hist_sql("orders", "least(o_totalprice, 100000.0)", 50, "o_orderstatus"))
def _(t: Tables) -> DataFrame:
    return charts.histogram(t.orders, "o_totalprice", "o_orderstatus", bins=50, clip_upper=100_000)


@query(
    "viz_box",
    """WITH x AS (SELECT l_returnflag, l_extendedprice * l_quantity AS v FROM lineitem),
       q AS (SELECT l_returnflag, quantile_cont(v, 0.25) AS q25, median(v) AS median, quantile_cont(v, 0.75) AS q75
             FROM x GROUP BY 1),
       f AS (SELECT *, q25 - 1.5 * (q75 - q25) AS lo, q75 + 1.5 * (q75 - q25) AS hi FROM q)
       SELECT l_returnflag, count(*) AS n, round(any_value(q25), 4) AS q25, round(any_value(median), 4) AS median,
              round(any_value(q75), 4) AS q75, round(min(v) FILTER (v BETWEEN lo AND hi), 4) AS whisker_low,
              round(max(v) FILTER (v BETWEEN lo AND hi), 4) AS whisker_high,
              count(*) FILTER (v < lo OR v > hi) AS n_outliers
       FROM x JOIN f USING (l_returnflag) GROUP BY l_returnflag""",
)
def _(t: Tables) -> DataFrame:
    v = (F.col("l_extendedprice") * F.col("l_quantity")).alias("v")
    return charts.box(t.lineitem.select("l_returnflag", v), "v", "l_returnflag")


@query(
    "viz_scatter_grid",
    """WITH s AS (SELECT min(l_quantity) AS xlo, max(l_quantity) AS xhi, min(l_extendedprice) AS ylo,
                         max(l_extendedprice) AS yhi FROM lineitem)
       SELECT l_returnflag, least(floor((l_quantity - xlo) / (xhi - xlo) * 50), 49)::INT AS x_cell,
              least(floor((l_extendedprice - ylo) / (yhi - ylo) * 50), 49)::INT AS y_cell, count(*) AS n
       FROM lineitem, s GROUP BY 1, 2, 3""",
)
def _(t: Tables) -> DataFrame:
    return charts.chart_data(t.lineitem, "scatter_grid", x="l_quantity", y="l_extendedprice", color_by="l_returnflag")


@query("viz_bar_count", "SELECT p_type, count(*) AS count FROM part GROUP BY p_type")
def _(t: Tables) -> DataFrame:
    return charts.bar(t.part, "p_type")


@query("viz_bar_agg", "SELECT p_brand, round(median(p_retailprice), 4) AS p_retailprice FROM part GROUP BY p_brand")
def _(t: Tables) -> DataFrame:
    return charts.bar(t.part, "p_brand", "p_retailprice", "median")


@query(
    "viz_scatter",
    "SELECT l_quantity, l_extendedprice, l_returnflag FROM lineitem",
)
def _(t: Tables) -> DataFrame:
    return charts.chart_data(t.lineitem, "scatter", x="l_quantity", y="l_extendedprice", color_by="l_returnflag")


@query(
    "viz_line",
    """SELECT o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') AS x, o_totalprice AS y FROM orders""",
)
def _(t: Tables) -> DataFrame:
    return charts.line(t.orders, "o_orderdate", "o_totalprice", "o_orderstatus").withColumn("x", F.date_format("x", "yyyy-MM-dd"))


@query(
    "viz_line_buckets",
    """WITH x AS (SELECT o_orderstatus, epoch_us(o_orderdate)::DOUBLE AS p, strftime(o_orderdate, '%Y-%m-%d') AS d,
                         sqrt(o_totalprice) AS y FROM orders), s AS (SELECT min(p) AS lo, max(p) AS hi FROM x)
       SELECT o_orderstatus, min(d) AS x, max(d) AS x_last, round(avg(y), 6) AS y, count(*) AS n
       FROM x, s GROUP BY o_orderstatus, least(floor((p - lo) / (hi - lo) * 200), 199)""",
)
def _(t: Tables) -> DataFrame:
    rows = t.orders.withColumn("root_price", F.sqrt("o_totalprice"))
    out = charts.line_buckets(rows, "o_orderdate", "root_price", "o_orderstatus")
    return out.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("x", "x_last")})


@query("viz_corr_heatmap", _corr_sql(_ALL_PAIRS, 3) + " UNION ALL " + _DIAGONAL)
def _(t: Tables) -> DataFrame:
    return charts.correlation_heatmap(t.lineitem, _NUM)


@query(
    "viz_category_comparison",
    f"SELECT c_mktsegment, region, pct AS percent FROM ({_rates_sql('x', 'c_mktsegment', 'region', 4)})".replace(
        "FROM (SELECT g.",
        "FROM (WITH x AS (SELECT c_mktsegment, r_name AS region FROM customer JOIN nation ON c_nationkey = n_nationkey "
        "JOIN region ON n_regionkey = r_regionkey) SELECT g.",
    ),
)
def _(t: Tables) -> DataFrame:
    nations = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    rows = t.customer.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_mktsegment", F.col("r_name").alias("region")
    )
    return charts.category_comparison(rows, "c_mktsegment", "region")


@query(
    "viz_density",
    f"""WITH h AS ({_hist_sql("lineitem", "l_extendedprice", 30, "l_returnflag")})
        SELECT l_returnflag, bin, "left", "right",
               round(n / (sum(n) OVER (PARTITION BY l_returnflag) * ("right" - "left")), 6) AS density FROM h""",
)
def _(t: Tables) -> DataFrame:
    return charts.density(t.lineitem, "l_extendedprice", "l_returnflag")


# --- guarded SQL ------------------------------------------------------------------------------

_SQL = """SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS quantity
          FROM {view} WHERE l_discount > 0.02 GROUP BY l_returnflag, l_linestatus"""


@query("sql_guarded", _SQL.format(view="lineitem"))
def _(t: Tables) -> DataFrame:
    return sqltool.run_sql(t.lineitem, _SQL.format(view="dataset")).rows
