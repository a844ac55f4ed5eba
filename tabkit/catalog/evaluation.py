"""Queries on feature preparation, splits, metrics and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tabkit.catalog.registry import Tables, query
from tabkit.operators import charts, features, metrics, relational

_LINE = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
         "l_returnflag", "l_linestatus", "l_shipdate"]
_ORDERS = ["o_orderkey"]


def _digest(columns: list[str], seed: int) -> str:
    return f"md5(concat_ws('|', '{seed}', " + ", ".join(f"{c}::VARCHAR" for c in columns) + "))"


# --- feature preparation ----------------------------------------------------------------------


@query(
    "fe_impute_median",
    """WITH x AS (SELECT l_orderkey, l_linenumber, nullif(l_tax, 0) AS l_tax, nullif(l_discount, 0) AS l_discount
                  FROM lineitem)
       SELECT l_orderkey, l_linenumber, coalesce(l_tax, (SELECT median(l_tax) FROM x)) AS l_tax,
              coalesce(l_discount, (SELECT median(l_discount) FROM x)) AS l_discount, 0.0::DOUBLE AS nothing FROM x""",
)
def _(t: Tables) -> DataFrame:
    rows = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.nullif("l_tax", F.lit(0.0)).alias("l_tax"),
        F.nullif("l_discount", F.lit(0.0)).alias("l_discount"),
        F.lit(None).cast("double").alias("nothing"),
    )
    return features.impute_median(rows, ["l_tax", "l_discount", "nothing"])


@query(
    "fe_impute_category",
    """SELECT doc_id, coalesce(CASE WHEN toxic = 1 THEN NULL ELSE quality::VARCHAR END, 'missing') AS quality
       FROM documents LEFT JOIN labels USING (doc_id)""",
)
def _(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    quality = F.when(F.coalesce("toxic", F.lit(1)) != 1, F.col("quality"))
    return features.impute_category(rows.select("doc_id", quality.alias("quality")), ["quality"])


@query(
    "fe_label_encode",
    """WITH b AS (SELECT p_brand, dense_rank() OVER (ORDER BY p_brand) - 1 AS code FROM (SELECT DISTINCT p_brand FROM part)),
       n AS (SELECT p_name, dense_rank() OVER (ORDER BY p_name) - 1 AS code FROM (SELECT DISTINCT p_name FROM part))
       SELECT p_partkey, b.code AS p_brand, n.code AS p_name
       FROM part JOIN b USING (p_brand) JOIN n USING (p_name)""",
)
def _(t: Tables) -> DataFrame:
    return features.label_encode(t.part.select("p_partkey", "p_brand", "p_name"), ["p_brand", "p_name"])


@query(
    "fe_ordinal_map",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 5 WHEN '2-HIGH' THEN 4 WHEN '3-MEDIUM' THEN 3
              WHEN '5-LOW' THEN 1 END AS priority FROM orders""",
)
def _(t: Tables) -> DataFrame:
    scale = {"1-URGENT": 5, "2-HIGH": 4, "3-MEDIUM": 3, "5-LOW": 1}
    return t.orders.select("o_orderkey", features.ordinal("o_orderpriority", scale).alias("priority"))


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query(
    "fe_one_hot",
    "SELECT c_custkey, "
    + ", ".join(f"(c_mktsegment = '{s}')::TINYINT AS c_mktsegment_{s}" for s in _SEGMENTS)
    + " FROM customer",
)
def _(t: Tables) -> DataFrame:
    return features.one_hot(t.customer.select("c_custkey", "c_mktsegment"), ["c_mktsegment"])


@query(
    "fe_select_usable",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", "
        + ("bool_or(true)" if c in ("p_partkey", "p_size") else f"count(DISTINCT {c}) <= 20")
        + " AS usable FROM part"
        for c in ("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    ),
)
def _(t: Tables) -> DataFrame:
    return features.feature_choice(t.part, "p_retailprice")


@query(
    "fe_problem_type",
    """SELECT 'l_linenumber' AS target, count(DISTINCT l_linenumber) AS n_unique, count(*) AS n_rows,
         CASE WHEN count(DISTINCT l_linenumber) <= 10 AND count(DISTINCT l_linenumber) / count(*) < 0.05
              THEN 'classification' ELSE 'regression' END AS problem_type FROM lineitem
       UNION ALL SELECT 'l_tax', count(DISTINCT l_tax), count(*),
         CASE WHEN count(DISTINCT l_tax) <= 10 AND count(DISTINCT l_tax) / count(*) < 0.05
              THEN 'classification' ELSE 'regression' END FROM lineitem
       UNION ALL SELECT 'l_returnflag', count(DISTINCT l_returnflag), count(*), 'classification' FROM lineitem
       UNION ALL SELECT 'l_extendedprice', count(DISTINCT l_extendedprice), count(*),
         CASE WHEN count(DISTINCT l_extendedprice) <= 10 THEN 'classification' ELSE 'regression' END FROM lineitem""",
)
def _(t: Tables) -> DataFrame:
    kinds = [features.problem_type(t.lineitem, c) for c in ("l_linenumber", "l_tax", "l_returnflag", "l_extendedprice")]
    return kinds[0].unionByName(kinds[1]).unionByName(kinds[2]).unionByName(kinds[3])


def _split_sql(table: str, columns: list[str], seed: int, size: float, by: str = "", show: str = "") -> str:
    part = f"PARTITION BY {by} " if by else ""
    count = f"PARTITION BY {by}" if by else ""
    return f"""SELECT {show}, CASE WHEN rank() OVER ({part}ORDER BY {_digest(columns, seed)})
          <= ceil(count(*) OVER ({count}) * {size}::DOUBLE) THEN 'test' ELSE 'train' END AS split FROM {table}"""


@query("fe_split_stratified", _split_sql("orders", _ORDERS, 42, 0.25, "o_orderstatus", "o_orderkey, o_orderstatus"))
def _(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    return features.split_random(rows, 0.25, 42, ["o_orderkey"], stratify="o_orderstatus")


@query("fe_split_random", _split_sql("lineitem", _LINE, 42, 0.2, show="l_orderkey, l_partkey, l_extendedprice"))
def _(t: Tables) -> DataFrame:
    split = features.split_random(t.lineitem, 0.2, 42)
    return split.select("l_orderkey", "l_partkey", "l_extendedprice", "split")


@query(
    "fe_split_validation",
    f"""WITH a AS ({_split_sql("orders", _ORDERS, 42, 0.2, show="o_orderkey")}),
        b AS ({_split_sql("(SELECT o_orderkey FROM a WHERE split = 'train')", _ORDERS, 43, 0.15, show="o_orderkey")})
        SELECT a.o_orderkey, CASE WHEN a.split = 'test' THEN 'test' WHEN b.split = 'test' THEN 'validation'
               ELSE 'train' END AS split FROM a LEFT JOIN b USING (o_orderkey)""",
)
def _(t: Tables) -> DataFrame:
    first = features.split_random(t.orders.select("o_orderkey"), 0.2, 42, ["o_orderkey"])
    return features.carve_validation(first, 0.15, 43, ["o_orderkey"])


@query(
    "fe_split_time",
    f"""SELECT l_orderkey, l_partkey, l_extendedprice,
          CASE WHEN row_number() OVER (ORDER BY l_shipdate, {_digest(_LINE, 0)})
            <= floor(count(*) OVER () * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split FROM lineitem""",
)
def _(t: Tables) -> DataFrame:
    split = features.split_time(t.lineitem, "l_shipdate", 0.2)
    return split.select("l_orderkey", "l_partkey", "l_extendedprice", "split")


@query(
    "fe_standardize",
    f"""WITH s AS ({_split_sql("orders", _ORDERS, 42, 0.2, show="o_orderkey, o_totalprice")})
        SELECT o_orderkey, split, round((o_totalprice - (SELECT avg(o_totalprice) FROM s WHERE split = 'train'))
               / (SELECT stddev_pop(o_totalprice) FROM s WHERE split = 'train'), 6) AS o_totalprice FROM s""",
)
def _(t: Tables) -> DataFrame:
    rows = features.split_random(t.orders.select("o_orderkey", "o_totalprice"), 0.2, 42, ["o_orderkey"])
    scaled = features.standardize(rows, ["o_totalprice"], fit_on=rows.filter("split = 'train'"))
    return scaled.withColumn("o_totalprice", F.round("o_totalprice", 6))


def _element_summary(df: DataFrame, column: str) -> DataFrame:
    """Vectors flattened to elements, so that engines agree on the output type."""
    return df.select("vec_id", F.posexplode(column).alias("pos", "v")).select("vec_id", "pos", F.round("v", 5).alias("v"))


@query(
    "fe_minmax_row",
    """WITH x AS (SELECT vec_id, list_transform(embedding, lambda e: e::DOUBLE) AS e FROM embeddings)
       SELECT vec_id, (i - 1)::INT AS pos,
              round((e[i] - list_min(e)) / (list_max(e) - list_min(e) + 1e-8), 5) AS v
       FROM (SELECT vec_id, e, unnest(range(1, len(e) + 1)) AS i FROM x)""",
)
def _(t: Tables) -> DataFrame:
    values = F.col("embedding").cast("array<double>")
    return _element_summary(t.embeddings.select("vec_id", features.minmax_row(values).alias("v")), "v")


@query(
    "fe_denorm",
    """SELECT vec_id, (i - 1)::INT AS pos,
              round(greatest(0.0, least(1.0, embedding[i]::DOUBLE * 0.25 + 0.45)), 5)::DOUBLE AS v
       FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)""",
)
def _(t: Tables) -> DataFrame:
    values = F.col("embedding").cast("array<double>")
    mean, std = (F.array_repeat(F.lit(c), F.size(values)) for c in (0.45, 0.25))
    return _element_summary(t.embeddings.select("vec_id", features.denormalize(values, mean, std).alias("v")), "v")


# --- sets and order ---------------------------------------------------------------------------


@query(
    "set_union_augmented",
    """SELECT l_quantity, l_discount, (l_returnflag = 'R')::INT AS y FROM lineitem
       UNION ALL SELECT l_quantity * 1.5, l_discount, 1 FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F'""",
)
def _(t: Tables) -> DataFrame:
    real = t.lineitem.select("l_quantity", "l_discount", (F.col("l_returnflag") == "R").cast("int").alias("y"))
    extra = t.lineitem.filter("l_returnflag = 'R' AND l_linestatus = 'F'").select(
        (F.col("l_quantity") * 1.5).alias("l_quantity"), "l_discount"
    )
    return relational.augmented(real, extra, "y")


@query(
    "set_shuffle",
    f"""SELECT o_orderkey, o_custkey FROM orders ORDER BY {_digest(["o_orderkey"], 42)}""",
)
def _(t: Tables) -> DataFrame:
    return relational.seeded_shuffle(t.orders.select("o_orderkey", "o_custkey"), 42, ["o_orderkey"])


# --- metrics ----------------------------------------------------------------------------------

_PRED = """SELECT l_linenumber, (l_returnflag = 'R')::INT AS y, l_discount * 10 + l_tax + (l_linenumber % 3) AS score
           FROM lineitem"""


def _predictions(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_linenumber",
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
        (F.col("l_discount") * 10 + F.col("l_tax") + F.col("l_linenumber") % 3).alias("score"),
    )


def _table_sql(keys: str, source: str = _PRED) -> str:
    """CTEs p (predictions), s (running counts by score)."""
    k = f"{keys}, " if keys else ""
    part = f"PARTITION BY {keys}" if keys else ""
    return f"""WITH p AS ({source}),
      g AS (SELECT {k}score, sum(y)::BIGINT AS pos, sum(1 - y)::BIGINT AS neg FROM p GROUP BY {k}score),
      s AS (SELECT *, sum(pos) OVER ({part} ORDER BY score DESC)::BIGINT AS tp,
                   sum(neg) OVER ({part} ORDER BY score DESC)::BIGINT AS fp,
                   sum(pos) OVER ({part})::BIGINT AS np, sum(neg) OVER ({part})::BIGINT AS nn FROM g)"""


_AUC = "sum(neg * (tp - pos / 2)) / (max(np) * max(nn))"
_AP = "sum(pos * tp / (tp + fp)) / max(np)"
_F1 = "2 * tp / (tp + fp + np)"


@query("met_roc_auc", f"{_table_sql('l_linenumber')} SELECT l_linenumber, round({_AUC}, 6) AS roc_auc FROM s GROUP BY 1")
def _(t: Tables) -> DataFrame:
    return metrics.roc_auc(_predictions(t), "y", "score", ["l_linenumber"])


@query(
    "met_avg_precision",
    f"{_table_sql('l_linenumber')} SELECT l_linenumber, round({_AP}, 6) AS average_precision FROM s GROUP BY 1",
)
def _(t: Tables) -> DataFrame:
    return metrics.average_precision(_predictions(t), "y", "score", ["l_linenumber"])


@query(
    "met_pr_curve",
    f"""{_table_sql("")} SELECT score AS threshold, round(tp / (tp + fp), 6) AS precision,
        round(tp / np, 6) AS recall FROM s""",
)
def _(t: Tables) -> DataFrame:
    return metrics.pr_curve(_predictions(t), "y", "score")


@query(
    "met_roc_curve",
    f"""{_table_sql("")} SELECT score AS threshold, round(fp / nn, 6) AS fpr, round(tp / np, 6) AS tpr FROM s""",
)
def _(t: Tables) -> DataFrame:
    return metrics.roc_curve(_predictions(t), "y", "score")


@query(
    "met_best_threshold",
    f"""{_table_sql("l_linenumber")}, r AS (SELECT *, row_number() OVER (PARTITION BY l_linenumber
          ORDER BY {_F1} DESC, score) AS rn FROM s)
        SELECT l_linenumber, score AS threshold, round({_F1}, 6) AS f1 FROM r WHERE rn = 1""",
)
def _(t: Tables) -> DataFrame:
    return metrics.best_threshold(_predictions(t), "y", "score", ["l_linenumber"])


def _best_sql(keys: str, source: str = _PRED) -> str:
    return f"""{_table_sql(keys, source)},
      a AS (SELECT {keys}, round({_AP}, 6) AS pr_auc, round({_AUC}, 6) AS roc_auc FROM s GROUP BY {keys}),
      r AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {_F1} DESC, score) AS rn FROM s)
      SELECT a.{keys}, pr_auc, roc_auc, round(tp / (tp + fp), 6) AS precision, round(tp / np, 6) AS recall,
             round({_F1}, 6) AS f1, round(score, 6) AS threshold
      FROM a JOIN r ON a.{keys} = r.{keys} AND rn = 1"""


@query("met_eval_best", _best_sql("l_linenumber"))
def _(t: Tables) -> DataFrame:
    return metrics.evaluate_best(_predictions(t), "y", "score", ["l_linenumber"])


@query(
    "met_confusion",
    """WITH p AS (SELECT (l_returnflag = 'R')::INT AS y, (l_discount >= 0.05)::INT AS p, l_linestatus FROM lineitem),
       c AS (SELECT l_linestatus, count(*) FILTER (y = 1 AND p = 1) AS tp, count(*) FILTER (y = 0 AND p = 1) AS fp,
                    count(*) FILTER (y = 1 AND p = 0) AS fn, count(*) FILTER (y = 0 AND p = 0) AS tn FROM p GROUP BY 1)
       SELECT *, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall,
              round(2 * tp / (2 * tp + fp + fn), 6) AS f1 FROM c""",
)
def _(t: Tables) -> DataFrame:
    rows = t.lineitem.select(
        "l_linestatus", "l_discount", (F.col("l_returnflag") == "R").cast("int").alias("y")
    )
    return metrics.confusion(rows, "y", metrics.predicted("l_discount", 0.05), ["l_linestatus"])


_MULTI = """SELECT l_returnflag AS y, CASE WHEN l_discount < 0.03 THEN 'A' WHEN l_discount < 0.07 THEN 'N'
            ELSE 'R' END AS p FROM lineitem"""
_MULTI_SCORES = f"""WITH m AS ({_MULTI}), k AS (SELECT DISTINCT y AS class FROM m),
    c AS (SELECT class, (SELECT count(*) FROM m WHERE y = class AND p = class) AS tp,
                 (SELECT count(*) FROM m WHERE p = class) AS np, (SELECT count(*) FROM m WHERE y = class) AS support
          FROM k),
    s AS (SELECT class, tp / np AS precision, tp / support AS recall, 2 * tp / (np + support) AS f1, support, tp FROM c)"""


def _multi(t: Tables) -> DataFrame:
    guess = F.when(F.col("l_discount") < 0.03, "A").when(F.col("l_discount") < 0.07, "N").otherwise("R")
    return t.lineitem.select(F.col("l_returnflag").alias("y"), guess.alias("p"))


@query(
    "met_class_report",
    f"""{_MULTI_SCORES}
        SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM s
        UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
               sum(support)::BIGINT FROM s
        UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
               round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
               sum(support)::BIGINT FROM s""",
)
def _(t: Tables) -> DataFrame:
    return metrics.class_report(_multi(t), "y", "p")


@query(
    "met_confusion_matrix",
    f"WITH m AS ({_MULTI}) SELECT y AS actual, p AS predicted, count(*) AS n FROM m GROUP BY 1, 2",
)
def _(t: Tables) -> DataFrame:
    return metrics.confusion_matrix(_multi(t), "y", "p")


@query(
    "met_multiclass",
    f"""{_MULTI_SCORES} SELECT round(sum(tp) / sum(support), 6) AS accuracy,
        round(sum(precision * support) / sum(support), 6) AS precision,
        round(sum(recall * support) / sum(support), 6) AS recall, round(sum(f1 * support) / sum(support), 6) AS f1
        FROM s""",
)
def _(t: Tables) -> DataFrame:
    return metrics.multiclass(_multi(t), "y", "p")


@query(
    "met_youden",
    f"""{_table_sql("l_linenumber")}, r AS (SELECT *, row_number() OVER (PARTITION BY l_linenumber
          ORDER BY tp * nn - fp * np DESC, score DESC) AS rn FROM s)
        SELECT l_linenumber, score AS threshold, round(tp / np, 6) AS tpr, round(fp / nn, 6) AS fpr,
               round(tp / np - fp / nn, 6) AS j FROM r WHERE rn = 1""",
)
def _(t: Tables) -> DataFrame:
    return metrics.youden(_predictions(t), "y", "score", ["l_linenumber"])


@query(
    "met_regression",
    """WITH x AS (SELECT l_returnflag, l_extendedprice AS y, l_quantity * 1500 AS p FROM lineitem)
       SELECT l_returnflag, round(1 - avg((y - p) ** 2) / var_pop(y), 6) AS r2, round(avg(abs(y - p)), 6) AS mae,
              round(sqrt(avg((y - p) ** 2)), 6) AS rmse FROM x GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    rows = t.lineitem.select(
        "l_returnflag", F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 1500).alias("p")
    )
    return metrics.regression(rows, "y", "p", ["l_returnflag"])


_STRATEGIES = {"weights": "l_discount", "oversampled": "l_quantity", "synthetic": "l_tax"}
_STRATEGY_SQL = " UNION ALL ".join(
    f"SELECT '{s}' AS strategy, (l_returnflag = 'R')::INT AS y, {c} AS score FROM lineitem" for s, c in _STRATEGIES.items()
)


def _strategies(t: Tables) -> DataFrame:
    rows = t.lineitem.select((F.col("l_returnflag") == "R").cast("int").alias("y"), *_STRATEGIES.values())
    renamed = rows.select("y", *[F.col(c).alias(s) for s, c in _STRATEGIES.items()])
    return renamed.unpivot(["y"], list(_STRATEGIES), "strategy", "score")


@query("met_compare_strategies", _best_sql("strategy", _STRATEGY_SQL))
def _(t: Tables) -> DataFrame:
    return metrics.compare_strategies(_strategies(t), "y", "score")


@query(
    "viz_strategy_bars",
    f"""WITH b AS ({_best_sql("strategy", _STRATEGY_SQL)})
        SELECT strategy, unnest(['pr_auc', 'roc_auc', 'f1']) AS metric, unnest([pr_auc, roc_auc, f1]) AS value FROM b""",
)
def _(t: Tables) -> DataFrame:
    table = metrics.compare_strategies(_strategies(t), "y", "score")
    return charts.metric_bars(table, "strategy", ["pr_auc", "roc_auc", "f1"])


_VECTOR_PRED = """SELECT label, unnest(embedding)::DOUBLE AS score,
    (unnest(list_transform(range(len(embedding)), lambda i: (vec_id + i) % 4)) > 2)::INT AS y
    FROM embeddings WHERE vec_id % 7 <> 0"""


@query(
    "met_element_auc",
    f"{_table_sql('label', _VECTOR_PRED)} SELECT label, round({_AUC}, 6) AS roc_auc FROM s GROUP BY label",
)
def _(t: Tables) -> DataFrame:
    mask = F.transform("embedding", lambda _, i: ((F.col("vec_id") + i) % 4).cast("double") / 4)
    rows = t.embeddings.select("label", "embedding", F.when(F.col("vec_id") % 7 != 0, mask).alias("mask"))
    return metrics.element_auc(rows, "embedding", "mask", ["label"])


_VARIANTS = """SELECT v.variant, l_linestatus, (l_returnflag = 'R')::INT AS y,
    CASE v.variant WHEN 'raw' THEN l_discount ELSE l_tax END AS score
    FROM lineitem, (SELECT unnest(['raw', 'scaled']) AS variant) v"""


@query(
    "met_pick_variant",
    f"""{_table_sql("variant, l_linestatus", _VARIANTS)},
        a AS (SELECT variant, l_linestatus, round({_AUC}, 6) AS roc_auc FROM s GROUP BY ALL)
        SELECT l_linestatus, variant, roc_auc FROM (SELECT *, row_number() OVER (PARTITION BY l_linestatus
          ORDER BY roc_auc DESC, variant = 'raw' DESC) AS rn FROM a) WHERE rn = 1""",
)
def _(t: Tables) -> DataFrame:
    rows = t.lineitem.select(
        "l_linestatus",
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
        F.col("l_discount").alias("raw"),
        F.col("l_tax").alias("scaled"),
    ).unpivot(["l_linestatus", "y"], ["raw", "scaled"], "variant", "score")
    return metrics.pick_variant(rows, "y", "score", "variant", "raw", ["l_linestatus"])
