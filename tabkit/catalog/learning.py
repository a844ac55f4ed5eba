"""Queries on models, explanations, anomalies and synthesis."""

from __future__ import annotations

from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, Window, functions as F

from tabkit.catalog.registry import Tables, query
from tabkit.operators import anomaly, boosting, explain, features, models, relational, synthesis, text
from tabkit.session import scratch_path

# --- models -----------------------------------------------------------------------------------


def _labelled_docs(t: Tables) -> DataFrame:
    """Documents with quality labels and a few numbers drawn from their text, computed once."""
    def count_of(characters: str):
        return F.length("text") - F.length(F.translate("text", characters, ""))

    counted = t.documents.join(t.labels, "doc_id").select(
        "doc_id", "lang", "n_chars", "quality", "toxic",
        (count_of(" \n") + 1).alias("n_words"),
        count_of("0123456789").alias("n_digits"),
        count_of("\n").alias("n_lines"),
    )
    return counted.select(
        "doc_id", "lang", "n_chars", "quality", "toxic", "n_words",
        (F.col("n_digits") / F.greatest("n_chars", F.lit(1))).alias("digit_share"),
        (F.col("n_lines") / F.col("n_words")).alias("line_share"),
    ).persist()


@query("ml_baseline_cls")
def _(t: Tables) -> DataFrame:
    docs = _labelled_docs(t)
    return models.train_baseline_model(docs.drop("doc_id", "toxic"), "quality").metrics


@query("ml_baseline_reg")
def _(t: Tables) -> DataFrame:
    return models.train_baseline_model(t.part.drop("p_partkey"), "p_retailprice").metrics


@query("ml_importance")
def _(t: Tables) -> DataFrame:
    result = models.train_baseline_model(t.part, "p_retailprice", boosting=False)
    return models.feature_importance(result, 15)


def _flagged_lines(t: Tables) -> DataFrame:
    rows = t.lineitem.select(
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        F.col("l_linenumber").cast("double").alias("l_linenumber"),
        (F.col("l_returnflag") == "R").cast("double").alias("label"),
        "l_shipdate",
    )
    return rows


_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


@query("ml_gbt_weighted")
def _(t: Tables) -> DataFrame:
    split = features.split_time(_flagged_lines(t), "l_shipdate", 0.2)
    ready = models.assemble(split, _FEATURES).select("split", "label", "features").persist()
    model = models.fit_weighted_boosting(ready.filter("split = 'train'"))
    scored = models.with_score(model.transform(ready.filter("split = 'test'")))
    from tabkit.operators import metrics

    return metrics.evaluate_best(scored, "label", "score")


@query("ml_gbt_early_stop")
def _(t: Tables) -> DataFrame:
    split = features.split_random(_flagged_lines(t).drop("l_shipdate"), 0.15, 7)
    ready = models.assemble(split, _FEATURES).withColumn("held", F.col("split") == "test")
    model = models.fit_early_stopping(ready, "held")
    pairs = models.importance_pairs(model, _FEATURES)
    frame = t.spark.createDataFrame(pairs, "feature string, importance double")
    return frame.withColumn("n_trees", F.lit(model.model.best_round))


#: Share of some letters, which differ by language.
_LETTERS = "abcdefghijklmnopqrstuvwxyzáäéèêñöüßçóí"


@query(
    "ml_boost_multiclass",
    """SELECT lang, count(*) AS n_test, true AS accuracy_above_08, true AS better_than_commonest, true AS sums_to_one
       FROM documents WHERE lang IS NOT NULL AND doc_id % 5 = 0 GROUP BY lang""",
)
def _(t: Tables) -> DataFrame:
    """Languages of held-out documents from shares of letters, by softmax boosting with the default 200 rounds."""
    counted = t.documents.where("lang IS NOT NULL").select("doc_id", "lang", F.length("text").alias("n"), text.character_counts(F.lower("text"), _LETTERS).alias("counts"))
    rows = counted.select("doc_id", "lang", *[(F.col("counts")[i] / F.greatest("n", F.lit(1))).alias(f"share{i}") for i in range(len(_LETTERS))])
    kinds = [r["lang"] for r in rows.select("lang").distinct().orderBy("lang").collect()]
    coded = rows.withColumn("y", F.array_position(F.array(*[F.lit(k) for k in kinds]), F.col("lang")) - 1)
    names = [f"share{i}" for i in range(len(_LETTERS))]
    model = boosting.fit_boosting(coded.where("doc_id % 5 <> 0"), names, "y", len(kinds))
    found = boosting.predict(coded.where("doc_id % 5 = 0"), model, probability="p")
    each = found.groupBy("lang").agg(
        F.count("*").alias("n_test"), F.count_if(F.col("prediction") == F.col("y")).alias("hits"),
        F.bool_and(F.abs(F.aggregate("p", F.lit(0.0), lambda a, b: a + b) - 1) < 1e-9).alias("sums_to_one"),
    )
    whole = each.agg(F.sum("hits").alias("all_hits"), F.sum("n_test").alias("all"), F.max("n_test").alias("commonest"))
    return each.crossJoin(whole).select(  # one row
        "lang", "n_test", (F.col("all_hits") > 0.8 * F.col("all")).alias("accuracy_above_08"), (F.col("all_hits") > F.col("commonest")).alias("better_than_commonest"), "sums_to_one"
    )


_STUMP = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


@query(
    "ml_boost_stump",
    """WITH m AS (SELECT avg(l_extendedprice) AS m, stddev_pop(l_extendedprice) AS s, count(*) AS n FROM lineitem),
      long AS ("""
    + " UNION ALL ".join(f"SELECT {i} AS i, '{c}' AS feature, {c}::DOUBLE AS x, (m - l_extendedprice) / s AS g FROM lineitem, m" for i, c in enumerate(_STUMP))
    + """), runs AS (
        SELECT i, feature, x, sum(sum(g)) OVER w AS g_left, sum(count(*)) OVER w AS h_left, sum(sum(g)) OVER (PARTITION BY i) AS g, sum(count(*)) OVER (PARTITION BY i) AS h
        FROM long GROUP BY i, feature, x WINDOW w AS (PARTITION BY i ORDER BY x)
      ), cuts AS (
        SELECT *, (g_left ** 2 / (h_left + 1) + (g - g_left) ** 2 / (h - h_left + 1) - g ** 2 / (h + 1)) / 2 AS gain FROM runs WHERE h_left < h
      )
      SELECT feature, x AS cut, round(gain, 3) AS gain, round(m - s * g_left / (h_left + 1), 2) AS left_value, round(m - s * (g - g_left) / (h - h_left + 1), 2) AS right_value
      FROM cuts, m ORDER BY cuts.gain DESC, i, x LIMIT 1""",
)
def _(t: Tables) -> DataFrame:
    """The first cut of boosting a number, over all rows."""
    model = boosting.fit_boosting(t.lineitem, _STUMP, "l_extendedprice", rounds=1, depth=1, step=1.0)
    tree, base = model.trees[0][0], float(model.base[0]) * model.scale
    f = int(tree.feature[0])
    values = [base + float(tree.value[i]) * model.scale for i in (int(tree.left[0]), int(tree.right[0]))]
    row = (_STUMP[f], float(model.edges[f][int(tree.cut[0]) - 1]), round(float(tree.gain[0]), 3), *[round(v, 2) for v in values])
    return t.spark.createDataFrame([row], "feature string, cut double, gain double, left_value double, right_value double")


@query(
    "ml_early_stop_curve",
    """WITH m AS (SELECT avg(p_retailprice) AS m FROM part WHERE p_partkey % 4 <> 0)
       SELECT round(sqrt(avg((p_retailprice - m) ** 2) FILTER (WHERE p_partkey % 4 <> 0)), 2) AS first_train, round(sqrt(avg((p_retailprice - m) ** 2) FILTER (WHERE p_partkey % 4 = 0)), 2) AS first_validation,
         true AS stopped_in_time, true AS best_is_least, true AS held_out_rmse_is_best, true AS improved FROM part, m""",
)
def _(t: Tables) -> DataFrame:
    """The curve of boosting that stops ten rounds after its best round on held-out rows, and that round's own error."""
    rows = t.part.select("p_size", F.length("p_name").alias("name"), F.col("p_partkey").alias("number"), "p_retailprice", (F.col("p_partkey") % 4 == 0).alias("held"))
    names = ["p_size", "name", "number"]
    model = boosting.fit_boosting(rows, names, "p_retailprice", validation="held", patience=10, rounds=3000, step=0.1)
    curve = boosting.learning_curve(t.spark, model)
    best = curve.where("is_best").select(F.col("round").alias("at"), F.col("validation_loss").alias("least"))
    rmse = boosting.predict(rows.where("held"), model).agg(F.sqrt(F.avg((F.col("prediction") - F.col("p_retailprice")) ** 2)).alias("rmse"))
    facts = curve.agg(
        F.round(F.min_by("train_loss", "round"), 2).alias("first_train"), F.round(F.min_by("validation_loss", "round"), 2).alias("first_validation"),
        F.min_by("validation_loss", "round").alias("first"), F.max("round").alias("last"), F.min("validation_loss").alias("lowest"),
    )
    return facts.crossJoin(best).crossJoin(rmse).select(  # one row each
        "first_train", "first_validation", (F.col("last") <= F.col("at") + 10).alias("stopped_in_time"), (F.col("least") == F.col("lowest")).alias("best_is_least"),
        (F.abs(F.col("rmse") - F.col("least")) < 1e-3 * F.col("least")).alias("held_out_rmse_is_best"), (F.col("least") < F.col("first")).alias("improved"),
    )


@query("ml_shap_tree", "SELECT p_partkey, true AS adds_up FROM part")
def _(t: Tables) -> DataFrame:
    """Exact Shapley values of boosted trees for every row: whether they sum to the prediction less the mean prediction."""
    rows = t.part.select("p_partkey", "p_size", F.length("p_name").alias("name"), F.length("p_type").alias("type"), "p_retailprice")
    names = ["p_size", "name", "type", "p_partkey"]
    model = boosting.fit_boosting(rows, names, "p_retailprice", rounds=20, depth=5)
    found = boosting.predict(boosting.tree_shap(rows, model), model)
    total = F.aggregate("shap", F.lit(0.0), lambda a, b: a + b)
    fits = (F.abs(total - (F.col("margin") - F.col("mean_margin"))) < 1e-6) & (F.abs(F.col("margin") - F.col("prediction")) < 1e-6)
    return found.select("p_partkey", fits.alias("adds_up"))


@query("ml_elastic_net")
def _(t: Tables) -> DataFrame:
    names = ["l_quantity", "l_discount", "l_tax"]
    rows = features.split_random(t.lineitem.select(*names, "l_extendedprice"), 0.2, 42)
    model = models.elastic_net(names, "l_extendedprice").fit(rows.filter("split = 'train'"))
    from tabkit.operators import metrics

    return metrics.regression(model.transform(rows.filter("split = 'test'")), "l_extendedprice", "prediction")


@query("ml_random_search")
def _(t: Tables) -> DataFrame:
    """Fifty draws of an elastic net, each with five folds."""
    rows = models.assemble(t.lineitem.select("l_quantity", "l_discount", "l_tax", F.col("l_extendedprice").alias("label")), ["l_quantity", "l_discount", "l_tax"])
    space = {"regParam": (1e-4, 10.0, "log"), "elasticNetParam": (0.0, 1.0, "float")}
    _, history = models.random_search(LinearRegression(), rows, space, models.default_evaluator("regression"), trials=50, folds=5, parallelism=8)
    return relational.best_so_far(history, "trial", "value")


@query("ml_search_boosting")
def _(t: Tables) -> DataFrame:
    """Fifty draws of boosted trees for toxic documents, by average precision on the later documents."""
    docs = _labelled_docs(t)
    split = features.split_time(docs, "doc_id", 0.15)
    train, held = (split.where(F.col("split") == s).drop("split") for s in ("train", "test"))
    _, history = models.search_boosting(train, held, _RARE, "toxic")
    return history


@query("ml_persist", "SELECT l_orderkey, l_linenumber, true AS same FROM lineitem")
def _(t: Tables) -> DataFrame:
    """Whether a saved and loaded model predicts what the fitted one does."""
    names = ["l_quantity", "l_discount", "l_tax"]
    model = models.elastic_net(names, "l_extendedprice").fit(t.lineitem)
    path = models.save_model(model, scratch_path(t.spark, "model"))
    loaded = models.PipelineModel.load(path)
    rows = model.transform(t.lineitem.select("l_orderkey", "l_linenumber", *names)).withColumnRenamed("prediction", "fitted").drop("raw", "features")
    return loaded.transform(rows).select("l_orderkey", "l_linenumber", (F.col("prediction") == F.col("fitted")).alias("same"))


_BETA = {"l_quantity": 1500.0, "l_discount": -2000.0, "l_tax": 0.0}


@query(
    "ml_shap_linear",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, round(avg(abs({b} * ({c} - m))), 4) AS mean_abs_shap,
              {(b > 0) - (b < 0)}::DOUBLE AS value_shap_correlation,
              '{explain.UP if b > 0 else explain.DOWN if b < 0 else explain.FLAT}' AS direction
            FROM lineitem, (SELECT avg({c}) AS m FROM lineitem)"""
        for c, b in _BETA.items()
    ),
)
def _(t: Tables) -> DataFrame:
    return explain.linear_shap(t.lineitem, _BETA)


@query("ml_shap_sampled")
def _(t: Tables) -> DataFrame:
    result = models.train_baseline_model(t.part.drop("p_partkey", "p_name"), "p_retailprice")
    return explain.explain_best(result)


# --- anomalies --------------------------------------------------------------------------------


@query("anom_iforest")
def _(t: Tables) -> DataFrame:
    found = anomaly.detect_anomalies(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return found.top(10).select("l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "anomaly_score")


@query("anom_iforest_summary")
def _(t: Tables) -> DataFrame:
    return anomaly.detect_anomalies(t.events, ["value", "user_id"]).summary()


@query("anom_reconstruction")
def _(t: Tables) -> DataFrame:
    normal = t.embeddings.filter("label <> 0")
    mean, axes = anomaly.fit_reconstruction(normal, "embedding", 8)
    scored = anomaly.reconstruction_error(t.embeddings, "embedding", mean, axes)
    return scored.select("vec_id", "label", F.round("error", 6).alias("error"))


_CENTRE_SQL = """WITH e AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v,
                                   unnest(range(1, len(embedding) + 1)) AS i FROM embeddings),
    m AS (SELECT label, i, avg(v) AS m FROM e GROUP BY label, i),
    d AS (SELECT vec_id, i, (v - m) * (v - m) AS q FROM e JOIN m USING (label, i))"""


def _with_centres(t: Tables) -> DataFrame:
    rows = t.embeddings.withColumn("x", F.col("embedding").cast("array<double>"))
    return anomaly.with_class_means(rows, "x", "label")


@query("anom_centroid_error", f"{_CENTRE_SQL} SELECT vec_id, round(avg(q), 8) AS error FROM d GROUP BY vec_id")
def _(t: Tables) -> DataFrame:
    error = anomaly.mean_of(anomaly.squared_errors(F.col("x"), F.col("x_hat")))
    return _with_centres(t).select("vec_id", F.round(error, 8).alias("error"))


@query(
    "anom_topk_score",
    f"""{_CENTRE_SQL}, s AS (SELECT vec_id, q, row_number() OVER (PARTITION BY vec_id ORDER BY q DESC) AS rn,
          count(*) OVER (PARTITION BY vec_id) AS n, min(q) OVER (PARTITION BY vec_id) AS lo,
          max(q) OVER (PARTITION BY vec_id) AS hi FROM d)
        SELECT vec_id, round(avg(q), 6) AS raw_score, round(avg((q - lo) / (hi - lo + 1e-8)), 6) AS scaled_score
        FROM s WHERE rn <= greatest(1, floor(n * 0.1)) GROUP BY vec_id""",
)
def _(t: Tables) -> DataFrame:
    scores = anomaly.vector_scores(anomaly.squared_errors(F.col("x"), F.col("x_hat")))
    return _with_centres(t).select("vec_id", *[F.round(c, 6).alias(n) for n, c in scores.items()])


@query(
    "anom_weighted",
    """WITH e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v FROM embeddings)
       SELECT vec_id, round(sum(0.5 * v * v + 0.3 * abs(v) + 0.2 * v) / count(*), 8) AS score FROM e GROUP BY vec_id""",
)
def _(t: Tables) -> DataFrame:
    x = F.col("embedding").cast("array<double>")
    maps = [F.transform(x, lambda v: v * v), F.transform(x, lambda v: F.abs(v)), x]
    total = anomaly.mean_of(anomaly.weighted_map(maps, [0.5, 0.3, 0.2]))
    return t.embeddings.select("vec_id", F.round(total, 8).alias("score"))


# --- synthesis --------------------------------------------------------------------------------

_RARE = ["n_chars", "n_words", "digit_share", "line_share"]


@query(
    "join_knn",
    """WITH p AS (SELECT p_size::DOUBLE AS x, p_retailprice::DOUBLE AS y, min(p_partkey) AS point FROM part GROUP BY ALL),
       d AS (SELECT a.point, b.point AS other, round(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2), 6) AS distance FROM p a JOIN p b ON a.point <> b.point),
       r AS (SELECT *, row_number() OVER (PARTITION BY point ORDER BY distance, other) AS place FROM d)
       SELECT point, place, distance FROM r WHERE place <= 3""",
)
def _(t: Tables) -> DataFrame:
    from tabkit.operators.neighbours import nearest_rows

    _, pairs = nearest_rows(t.part, "p_partkey", ["p_size", "p_retailprice"], 3)
    place = F.row_number().over(Window.partitionBy("point").orderBy("distance", "other"))
    return pairs.select("point", place.alias("place"), F.round("distance", 6).alias("distance"))


@query("syn_smote")
def _(t: Tables) -> DataFrame:
    docs = _labelled_docs(t)
    return synthesis.smote(docs, "toxic", "doc_id", _RARE)


@query("syn_copula")
def _(t: Tables) -> DataFrame:
    docs = _labelled_docs(t)
    n = synthesis.rare_rows_needed(docs, "toxic")
    return synthesis.copula_rows(docs.filter("toxic = 1"), n, _RARE, ["lang"])


@query(
    "syn_ks",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, round(max(abs(a / na - b / nb)), 6) AS ks, max(na)::BIGINT AS n_left,
                   max(nb)::BIGINT AS n_right
            FROM (SELECT sum(x) OVER (ORDER BY v) AS a, sum(y) OVER (ORDER BY v) AS b, sum(x) OVER () AS na,
                         sum(y) OVER () AS nb
                  FROM (SELECT {c} AS v, count(*) FILTER (l_returnflag = 'R') AS x,
                               count(*) FILTER (l_returnflag <> 'R') AS y FROM lineitem GROUP BY 1))"""
        for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    ),
)
def _(t: Tables) -> DataFrame:
    rows = t.lineitem
    names = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    found = synthesis.kolmogorov_smirnov(rows.filter("l_returnflag = 'R'"), rows.filter("l_returnflag <> 'R'"), names)
    return found.drop("p_value")


def _ks_exact_sql(columns: list[str]) -> str:
    """Distances, and the chance of paths within the band, one diagonal after the other."""
    long = " UNION ALL ".join(f"SELECT '{c}' AS f, {c}::DOUBLE AS v, toxic FROM labels JOIN documents USING (doc_id)" for c in columns)
    return f"""WITH RECURSIVE long AS ({long}), runs AS (
        SELECT f, v, sum(sum(toxic)) OVER w AS a, sum(sum(1 - toxic)) OVER w AS b, sum(sum(toxic)) OVER (PARTITION BY f) AS n, sum(sum(1 - toxic)) OVER (PARTITION BY f) AS m
        FROM long GROUP BY f, v WINDOW w AS (PARTITION BY f ORDER BY v)
      ), d AS (SELECT f, max(n)::BIGINT AS n, max(m)::BIGINT AS m, max(abs(a * m - b * n))::BIGINT AS reach FROM runs GROUP BY f),
      paths AS (
        SELECT f, 0::BIGINT AS k, 0::BIGINT AS i, 1.0::DOUBLE AS p FROM d
        UNION ALL
        SELECT f, k, i, sum(p) AS p FROM (
          SELECT paths.f, k + 1 AS k, i + up AS i, p * CASE up WHEN 1 THEN n - i ELSE m - (k - i) END / (n + m - k) AS p, n, m, reach
          FROM paths JOIN d USING (f), (VALUES (0), (1)) AS s(up) WHERE k < n + m
        ) WHERE i <= n AND k - i <= m AND abs(i * m - (k - i) * n) < reach GROUP BY f, k, i
      )
      SELECT f AS feature, round(reach / (n * m), 6) AS ks, round(1 - coalesce(p, 0), 6) AS p_value, n AS n_left, m AS n_right
      FROM d LEFT JOIN (SELECT f, k, i, p FROM paths) AS e USING (f) WHERE e.k = n + m AND e.i = n OR NOT EXISTS (SELECT 1 FROM paths q WHERE q.f = d.f AND q.k = n + m) AND e.k = 0"""


@query("syn_ks_p_value", _ks_exact_sql(["n_chars", "doc_id"]))
def _(t: Tables) -> DataFrame:
    docs = t.documents.join(t.labels, "doc_id")
    return synthesis.kolmogorov_smirnov(docs.filter("toxic = 1"), docs.filter("toxic = 0"), ["n_chars", "doc_id"])


@query("syn_ks_synthetic")
def _(t: Tables) -> DataFrame:
    docs = _labelled_docs(t)
    rare = docs.filter("toxic = 1")
    made = synthesis.copula_rows(rare, synthesis.rare_rows_needed(docs, "toxic"), _RARE)
    return synthesis.kolmogorov_smirnov(rare, made, _RARE)


def _doc_split(t: Tables) -> tuple[DataFrame, DataFrame]:
    split = features.split_random(_labelled_docs(t), 0.25, 42, ["doc_id"], stratify="toxic").persist()
    return split.filter("split = 'train'"), split.filter("split = 'test'")


@query("syn_tstr")
def _(t: Tables) -> DataFrame:
    train, test = _doc_split(t)
    made = synthesis.copula_rows(train.filter("toxic = 1"), synthesis.rare_rows_needed(train, "toxic"), _RARE)
    return synthesis.train_synthetic_test_real(train, made, test, _RARE, "toxic")


@query("syn_compare")
def _(t: Tables) -> DataFrame:
    train, test = _doc_split(t)
    made = synthesis.copula_rows(train.filter("toxic = 1"), synthesis.rare_rows_needed(train, "toxic"), _RARE)
    tuned = synthesis.copula_rows(train.filter("toxic = 1"), 2 * synthesis.rare_rows_needed(train, "toxic"), _RARE)
    extra = {"smote": synthesis.smote(train, "toxic", "doc_id", _RARE), "copula": made, "tuned_copula": tuned}
    return synthesis.compare_strategies(train, test, _RARE, "toxic", extra)
