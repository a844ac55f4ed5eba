"""Ranking, threshold, classification and regression metrics.

Predictions are a frame with a 0/1 label column, a score column and optional grouping keys. All
ranking metrics come from one table of running counts by distinct score (see
:func:`tabkit.plans.ordered.running_totals`), so no task ever sorts all predictions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tabkit.functions.columns import require_columns
from tabkit.plans.ordered import running_totals


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 where b is 0."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def score_table(
    predictions: DataFrame, label: str, score: str, keys: Sequence[str] = (), partitions: int | None = None
) -> DataFrame:
    """Per distinct score, from the highest down: positives and negatives at it and down to it."""
    require_columns(predictions, [label, score, *keys])
    rows = predictions.select(
        *keys, F.col(score).cast("double").alias("threshold"), F.col(label).cast("int").alias("__y")
    ).dropna()
    return running_totals(
        rows,
        "threshold",
        {
            "pos": ("sum", (F.col("__y") == 1).cast("long")),
            "neg": ("sum", (F.col("__y") != 1).cast("long")),
        },
        keys,
        descending=True,
        partitions=partitions,
    )


def _tp() -> Column:
    return F.col("cum_pos")


def _fp() -> Column:
    return F.col("cum_neg")


def _auc(single_class: float | None) -> Column:
    area = F.sum(F.col("neg") * (F.col("cum_pos") - F.col("pos") / 2))
    whole = F.max("tot_pos") * F.max("tot_neg")
    return F.coalesce(F.try_divide(area, whole), F.lit(single_class).cast("double"))


def _average_precision() -> Column:
    steps = F.sum(F.col("pos") * _tp() / (_tp() + _fp()))
    return F.try_divide(steps, F.max("tot_pos"))


def _f1() -> Column:
    return safe_ratio(2 * _tp(), _tp() + _fp() + F.col("tot_pos"))


def _best_point(*wanted: Column) -> Column:
    """The row with the highest F1, the lowest threshold among equals."""
    return F.max_by(F.struct(*wanted), F.struct(_f1(), -F.col("threshold")))


def roc_auc(
    predictions: DataFrame, label: str, score: str, keys: Sequence[str] = (), single_class: float | None = 0.5
) -> DataFrame:
    """Exact area under the ROC curve; ties count half; ``single_class`` if one class is absent."""
    table = score_table(predictions, label, score, keys)
    return table.groupBy(*keys).agg(F.round(_auc(single_class), 6).alias("roc_auc"))


def average_precision(predictions: DataFrame, label: str, score: str, keys: Sequence[str] = ()) -> DataFrame:
    """Sum over thresholds of recall gain times precision (a step sum, no interpolation)."""
    table = score_table(predictions, label, score, keys)
    return table.groupBy(*keys).agg(F.round(_average_precision(), 6).alias("average_precision"))


def pr_curve(predictions: DataFrame, label: str, score: str, keys: Sequence[str] = ()) -> DataFrame:
    """Precision and recall at every distinct score."""
    table = score_table(predictions, label, score, keys)
    return table.select(
        *keys,
        "threshold",
        F.round(_tp() / (_tp() + _fp()), 6).alias("precision"),
        F.round(safe_ratio(_tp(), F.col("tot_pos")), 6).alias("recall"),
    )


def roc_curve(predictions: DataFrame, label: str, score: str, keys: Sequence[str] = ()) -> DataFrame:
    """False and true positive rate at every distinct score."""
    table = score_table(predictions, label, score, keys)
    return table.select(
        *keys,
        "threshold",
        F.round(safe_ratio(_fp(), F.col("tot_neg")), 6).alias("fpr"),
        F.round(safe_ratio(_tp(), F.col("tot_pos")), 6).alias("tpr"),
    )


def best_threshold(predictions: DataFrame, label: str, score: str, keys: Sequence[str] = ()) -> DataFrame:
    """Threshold of the highest F1; among equals the lowest one."""
    table = score_table(predictions, label, score, keys)
    best = _best_point(F.col("threshold").alias("threshold"), _f1().alias("f1"))
    return table.groupBy(*keys).agg(best.alias("b")).select(
        *keys, F.col("b.threshold").alias("threshold"), F.round("b.f1", 6).alias("f1")
    )


def youden(predictions: DataFrame, label: str, score: str, keys: Sequence[str] = ()) -> DataFrame:
    """Threshold with the largest tpr - fpr; among equals the highest one."""
    table = score_table(predictions, label, score, keys).filter((F.col("tot_pos") > 0) & (F.col("tot_neg") > 0))
    # compared in integers, so that equal differences are equal
    gain = _tp() * F.col("tot_neg") - _fp() * F.col("tot_pos")
    point = F.struct(
        F.col("threshold").alias("threshold"),
        (_tp() / F.col("tot_pos")).alias("tpr"),
        (_fp() / F.col("tot_neg")).alias("fpr"),
    )
    return table.groupBy(*keys).agg(F.max_by(point, F.struct(gain, "threshold")).alias("b")).select(
        *keys,
        F.col("b.threshold").alias("threshold"),
        F.round("b.tpr", 6).alias("tpr"),
        F.round("b.fpr", 6).alias("fpr"),
        F.round(F.col("b.tpr") - F.col("b.fpr"), 6).alias("j"),
    )


def evaluate_best(
    predictions: DataFrame, label: str, score: str, keys: Sequence[str] = (), partitions: int | None = None
) -> DataFrame:
    """Average precision, ROC-AUC and the metrics at the best threshold, from one score table."""
    table = score_table(predictions, label, score, keys, partitions)
    best = _best_point(
        F.col("threshold").alias("threshold"),
        (_tp() / (_tp() + _fp())).alias("precision"),
        safe_ratio(_tp(), F.col("tot_pos")).alias("recall"),
        _f1().alias("f1"),
    )
    summary = table.groupBy(*keys).agg(
        _average_precision().alias("pr_auc"), _auc(0.5).alias("roc_auc"), best.alias("b")
    )
    return summary.select(
        *keys,
        F.round("pr_auc", 6).alias("pr_auc"),
        F.round("roc_auc", 6).alias("roc_auc"),
        *[F.round(f"b.{m}", 6).alias(m) for m in ("precision", "recall", "f1", "threshold")],
    )


def compare_strategies(predictions: DataFrame, label: str, score: str, strategy: str = "strategy") -> DataFrame:
    """The table of :func:`evaluate_best` for every strategy, best average precision first."""
    return evaluate_best(predictions, label, score, [strategy]).orderBy(F.desc("pr_auc"), strategy)


def predicted(score: str, threshold: float = 0.5) -> Column:
    return F.when(F.col(score) >= threshold, 1).otherwise(0)


def confusion(predictions: DataFrame, label: str, prediction: Column, keys: Sequence[str] = ()) -> DataFrame:
    """Binary confusion counts with precision, recall and F1 (0 where undefined)."""
    y = F.col(label) == 1
    p = prediction == 1
    counts = predictions.groupBy(*keys).agg(
        F.count_if(y & p).alias("tp"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
        F.count_if(~y & ~p).alias("tn"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.withColumns(
        {
            "precision": F.round(safe_ratio(tp, tp + fp), 6),
            "recall": F.round(safe_ratio(tp, tp + fn), 6),
            "f1": F.round(safe_ratio(2 * tp, 2 * tp + fp + fn), 6),
        }
    )


def confusion_matrix(predictions: DataFrame, label: str, prediction: str) -> DataFrame:
    """Counts of every (actual, predicted) pair that occurs."""
    require_columns(predictions, [label, prediction])
    return predictions.groupBy(F.col(label).alias("actual"), F.col(prediction).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def class_scores(predictions: DataFrame, label: str, prediction: str) -> DataFrame:
    """Unrounded precision, recall, F1 and support per class, from one pass over the predictions."""
    pairs = confusion_matrix(predictions, label, prediction)
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    sides = F.array(
        F.struct(F.col("actual").alias("class"), F.col("n").alias("actual_n"), F.lit(0).cast("long").alias("pred_n"), hit.alias("hit_n")),
        F.struct(F.col("predicted").alias("class"), F.lit(0).cast("long").alias("actual_n"), F.col("n").alias("pred_n"), F.lit(0).cast("long").alias("hit_n")),
    )
    per_class = (
        pairs.select(F.inline(sides))
        .groupBy("class")
        .agg(F.sum("hit_n").alias("tp"), F.sum("pred_n").alias("predicted"), F.sum("actual_n").alias("support"))
    )
    return per_class.select(
        F.col("class").cast("string").alias("class"),
        safe_ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        safe_ratio(F.col("tp"), F.col("support")).alias("recall"),
        safe_ratio(2 * F.col("tp"), F.col("predicted") + F.col("support")).alias("f1"),
        "support",
        "tp",
    )


def class_report(predictions: DataFrame, label: str, prediction: str) -> DataFrame:
    """Per class precision, recall, F1 and support, then their macro and weighted means."""
    scores = class_scores(predictions, label, prediction)
    names = ("precision", "recall", "f1")
    support = F.sum("support")
    macro = scores.agg(
        F.lit("macro avg").alias("class"), *[F.avg(m).alias(m) for m in names], support.alias("support")
    )
    weighted = scores.agg(
        F.lit("weighted avg").alias("class"),
        *[safe_ratio(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(m) for m in names],
        support.alias("support"),
    )
    rows = scores.select("class", *names, "support").unionByName(macro).unionByName(weighted)
    return rows.select("class", *[F.round(m, 6).alias(m) for m in names], "support")


def multiclass(predictions: DataFrame, label: str, prediction: str) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1."""
    scores = class_scores(predictions, label, prediction)
    n = F.sum("support")
    return scores.agg(
        F.round(safe_ratio(F.sum("tp"), n), 6).alias("accuracy"),
        *[
            F.round(safe_ratio(F.sum(F.col(m) * F.col("support")), n), 6).alias(m)
            for m in ("precision", "recall", "f1")
        ],
    )


def regression(predictions: DataFrame, label: str, prediction: str, keys: Sequence[str] = ()) -> DataFrame:
    """R2, MAE and RMSE in one aggregation."""
    require_columns(predictions, [label, prediction, *keys])
    error = F.col(label) - F.col(prediction)
    return predictions.groupBy(*keys).agg(
        F.round(1 - F.try_divide(F.avg(error * error), F.var_pop(label)), 6).alias("r2"),
        F.round(F.avg(F.abs(error)), 6).alias("mae"),
        F.round(F.sqrt(F.avg(error * error)), 6).alias("rmse"),
    )


def element_auc(
    rows: DataFrame, scores: str, mask: str, keys: Sequence[str] = (), cut: float = 0.5
) -> DataFrame:
    """ROC-AUC over the elements of score vectors against mask vectors; null if one class is absent."""
    require_columns(rows, [scores, mask, *keys])
    elements = rows.filter(F.col(mask).isNotNull()).select(
        *keys, F.explode(F.arrays_zip(F.col(scores).alias("s"), F.col(mask).alias("m"))).alias("e")
    )
    flat = elements.select(*keys, F.col("e.s").cast("double").alias("score"), (F.col("e.m") > cut).cast("int").alias("y"))
    return roc_auc(flat, "y", "score", keys, single_class=None)


def pick_variant(
    predictions: DataFrame, label: str, score: str, variant: str, preferred: str, keys: Sequence[str] = ()
) -> DataFrame:
    """The score variant with the higher AUC; the preferred one wins a draw."""
    table = score_table(predictions, label, score, [*keys, variant])
    areas = table.groupBy(*keys, variant).agg(_auc(0.5).alias("roc_auc"))
    order = F.struct("roc_auc", F.col(variant) == preferred)
    return areas.groupBy(*keys).agg(
        F.max_by(variant, order).alias(variant), F.round(F.max("roc_auc"), 6).alias("roc_auc")
    )
