"""Label and concept metrics, each from one aggregate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardframe.functions.measures import class_above, class_at_least, safe_divide, total

OUTCOMES = ("TP", "TN", "FP", "FN")


def _counts(truth: Column, predicted: Column) -> list[Column]:
    def count(t: int, p: int, name: str) -> Column:
        return F.count_if((truth == t) & (predicted == p)).alias(name)

    return [count(1, 1, "tp"), count(0, 0, "tn"), count(0, 1, "fp"), count(1, 0, "fn")]


def _rates() -> dict[str, Column]:
    """Metrics over the four counts; 0 for an empty denominator.

    The ranking area of two hard classes is the mean of both recalls; it is
    null where a class is absent.
    """
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))

    def ratio(top: Column, bottom: Column) -> Column:
        return F.coalesce(safe_divide(top, bottom), F.lit(0.0))

    return {
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, tp + fn),
        "f1": ratio(2 * tp, 2 * tp + fp + fn),
        "auc": (safe_divide(tp, tp + fn) + safe_divide(tn, tn + fp)) / 2,
        "accuracy": ratio(tp + tn, tp + tn + fp + fn),
    }


def confusion_counts(df: DataFrame, truth: str, probability: str) -> DataFrame:
    """Rows per true and predicted class."""
    return (
        df.select(F.col(truth).alias("y"), class_at_least(F.col(probability)).alias("predicted"))
        .groupBy("y", "predicted")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def label_metrics(df: DataFrame, truth: str, probability: str) -> DataFrame:
    """Precision, recall, F1, AUC of the classes and accuracy, one row."""
    counted = df.agg(*_counts(F.col(truth), class_above(F.col(probability))))
    return counted.select(*(column.alias(name) for name, column in _rates().items()))


def _stacked(df: DataFrame, pairs: Mapping[str, tuple[str, str]], names: str) -> DataFrame:
    """(name, truth, prediction) rows for several pairs of columns, from one scan."""
    entries = [
        F.struct(
            F.lit(name).alias(names),
            F.col(truth).cast("double").alias("truth"),
            F.col(predicted).cast("double").alias("prediction"),
        )
        for name, (truth, predicted) in pairs.items()
    ]
    return df.select(F.inline(F.array(*entries)))


def binary_concept_metrics(df: DataFrame, pairs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Precision, recall, F1 and accuracy per concept, 0 without a denominator."""
    rates = _rates()
    return (
        _stacked(df, pairs, "concept")
        .groupBy("concept")
        .agg(*_counts(F.col("truth"), class_above(F.col("prediction"))))
        .select("concept", *(F.round(rates[m], 3).alias(m) for m in ("precision", "recall", "f1", "accuracy")))
    )


def continuous_concept_metrics(df: DataFrame, pairs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """MSE, MAE, RMSE and R2 per concept; R2 of a constant truth is 1 if hit, else 0."""
    error = F.col("truth") - F.col("prediction")
    mse, spread = F.avg(error * error), F.var_pop("truth")
    flat = F.when(mse == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    return (
        _stacked(df, pairs, "concept")
        .groupBy("concept")
        .agg(
            F.round(mse, 3).alias("mse"),
            F.round(F.avg(F.abs(error)), 3).alias("mae"),
            F.round(F.sqrt(mse), 3).alias("rmse"),
            F.round(F.when(spread == 0, flat).otherwise(1 - safe_divide(mse, spread)), 3).alias("r2"),
        )
    )


def _mutual_information() -> Column:
    """In nats over the four counts; an empty cell adds nothing."""
    tp, tn, fp, fn = (F.col(c).cast("double") for c in ("tp", "tn", "fp", "fn"))
    rows = tp + tn + fp + fn
    cells = [(tp, tp + fn, tp + fp), (fn, tp + fn, tn + fn), (fp, fp + tn, tp + fp), (tn, fp + tn, tn + fn)]
    return total(
        F.when(n > 0, n / rows * F.ln(n * rows / (truth * predicted))).otherwise(F.lit(0.0))
        for n, truth, predicted in cells
    )


def mutual_information(df: DataFrame, truth: str, probability: str) -> DataFrame:
    """Between the label and the class at or above one half."""
    counted = df.agg(*_counts(F.col(truth), class_at_least(F.col(probability))))
    return counted.select(F.round(_mutual_information(), 6).alias("mutual_information"))


def completeness_table(df: DataFrame, truth: str, models: Mapping[str, str]) -> DataFrame:
    """Label metrics and mutual information for several probability columns.

    All models are counted in one aggregate over one scan. The metrics use
    the strict cut, mutual information the inclusive one.
    """
    stacked = _stacked(df, {m: (truth, p) for m, p in models.items()}, "model")
    strict = _counts(F.col("truth"), class_above(F.col("prediction")))
    inclusive = _counts(F.col("truth"), class_at_least(F.col("prediction")))
    counted = stacked.groupBy("model").agg(
        F.struct(*strict).alias("strict"), F.struct(*inclusive).alias("inclusive")
    )
    metrics = counted.select("model", "inclusive", "strict.*").select(
        "model", "inclusive", *(column.alias(name) for name, column in _rates().items())
    )
    return metrics.select("*", "inclusive.*").select(
        "model",
        *_rates(),
        F.round(_mutual_information(), 6).alias("mutual_information"),
    )


def outcome(truth: Column, probability: Column) -> Column:
    """TP, TN, FP or FN with the inclusive cut."""
    predicted = class_at_least(probability)
    return (
        F.when((truth == 1) & (predicted == 1), "TP")
        .when((truth == 0) & (predicted == 0), "TN")
        .when((truth == 0) & (predicted == 1), "FP")
        .when((truth == 1) & (predicted == 0), "FN")
    )


def outcome_difference(df: DataFrame, key: str, first: str, second: str, outcomes: Sequence[str] = ("FN", "FP")) -> DataFrame:
    """Keys with an error in ``first`` that ``second`` does not share.

    Both outcomes sit on the same row, so the set difference is a filter.
    """
    hit = F.col(first).isin(*outcomes) & ~F.col(second).eqNullSafe(F.col(first))
    return df.where(hit).select(key, F.col(first).alias("outcome"))


def case_comparison(df: DataFrame, key: str, first: str, second: str, columns: Sequence[str]) -> DataFrame:
    """Rows on which the two models disagree about right and wrong."""
    right = [F.col(c).isin("TP", "TN") for c in (first, second)]
    verdict = (
        F.when(~right[0] & right[1], F.concat(F.col(first), F.lit(" corrected")))
        .when(right[0] & ~right[1], F.concat(F.col(second), F.lit(" induced")))
    )
    return df.withColumn("verdict", verdict).where(F.col("verdict").isNotNull()).select(key, "verdict", *columns)


def case_profile(df: DataFrame, key: str, values: Mapping[str, tuple[str, str, str | None]]) -> DataFrame:
    """Rows (key, name, kind, value, predicted); ``values`` maps a name to
    (kind, column, predicted column or None)."""
    entries = [
        F.struct(
            F.lit(name).alias("name"),
            F.lit(kind).alias("kind"),
            F.col(column).cast("double").alias("value"),
            (F.col(predicted) if predicted else F.lit(None)).cast("double").alias("predicted"),
        )
        for name, (kind, column, predicted) in values.items()
    ]
    return df.select(key, F.inline(F.array(*entries)))


