"""Concept models as plain column arithmetic."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardframe.fixed_values import C_BINARY, C_CONTINUOUS, C_TEXT, X_BINARY, X_CONTINUOUS
from wardframe.functions.measures import linear, sigmoid

FEATURES = (*X_CONTINUOUS, *X_BINARY)
CONCEPTS = (*C_CONTINUOUS, *C_BINARY)
ALL_CONCEPTS = (*CONCEPTS, *C_TEXT)

WEIGHTS_SCHEMA = "model string, layer string, src string, dst string, w double"


@dataclass(frozen=True)
class LabelModel:
    """Label probability from columns, without an intercept."""

    weights: Mapping[str, float]

    def probability(self, prefix: str = "", plain: Sequence[str] = C_TEXT) -> Column:
        """``prefix`` names the predicted concepts; ``plain`` columns never carry it."""
        values = {c: F.col(c if c in plain else prefix + c) for c in self.weights}
        return sigmoid(linear(self.weights, values))


@dataclass(frozen=True)
class ConceptModel:
    """Features to concepts, concepts (and text concepts) to the label.

    Binary concepts are probabilities, continuous ones are left linear.
    """

    concepts: Mapping[str, Mapping[str, float]]  # concept: feature: weight
    label: LabelModel
    binary: Sequence[str] = field(default=C_BINARY)

    def concept(self, name: str) -> Column:
        logit = linear(self.concepts[name])
        return sigmoid(logit) if name in self.binary else logit


def score_label(df: DataFrame, model: LabelModel, name: str = "y_prob", prefix: str = "") -> DataFrame:
    return df.withColumn(name, model.probability(prefix))


def score_concepts(df: DataFrame, model: ConceptModel, prefix: str) -> DataFrame:
    """Add each predicted concept as ``prefix + concept``."""
    return df.withColumns({prefix + c: model.concept(c) for c in model.concepts})


def score_model(df: DataFrame, model: ConceptModel, prefix: str, name: str) -> DataFrame:
    """Predicted concepts, then the label probability computed from them."""
    return score_label(score_concepts(df, model, prefix), model.label, name, prefix)


def weight_rows(name: str, model: ConceptModel | LabelModel) -> list[tuple]:
    if isinstance(model, LabelModel):
        return [(name, "label", src, "y", float(w)) for src, w in model.weights.items()]
    rows = [
        (name, "concept", src, dst, float(w))
        for dst, weights in model.concepts.items()
        for src, w in weights.items()
    ]
    return rows + weight_rows(name, model.label)


def save_weights(spark: SparkSession, path: str, models: Mapping[str, ConceptModel | LabelModel]) -> None:
    """Fitted weights as a long Parquet table."""
    rows = [row for name, model in models.items() for row in weight_rows(name, model)]
    spark.createDataFrame(rows, WEIGHTS_SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)


def load_weights(spark: SparkSession, path: str) -> dict[str, ConceptModel | LabelModel]:
    table = spark.read.schema(WEIGHTS_SCHEMA).parquet(path)
    concepts: dict[str, dict[str, dict[str, float]]] = {}
    labels: dict[str, dict[str, float]] = {}
    for row in table.collect():  # a few hundred weights per model
        if row["layer"] == "label":
            labels.setdefault(row["model"], {})[row["src"]] = row["w"]
        else:
            concepts.setdefault(row["model"], {}).setdefault(row["dst"], {})[row["src"]] = row["w"]
    return {
        name: ConceptModel(concepts[name], LabelModel(weights)) if name in concepts else LabelModel(weights)
        for name, weights in labels.items()
    }
