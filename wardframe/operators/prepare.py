"""Split, impute and scale the modelling frame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardframe.fixed_values import (
    C_BINARY,
    C_CONTINUOUS,
    C_TEXT,
    KEY,
    LABEL,
    TEST_PERCENT,
    VALIDATION_PERCENT,
    X_BINARY,
    X_CONTINUOUS,
)
from wardframe.functions.measures import min_max_restored, min_max_scaled
from wardframe.operators.statistics import ColumnStats, column_stats

SPLIT = "split"
SCALED = (*X_CONTINUOUS, *C_CONTINUOUS)


def split_of(key: Column) -> Column:
    """60/20/20 by a hash of the key alone, so no partitioning or rerun moves a row."""
    bucket = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("long") % 100
    return (
        F.when(bucket < TEST_PERCENT, "test")
        .when(bucket < TEST_PERCENT + VALIDATION_PERCENT, "validation")
        .otherwise("train")
    )


def with_split(frame: DataFrame, key: str = KEY) -> DataFrame:
    return frame.withColumn(SPLIT, split_of(F.col(key)))


def training_stats(frame: DataFrame, columns: Sequence[str] = SCALED) -> dict[str, ColumnStats]:
    """Bounds and medians of the training rows only.

    A median lies within its column's bounds, so filling gaps with it leaves
    them alone: one look at the raw rows serves imputing and scaling.
    """
    return column_stats(frame.where(F.col(SPLIT) == "train"), columns)


def imputed(frame: DataFrame, stats: Mapping[str, ColumnStats]) -> DataFrame:
    """Gaps filled with the training median, in every split."""
    return frame.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(s.median).cast("double")) for c, s in stats.items()}
    )


def _bounds(s: ColumnStats) -> tuple[float, float]:
    return (0.0, 0.0) if s.low is None or s.high is None else (s.low, s.high)


def scaled(frame: DataFrame, stats: Mapping[str, ColumnStats]) -> DataFrame:
    """Training bounds mapped to 0 and 1, in every split, without clipping."""
    return frame.withColumns({c: min_max_scaled(F.col(c), *_bounds(s)) for c, s in stats.items()})


def restored(frame: DataFrame, stats: Mapping[str, ColumnStats], columns: Mapping[str, str]) -> DataFrame:
    """Scaled columns back in their own units; ``columns`` maps column to feature."""
    return frame.withColumns(
        {c: min_max_restored(F.col(c), *_bounds(stats[feature])) for c, feature in columns.items()}
    )


def modelling_frame(features: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """The columns a model reads, with the text concepts joined on.

    ``labels`` holds one row per key with the 0/1 text concepts; an admission
    it does not know has none of them.
    """
    joined = features if labels is None else features.join(labels, KEY, "left")
    return joined.select(
        KEY,
        *(F.col(c).cast("double").alias(c) for c in X_CONTINUOUS),
        *(F.col(c).cast("int").alias(c) for c in X_BINARY),
        *(F.col(c).cast("double").alias(c) for c in C_CONTINUOUS),
        *(F.col(c).cast("int").alias(c) for c in C_BINARY),
        *(F.coalesce(F.col(c), F.lit(0)).cast("int").alias(c) for c in C_TEXT),
        F.col(LABEL).cast("int").alias(LABEL),
    )


def prepared(frame: DataFrame) -> tuple[DataFrame, dict[str, ColumnStats]]:
    """Split, imputed and scaled frame, with the training statistics used."""
    split = with_split(frame)
    stats = training_stats(split)
    return scaled(imputed(split, stats), stats), stats
