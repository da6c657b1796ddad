"""Scalar column functions whose null and boundary rules matter."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def boundary_minutes(start: Column, end: Column) -> Column:
    """Minute boundaries crossed: 00:00:59 to 00:01:00 is one minute."""
    micros = F.unix_micros(F.date_trunc("MINUTE", end)) - F.unix_micros(F.date_trunc("MINUTE", start))
    return (micros / F.lit(60_000_000)).cast("long")


def elapsed_minutes(start: Column, end: Column) -> Column:
    """Whole minutes elapsed: 00:00:59 to 00:01:00 is none."""
    return F.timestamp_diff("MINUTE", start, end)


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Null where the denominator is zero."""
    return F.try_divide(numerator, denominator)


def total(columns: Iterable[Column]) -> Column:
    """Left-to-right sum; null as soon as one term is null."""
    return reduce(lambda left, right: left + right, columns)


def linear(weights: Mapping[str, float], values: Mapping[str, Column] | None = None) -> Column:
    """Sum of weight times column, without an intercept."""
    return total(
        F.lit(float(weight)) * (values[name] if values else F.col(name))
        for name, weight in weights.items()
    )


def sigmoid(logit: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))


def class_above(probability: Column, cut: float = 0.5) -> Column:
    """1 strictly above the cut; used by the label and concept metrics."""
    return (probability > F.lit(cut)).cast("int")


def class_at_least(probability: Column, cut: float = 0.5) -> Column:
    """1 at or above the cut; used by mutual information and outcome tags."""
    return (probability >= F.lit(cut)).cast("int")


def min_max_scaled(column: Column, low: float, high: float) -> Column:
    """Bounds mapped to 0 and 1, unclipped; a constant column becomes 0.

    Multiplying by the inverse range keeps a column without nulls free of
    null checks in the generated code, which a division would not.
    """
    inverse = 0.0 if high == low else 1.0 / (high - low)
    return (column - F.lit(low)) * F.lit(inverse)


def min_max_restored(column: Column, low: float, high: float) -> Column:
    return column * F.lit(high - low) + F.lit(low)
