"""Key handling: restriction to a cohort, uniqueness, first row, bounded batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def restricted(aggregated: DataFrame, cohort: DataFrame, key: str) -> DataFrame:
    """Keep the aggregated keys that the cohort holds.

    Written above the aggregate on purpose. The optimizer moves a semi-join
    below an aggregate only when the cohort is small enough to broadcast, and
    then filters the facts in their scan stage. With a larger cohort it stays
    here, where each key is one row, so a hot key never crosses a shuffle
    unaggregated.
    """
    return aggregated.join(cohort.select(key), key, "left_semi")


def unique_rows(df: DataFrame, key: str) -> DataFrame:
    """``df`` itself, failing the query if a key occurs twice."""
    others = [c for c in df.columns if c != key]
    counted = df.groupBy(key).agg(
        *(F.first(c).alias(c) for c in others), F.count(F.lit(1)).alias("copies")
    )
    message = F.concat(F.lit(f"duplicate {key}: "), F.col(key).cast("string"))
    alone = F.when(F.col("copies") == 1, True).otherwise(F.raise_error(message).cast("boolean"))
    return counted.where(alone).select(*df.columns)


def first_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each key, by the order columns, then by the rest."""
    rest = [c for c in df.columns if c != key and c not in order]
    return (
        df.groupBy(key)
        .agg(F.min(F.struct(*order, *rest)).alias("row"))
        .select(key, *(F.col("row")[c].alias(c) for c in (*order, *rest)))
        .select(*df.columns)
    )


def first_rows(df: DataFrame, order: list[str | Column], rows: int, start: int = 0) -> DataFrame:
    """A bounded batch: ``rows`` rows in order, from number ``start`` on."""
    return df.orderBy(*order).offset(start).limit(rows)
