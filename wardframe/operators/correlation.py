"""Pairwise Pearson correlation from a distributed matrix product."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardframe.operators.sums import batch_totals


def column_means(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    row = df.agg(*(F.avg(F.col(c).cast("double")).alias(c) for c in columns)).first()
    return {c: row[c] if row[c] is not None else 0.0 for c in columns}


def product_sums(df: DataFrame, columns: Sequence[str], centre: Mapping[str, float]) -> np.ndarray:
    """Sum over rows of the outer product of the centred columns.

    Matrix products of Arrow batches, added up by Spark. One aggregate with an
    expression per pair would be too wide to compile.
    """
    names, size = list(columns), len(columns)
    shift = np.array([centre[c] for c in names])

    def products(batch: np.ndarray) -> np.ndarray:
        centred = batch - shift
        return (centred.T @ centred).ravel()

    values = df.select(*(F.col(c).cast("double").alias(c) for c in names))
    return batch_totals(values, size * size, products).reshape(size, size)


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> dict[tuple[str, str], float | None]:
    """Correlation of each ordered pair; None where a column is constant."""
    sums = product_sums(df, columns, column_means(df, columns))
    spread = np.sqrt(np.diag(sums))
    # a column whose spread is rounding noise counts as constant
    constant = spread <= 1e-12 * max(1.0, float(spread.max(initial=0.0)))
    result: dict[tuple[str, str], float | None] = {}
    for i, a in enumerate(columns):
        for j, b in enumerate(columns):
            flat = constant[i] or constant[j]
            result[a, b] = None if flat else float(sums[i, j] / (spread[i] * spread[j]))
    return result


def correlation_long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The matrix as rows (concept_a, concept_b, r)."""
    rows = [(a, b, r) for (a, b), r in correlation_matrix(df, columns).items()]
    return df.sparkSession.createDataFrame(rows, "concept_a string, concept_b string, r double")
