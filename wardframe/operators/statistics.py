"""Column statistics of a split, exact at any size.

The statistics are a few numbers per column, so they are fetched and become
literals of the plans that use them; the rows never leave the executors.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardframe.session import compiled_methods

# The rank error of the sketch is at most rows / ACCURACY; the margin doubles
# that. Counts tell whether an enclosure holds the wanted ranks, and one that
# does not (among few rows the neighbouring rank can be outside) is widened.
ACCURACY = 1_000
_MARGIN = 2.0 / ACCURACY
STEPS = 1_000
QUARTILES = (0.25, 0.5, 0.75)


@dataclass(frozen=True)
class ColumnStats:
    """What one column holds in a split; None where it holds no value."""

    count: int
    mean: float | None
    std: float | None
    low: float | None
    high: float | None
    quantiles: dict[float, float | None]

    @property
    def median(self) -> float | None:
        return self.quantiles.get(0.5)


def _long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (slot, v), one per listed column that holds a value."""
    entries = [
        F.struct(F.lit(slot).alias("slot"), F.col(name).cast("double").alias("v"))
        for slot, name in enumerate(columns)
    ]
    return df.select(F.inline(F.array(*entries))).where(F.col("v").isNotNull())


def column_stats(
    df: DataFrame, columns: Sequence[str], quantiles: Sequence[float] = (0.5,)
) -> dict[str, ColumnStats]:
    """Count, mean, sample deviation, bounds and exact interpolated quantiles.

    The first pass also takes sketch quantiles that enclose each exact one
    between two values. A wide aggregate then counts the values below and in
    each enclosure. Only values inside one, a few thousandths, become rows of
    the last pass, and the values at the wanted ranks are read off their
    running counts. An exact percentile aggregate would hold every distinct
    value in one task instead.
    """
    shares = sorted({p for q in quantiles for p in (max(0.0, q - _MARGIN), min(1.0, q + _MARGIN))})
    value = F.col("v")
    aggregates = [
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("low"),
        F.max(value).alias("high"),
    ]
    if shares:
        aggregates.append(F.percentile_approx(value, shares, ACCURACY).alias("marks"))
    with compiled_methods(df.sparkSession):
        rows = _long(df, columns).groupBy("slot").agg(*aggregates).collect()  # one row per column
    found = {columns[row["slot"]]: row for row in rows}
    wanted = {}
    for name, row in found.items():
        marks = dict(zip(shares, row["marks"], strict=True)) if shares else {}
        for q in quantiles:
            lower, upper = max(0.0, q - _MARGIN), min(1.0, q + _MARGIN)
            wanted[name, q] = Enclosure(
                row["low"] if lower == 0.0 else marks[lower],
                row["high"] if upper == 1.0 else marks[upper],
                q * (row["count"] - 1),
            )
    bounds = {name: (row["low"], row["high"]) for name, row in found.items()}
    exact = exact_quantiles(df, wanted, bounds)
    stats = {}
    for name in columns:
        row = found.get(name)
        own = {q: exact.get((name, q)) for q in quantiles}
        if row is None:
            stats[name] = ColumnStats(0, None, None, None, None, own)
        else:
            stats[name] = ColumnStats(row["count"], row["mean"], row["std"], row["low"], row["high"], own)
    return stats


@dataclass(frozen=True)
class Enclosure:
    """Two values around a fractional rank, and how many values lie below the first."""

    low: float
    high: float
    rank: float
    below: int = 0


Wanted = dict[tuple[str, float], Enclosure]


def exact_quantiles(
    df: DataFrame, wanted: Wanted, bounds: dict[str, tuple[float, float]]
) -> dict[tuple[str, float], float]:
    """Values at the wanted ranks; an enclosure that misses its ranks gives way to the column's bounds."""
    return _at_ranks(df, _holding(df, wanted, bounds))


def _inside(name: str, e: Enclosure) -> Column:
    value = F.col(name).cast("double")
    return (value >= F.lit(e.low)) & (value <= F.lit(e.high))


def _holding(df: DataFrame, wanted: Wanted, bounds: dict[str, tuple[float, float]]) -> Wanted:
    """The enclosures with their counts; one that misses its ranks takes the column's bounds."""
    if not wanted:
        return {}
    counts = []
    for i, ((name, _), e) in enumerate(wanted.items()):
        counts.append(F.count_if(F.col(name).cast("double") < F.lit(e.low)).alias(f"below{i}"))
        counts.append(F.count_if(_inside(name, e)).alias(f"inside{i}"))
    with compiled_methods(df.sparkSession):
        row = df.agg(*counts).first()
    holding = {}
    for i, ((name, q), e) in enumerate(wanted.items()):
        below, inside = row[f"below{i}"], row[f"inside{i}"]
        if below <= math.floor(e.rank) and below + inside > math.ceil(e.rank):
            holding[name, q] = Enclosure(e.low, e.high, e.rank, below)
        else:
            holding[name, q] = Enclosure(*bounds[name], e.rank)
    return holding


def _at_ranks(df: DataFrame, wanted: Wanted) -> dict[tuple[str, float], float]:
    """Values at fractional ranks, each held by its enclosure."""
    if not wanted:
        return {}
    slots = list(wanted)
    by_column: dict[str, list[int]] = {}
    for slot, (name, _) in enumerate(slots):
        by_column.setdefault(name, []).append(slot)
    # null where a value is in no enclosure, and then never a row
    entries = []
    for name, own in by_column.items():
        near = [F.when(_inside(name, wanted[slots[i]]), F.lit(i)) for i in own]
        held = F.when(reduce(Column.__or__, (_inside(name, wanted[slots[i]]) for i in own)), F.array_compact(F.array(*near)))
        entries.append(F.when(held.isNotNull(), F.struct(held.alias("slots"), F.col(name).cast("double").alias("v"))))
    rows = df.select(F.inline(F.array_compact(F.array(*entries)))).select(F.explode("slots").alias("slot"), "v")
    counted = rows.groupBy("slot", "v").agg(F.count(F.lit(1)).alias("n"))

    def per_slot(values: Sequence[float]) -> Column:
        return F.get(F.array(*(F.lit(float(v)) for v in values)), F.col("slot"))

    enclosures = [wanted[s] for s in slots]
    lower, upper = per_slot([e.low for e in enclosures]), per_slot([e.high for e in enclosures])
    first = per_slot([math.floor(e.rank) - e.below for e in enclosures])
    last = per_slot([math.ceil(e.rank) - e.below for e in enclosures])
    # running counts over a fixed number of equal steps, then inside the step
    # that holds the rank, so no task orders more than a sliver of the values
    share = F.coalesce(F.try_divide(F.col("v") - lower, upper - lower), F.lit(0.0))
    # never null, so that both uses below share one exchange of the counts
    stepped = counted.withColumn("step", F.coalesce(F.floor(share * (STEPS - 1)), F.lit(-1)))
    earlier = Window.partitionBy("slot").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    steps = (
        stepped.groupBy("slot", "step")
        .agg(F.sum("n").alias("held"))
        .withColumn("before", F.coalesce(F.sum("held").over(earlier), F.lit(0)))
        .where((F.col("before") <= last) & (F.col("before") + F.col("held") > first))
        .select("slot", "step", "before")
    )
    within = Window.partitionBy("slot", "step").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    upto = F.col("before") + F.sum("n").over(within)
    running = stepped.join(steps, ["slot", "step"]).withColumn("upto", upto)
    picked = running.groupBy("slot").agg(
        F.min(F.when(F.col("upto") > first, F.col("v"))).alias("below"),
        F.min(F.when(F.col("upto") > last, F.col("v"))).alias("above"),
    )
    with compiled_methods(df.sparkSession):
        rows = picked.collect()  # one row per column and quantile
    result = {}
    for row in rows:
        rank = enclosures[row["slot"]].rank
        result[slots[row["slot"]]] = row["below"] + (row["above"] - row["below"]) * (rank - math.floor(rank))
    return result


def summary_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, bounds and quartiles, one row per column."""
    return summary_table(df.sparkSession, column_stats(df, columns, QUARTILES))


def summary_table(spark: SparkSession, stats: dict[str, ColumnStats]) -> DataFrame:
    """Statistics that hold the quartiles as rows, one per column."""
    rows = [
        (name, s.count, s.mean, s.std, s.low, *(s.quantiles[q] for q in QUARTILES), s.high)
        for name, s in stats.items()
    ]
    schema = (
        "feature string, count long, mean double, std double, min double, "
        "p25 double, p50 double, p75 double, max double"
    )
    return spark.createDataFrame(rows, schema)
