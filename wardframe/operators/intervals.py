"""Aggregates over start/end intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardframe.fixed_values import INVASIVE_STATUS
from wardframe.functions.measures import boundary_minutes, elapsed_minutes, safe_divide


def invasive_minutes(ventilation: DataFrame, status: str = INVASIVE_STATUS) -> DataFrame:
    """Minutes of invasive ventilation per stay."""
    minutes = boundary_minutes(F.col("starttime"), F.col("endtime"))
    return (
        ventilation.where(F.col("ventilation_status") == status)
        .groupBy("stay_id")
        .agg(F.sum(minutes).alias("mech_vent_duration_minutes"))
    )


def dose_summary(vasopressor: DataFrame) -> DataFrame:
    """Time-weighted mean (null without a whole minute) and peak dose per stay."""
    minutes = elapsed_minutes(F.col("starttime"), F.col("endtime"))
    dose = F.col("norepinephrine_equivalent_dose")
    return vasopressor.groupBy("stay_id").agg(
        safe_divide(F.sum(dose * minutes), F.sum(minutes)).alias("time_weighted_avg_norepi"),
        F.max(dose).alias("max_norepi"),
    )
