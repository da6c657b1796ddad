"""One wide feature row per admission."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardframe.fixed_values import LABEL, RESPIRATORY_CODE_GROUPS
from wardframe.operators.classify import group_flags, severity_bands, split_codes
from wardframe.operators.intervals import dose_summary, invasive_minutes
from wardframe.operators.keys import restricted, unique_rows
from wardframe.operators.worst_row import AVERAGES, ORGANS, stay_summary


@dataclass(frozen=True)
class ClinicalTables:
    cohort: DataFrame
    diagnoses: DataFrame
    ventilation: DataFrame
    sofa: DataFrame
    vasopressor: DataFrame


def comorbidities(cohort: DataFrame, diagnoses: DataFrame) -> DataFrame:
    """Six group flags and two severity bands per admission of the cohort."""
    return with_bands(cohort, restricted(group_flags(split_codes(diagnoses)), cohort, "hadm_id"))


def with_bands(cohort: DataFrame, flags: DataFrame) -> DataFrame:
    """An admission without any diagnosis keeps null flags and gets bands of 0."""
    return cohort.join(flags, "hadm_id", "left").select(
        *cohort.columns, *RESPIRATORY_CODE_GROUPS, *severity_bands()
    )


def ventilation_minutes(cohort: DataFrame, ventilation: DataFrame) -> DataFrame:
    """Invasive ventilation per admission, 0 without any."""
    minutes = restricted(invasive_minutes(ventilation), cohort, "stay_id")
    name = "mech_vent_duration_minutes"
    return cohort.join(minutes, "stay_id", "left").select(
        *cohort.columns, F.coalesce(name, F.lit(0)).alias(name)
    )


def vasopressor_doses(cohort: DataFrame, vasopressor: DataFrame) -> DataFrame:
    """Time-weighted and peak dose per admission, 0 without any."""
    doses = restricted(dose_summary(vasopressor), cohort, "stay_id")
    return cohort.join(doses, "stay_id", "left").select(
        *cohort.columns,
        F.coalesce("time_weighted_avg_norepi", F.lit(0.0)).alias("avg_norepinephrine_equiv"),
        F.coalesce("max_norepi", F.lit(0.0)).alias("max_norepinephrine_equiv"),
    )


def score_metrics(cohort: DataFrame, sofa: DataFrame) -> DataFrame:
    """All hourly-score metrics of the stays in the cohort."""
    return stay_summary(sofa, cohort=cohort)


def score_columns() -> list[str]:
    """Metric columns in output order: worst, first day, averages, organ by organ."""
    worst = [n for o in ORGANS for n in (*(w for w, _ in o.companions.values()), o.worst)]
    first = [n for o in ORGANS for n in (*(d for _, d in o.companions.values()), o.first_day)]
    return [*worst, *first, *AVERAGES.values()]


def cohort_features(tables: ClinicalTables, label: str | None = LABEL, ordered: bool = True) -> DataFrame:
    """The cohort with every per-admission and per-stay aggregate joined on.

    ``label=None`` serves an unlabelled cohort. Each branch is aggregated to
    one row per key before it meets the cohort; the stay-level branches share
    the cohort's partitioning by stay.
    """
    ids = ["hadm_id", "stay_id", "subject_id", *([label] if label else [])]
    cohort = unique_rows(tables.cohort.select(*ids), "hadm_id")
    # the branches are restricted by the plain cohort: a semi-join needs no unique keys
    flags = restricted(group_flags(split_codes(tables.diagnoses)), tables.cohort, "hadm_id")
    wide = with_bands(cohort, flags)
    for branch in (
        restricted(invasive_minutes(tables.ventilation), tables.cohort, "stay_id"),
        score_metrics(tables.cohort, tables.sofa),
        restricted(dose_summary(tables.vasopressor), tables.cohort, "stay_id"),
    ):
        wide = wide.join(branch, "stay_id", "left")
    result = wide.select(
        *ids,
        *RESPIRATORY_CODE_GROUPS,
        "c_mod_resp_comorbidity",
        "c_svr_resp_comorbidity",
        F.coalesce("mech_vent_duration_minutes", F.lit(0)).alias("mech_vent_duration_minutes"),
        *score_columns(),
        F.coalesce("time_weighted_avg_norepi", F.lit(0.0)).alias("avg_norepinephrine_equiv"),
        F.coalesce("max_norepi", F.lit(0.0)).alias("max_norepinephrine_equiv"),
    )
    return result.orderBy("hadm_id") if ordered else result
