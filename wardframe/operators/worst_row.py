"""Worst hourly score per stay with the measurements of that very row."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardframe.fixed_values import FIRST_DAY_HOURS
from wardframe.operators.keys import restricted

RATIO = "pao2fio2ratio"


@dataclass(frozen=True)
class Organ:
    """A score column and, per companion column, its output names."""

    score: str
    worst: str
    first_day: str
    companions: dict[str, tuple[str, str]]  # source: (worst name, first-day name)


ORGANS = (
    Organ(
        "cns",
        "c_sofa_max_cns",
        "c_first24hr_sofa_max_cns",
        {"gcs_min": ("sofa_cns_worst_gcs", "first24hr_cns_gcs")},
    ),
    Organ(
        "renal",
        "c_sofa_max_renal",
        "c_first24hr_sofa_max_renal",
        {
            "creatinine_max": ("sofa_renal_worst_creatinine", "first24hr_renal_creatinine"),
            "uo_24hr": ("sofa_renal_worst_urineoutput", "first24hr_renal_urineoutput"),
        },
    ),
    Organ(
        "respiration",
        "c_sofa_max_respiration",
        "c_first24hr_sofa_max_respiration",
        {RATIO: ("sofa_respiration_worst_pao2fio2ratio", "first24hr_respiration_pao2fio2ratio")},
    ),
    Organ(
        "cardiovascular",
        "c_sofa_max_cardiovascular",
        "c_first24hr_sofa_max_cardiovascular",
        {
            "meanbp_min": ("sofa_cardiovascular_worst_meanbp", "first24hr_cardiovascular_meanbp"),
            "rate_norepinephrine": (
                "sofa_cardiovascular_worst_rate_norepinephrine",
                "first24hr_cardiovascular_rate_norepinephrine",
            ),
        },
    ),
)

AVERAGES = {
    "cns": "c_sofa_avg_cns",
    "gcs_min": "sofa_cns_avg_gcs",
    "renal": "c_sofa_avg_renal",
    "creatinine_max": "sofa_renal_avg_creatinine",
    "uo_24hr": "sofa_renal_avg_urineoutput",
    "respiration": "c_sofa_avg_respiration",
    RATIO: "sofa_respiration_avg_pao2fio2ratio",
    "cardiovascular": "c_sofa_avg_cardiovascular",
    "meanbp_min": "sofa_cardiovascular_avg_meanbp",
    "rate_norepinephrine": "sofa_cardiovascular_avg_rate_norepinephrine",
}


def with_ratio(sofa: DataFrame) -> DataFrame:
    """The ventilated ratio where there is one, else the other."""
    return sofa.withColumn(RATIO, F.coalesce("pao2fio2ratio_vent", "pao2fio2ratio_novent"))


def _pick(organ: Organ, first_day: bool) -> tuple[str, str, dict[str, str]]:
    if first_day:
        return f"{organ.score}_24hours", organ.first_day, {s: n[1] for s, n in organ.companions.items()}
    return organ.score, organ.worst, {s: n[0] for s, n in organ.companions.items()}


def _worst(organ: Organ, first_day: bool) -> Column:
    """Struct maximum: highest score, then earliest hour, then the companions.

    Null scores sort lowest but their struct survives, so a stay without any
    score still yields its companions.
    """
    score, _, companions = _pick(organ, first_day)
    row = F.struct(F.col(score), (-F.col("hr")).alias("earliest"), *companions)
    return F.max(F.when(F.col("hr") < FIRST_DAY_HOURS, row) if first_day else row)


def stay_summary(
    sofa: DataFrame,
    worst: bool = True,
    first_day: bool = True,
    averages: bool = True,
    cohort: DataFrame | None = None,
) -> DataFrame:
    """Worst rows, worst rows of the first day and averages in one aggregate.

    One exchange with a map-side combine; the alternative is a window per
    organ and a join per metric. A cohort restricts the stays right above the
    aggregate, where the optimizer can still move the semi-join below it.
    """
    picks = [(o, d) for d, wanted in ((False, worst), (True, first_day)) if wanted for o in ORGANS]
    aggregates = [_worst(o, d).alias(f"{o.score}_{int(d)}") for o, d in picks]
    if averages:
        aggregates += [F.avg(source).alias(name) for source, name in AVERAGES.items()]
    columns = [F.col("stay_id")]
    for organ, day in picks:
        score, score_name, companions = _pick(organ, day)
        column = F.col(f"{organ.score}_{int(day)}")
        columns.append(column[score].alias(score_name))
        columns += [column[source].alias(name) for source, name in companions.items()]
    if averages:
        columns += [F.col(name) for name in AVERAGES.values()]
    summary = with_ratio(sofa).groupBy("stay_id").agg(*aggregates)
    if cohort is not None:
        summary = restricted(summary, cohort, "stay_id")
    return summary.select(*columns)


def worst_row_by_window(sofa: DataFrame, organ: Organ, first_day: bool = False) -> DataFrame:
    """The same rows through ROW_NUMBER, for one organ."""
    score, score_name, companions = _pick(organ, first_day)
    rows = with_ratio(sofa)
    if first_day:
        rows = rows.where(F.col("hr") < FIRST_DAY_HOURS)
    order = [F.col(score).desc(), F.col("hr").asc_nulls_last(), *(F.col(c).desc() for c in companions)]
    ranked = rows.withColumn("rn", F.row_number().over(Window.partitionBy("stay_id").orderBy(*order)))
    return ranked.where("rn = 1").select(
        "stay_id",
        F.col(score).alias(score_name),
        *(F.col(source).alias(name) for source, name in companions.items()),
    )
