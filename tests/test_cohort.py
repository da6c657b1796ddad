"""Hand-written clinical rows for every null, boundary and tie rule."""

from __future__ import annotations

import datetime as dt

import pytest

from wardframe import schemas
from wardframe.operators.classify import group_flags, split_codes
from wardframe.operators.intervals import dose_summary, invasive_minutes
from wardframe.operators.keys import first_per_key, unique_rows
from wardframe.operators.worst_row import ORGANS, stay_summary, worst_row_by_window
from wardframe.plans.cohort_features import (
    ClinicalTables,
    cohort_features,
    comorbidities,
    score_columns,
    vasopressor_doses,
    ventilation_minutes,
)


def at(clock: str, day: int = 1) -> dt.datetime:
    return dt.datetime.fromisoformat(f"2020-01-{day:02d} {clock}")


COHORT = [(1, 101, 11, 1), (2, 102, 12, 0), (3, 103, 13, 1), (4, 104, 11, 0), (5, 105, 14, 0)]


@pytest.fixture(scope="module")
def cohort(spark):
    return spark.createDataFrame(COHORT, schemas.COHORT)


@pytest.fixture(scope="module")
def diagnoses(spark):
    rows = [
        (1, "4660", 9),  # upper and acute lower
        (2, "487", 9),  # influenza and pneumonia
        (2, "488", 9),  # no group
        (2, "J22", 10),  # acute lower
        (2, "51881", 9),  # other
        (3, "J23", 10),  # no group
        (3, "J22", 9),  # right code, wrong system
        (4, "J00", 10),
        (4, "J06", 10),
        (9, "J18", 10),  # not in the cohort
    ]
    return spark.createDataFrame(rows, schemas.DIAGNOSES)


def rows(df, *key):
    return {tuple(r[k] for k in key) if len(key) > 1 else r[key[0]]: r.asDict() for r in df.collect()}


def test_code_groups(diagnoses):
    flags = rows(group_flags(split_codes(diagnoses)), "hadm_id")
    assert flags[1]["upper_respiratory_infections"] == 1
    assert flags[1]["acute_lower_respiratory_infections"] == 1
    assert flags[1]["influenza_pneumonia"] == 0
    assert [flags[2][c] for c in ("influenza_pneumonia", "acute_lower_respiratory_infections", "other_respiratory_diseases")] == [1, 1, 1]
    assert sum(v for k, v in flags[3].items() if k != "hadm_id") == 0
    assert flags[4]["upper_respiratory_infections"] == 1
    assert flags[9]["influenza_pneumonia"] == 1


def test_severity_bands_and_missing_diagnoses(cohort, diagnoses):
    bands = rows(comorbidities(cohort, diagnoses), "hadm_id")
    assert sorted(bands) == [1, 2, 3, 4, 5]
    assert [(bands[h]["c_mod_resp_comorbidity"], bands[h]["c_svr_resp_comorbidity"]) for h in (1, 2, 3, 4)] == [
        (1, 0),
        (0, 1),
        (0, 0),
        (1, 0),
    ]
    # no diagnosis at all: flags unknown, bands zero
    assert bands[5]["influenza_pneumonia"] is None
    assert (bands[5]["c_mod_resp_comorbidity"], bands[5]["c_svr_resp_comorbidity"]) == (0, 0)


def test_ventilation_counts_minute_boundaries(spark, cohort):
    table = spark.createDataFrame(
        [
            (101, at("00:00:59"), at("00:01:00"), "InvasiveVent"),
            (101, at("10:00:00"), at("11:30:59"), "InvasiveVent"),
            (102, at("00:00:00"), at("05:00:00"), "NonInvasiveVent"),
            (103, at("00:00:00"), None, "InvasiveVent"),
        ],
        schemas.VENTILATION,
    )
    assert rows(invasive_minutes(table), "stay_id")[101]["mech_vent_duration_minutes"] == 91
    minutes = rows(ventilation_minutes(cohort, table), "hadm_id")
    assert [minutes[h]["mech_vent_duration_minutes"] for h in (1, 2, 3, 4)] == [91, 0, 0, 0]


def test_doses_weigh_whole_minutes(spark, cohort):
    table = spark.createDataFrame(
        [
            (101, at("00:00:00"), at("01:00:00"), 0.1),
            (101, at("01:00:00"), at("04:00:00"), 0.5),
            (101, at("05:00:59"), at("05:01:00"), 9.0),  # under a minute: peak only
            (102, at("00:00:00"), at("00:00:00"), 2.0),
            (999, at("00:00:00"), at("01:00:00"), 7.0),
        ],
        schemas.VASOPRESSOR,
    )
    summary = rows(dose_summary(table), "stay_id")
    assert summary[101]["time_weighted_avg_norepi"] == pytest.approx(0.4)
    assert summary[102]["time_weighted_avg_norepi"] is None
    doses = rows(vasopressor_doses(cohort, table), "hadm_id")
    assert doses[1]["max_norepinephrine_equiv"] == 9.0
    assert (doses[2]["avg_norepinephrine_equiv"], doses[2]["max_norepinephrine_equiv"]) == (0.0, 2.0)
    assert (doses[3]["avg_norepinephrine_equiv"], doses[3]["max_norepinephrine_equiv"]) == (0.0, 0.0)
    assert sorted(doses) == [1, 2, 3, 4, 5]


def sofa_row(stay, hr, cns=None, cns24=None, gcs=None, vent=None, novent=None, resp=None):
    values = dict.fromkeys(schemas.SOFA.names)
    values |= {"stay_id": stay, "hr": hr, "cns": cns, "cns_24hours": cns24, "gcs_min": gcs}
    values |= {"pao2fio2ratio_vent": vent, "pao2fio2ratio_novent": novent, "respiration": resp}
    return tuple(values.values())


@pytest.fixture(scope="module")
def sofa(spark):
    return spark.createDataFrame(
        [
            sofa_row(101, 5, cns=3, cns24=1, gcs=9.0),  # tie on the score: the earlier hour wins
            sofa_row(101, 2, cns=3, cns24=2, gcs=11.0),
            sofa_row(101, 23, cns=1, cns24=4, gcs=6.0),  # still the first day
            sofa_row(101, 24, cns=1, cns24=9, gcs=3.0),  # no longer
            sofa_row(102, 1, gcs=14.0),  # no score at all: the row survives
            sofa_row(102, 0, gcs=13.0),
            sofa_row(103, 30, cns=2, cns24=2, gcs=None),  # worst row without companion, no first day
            sofa_row(103, 31, cns=1, cns24=1, gcs=8.0),
            sofa_row(104, 0, resp=2, vent=None, novent=None),
            sofa_row(104, 1, resp=4, vent=None, novent=210.0),
            sofa_row(104, 2, resp=3, vent=100.0, novent=300.0),
        ],
        schemas.SOFA,
    )


def test_worst_rows(sofa):
    summary = rows(stay_summary(sofa), "stay_id")
    one = summary[101]
    assert (one["c_sofa_max_cns"], one["sofa_cns_worst_gcs"]) == (3, 11.0)
    assert (one["c_first24hr_sofa_max_cns"], one["first24hr_cns_gcs"]) == (4, 6.0)
    assert one["sofa_cns_avg_gcs"] == pytest.approx(29 / 4)
    assert (summary[102]["c_sofa_max_cns"], summary[102]["sofa_cns_worst_gcs"]) == (None, 13.0)
    three = summary[103]
    assert (three["c_sofa_max_cns"], three["sofa_cns_worst_gcs"]) == (2, None)
    assert (three["c_first24hr_sofa_max_cns"], three["first24hr_cns_gcs"]) == (None, None)
    four = summary[104]
    assert (four["c_sofa_max_respiration"], four["sofa_respiration_worst_pao2fio2ratio"]) == (4, 210.0)
    assert four["sofa_respiration_avg_pao2fio2ratio"] == pytest.approx(155.0)


@pytest.mark.parametrize("first_day", [False, True])
def test_struct_and_window_agree(sofa, first_day):
    summary = stay_summary(sofa)
    for organ in ORGANS:
        window = worst_row_by_window(sofa, organ, first_day)
        stays = rows(window, "stay_id")
        for stay, row in rows(summary.select(*window.columns), "stay_id").items():
            assert row == stays.get(stay, {**dict.fromkeys(row), "stay_id": stay})


def test_cohort_features(spark, cohort, diagnoses, sofa):
    tables = ClinicalTables(
        cohort,
        diagnoses,
        spark.createDataFrame([(101, at("00:00:59"), at("00:01:00"), "InvasiveVent")], schemas.VENTILATION),
        sofa,
        spark.createDataFrame([(101, at("00:00:00"), at("01:00:00"), 0.1)], schemas.VASOPRESSOR),
    )
    wide = cohort_features(tables)
    assert len(wide.columns) == 45
    collected = wide.collect()
    assert [r["hadm_id"] for r in collected] == [1, 2, 3, 4, 5]
    assert collected[0]["mech_vent_duration_minutes"] == 1
    assert collected[4]["max_norepinephrine_equiv"] == 0.0
    assert all(collected[4][c] is None for c in score_columns())
    assert len(cohort_features(tables, label=None).columns) == 44


def test_duplicate_admissions_are_rejected(spark):
    twice = spark.createDataFrame([*COHORT, (1, 106, 11, 1)], schemas.COHORT)
    with pytest.raises(Exception, match="duplicate hadm_id: 1"):
        unique_rows(twice, "hadm_id").collect()


def test_first_row_per_key(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "z"), (1, 1, "a"), (2, 5, None)], "k int, at int, v string")
    assert {tuple(r) for r in first_per_key(df, "k", ["at"]).collect()} == {(1, 1, "a"), (2, 5, None)}
