"""Input schemas, declared so that no source needs inference."""

from __future__ import annotations

from pyspark.sql import types as T

from wardframe.fixed_values import (
    C_BINARY,
    C_CONTINUOUS,
    C_TEXT,
    KEY,
    LABEL,
    REPORT_COLUMNS,
    X_BINARY,
    X_CONTINUOUS,
)


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_LONG, _INT, _DOUBLE, _TEXT, _TIME = (
    T.LongType(),
    T.IntegerType(),
    T.DoubleType(),
    T.StringType(),
    T.TimestampNTZType(),
)

COHORT = _schema(hadm_id=_LONG, stay_id=_LONG, subject_id=_LONG, **{LABEL: _INT})
COHORT_UNLABELLED = _schema(hadm_id=_LONG, stay_id=_LONG, subject_id=_LONG)
DIAGNOSES = _schema(hadm_id=_LONG, icd_code=_TEXT, icd_version=_INT)
VENTILATION = _schema(stay_id=_LONG, starttime=_TIME, endtime=_TIME, ventilation_status=_TEXT)
SOFA = _schema(
    stay_id=_LONG,
    hr=_INT,
    cns=_INT,
    renal=_INT,
    respiration=_INT,
    cardiovascular=_INT,
    cns_24hours=_INT,
    renal_24hours=_INT,
    respiration_24hours=_INT,
    cardiovascular_24hours=_INT,
    gcs_min=_DOUBLE,
    creatinine_max=_DOUBLE,
    uo_24hr=_DOUBLE,
    pao2fio2ratio_vent=_DOUBLE,
    pao2fio2ratio_novent=_DOUBLE,
    meanbp_min=_DOUBLE,
    rate_norepinephrine=_DOUBLE,
)
VASOPRESSOR = _schema(
    stay_id=_LONG, starttime=_TIME, endtime=_TIME, norepinephrine_equivalent_dose=_DOUBLE
)
ECG = _schema(
    subject_id=_LONG, study_id=_LONG, **{f"report_{i}": _TEXT for i in range(REPORT_COLUMNS)}
)
DISCHARGE = _schema(hadm_id=_LONG, note_id=_TEXT, text=_TEXT)
RADIOLOGY = DISCHARGE
COHORT_NOTES = _schema(
    hadm_id=_LONG,
    discharge_note_id=_TEXT,
    discharge_text=_TEXT,
    radiology_note_ids=_TEXT,
    radiology_texts=_TEXT,
    ecd_study_ids=_TEXT,
    ecd_combined_reports=_TEXT,
)
MODELLING = _schema(
    **{KEY: _LONG},
    **{c: _DOUBLE for c in X_CONTINUOUS},
    **{c: _INT for c in X_BINARY},
    **{c: _DOUBLE for c in C_CONTINUOUS},
    **{c: _INT for c in C_BINARY},
    **{c: _INT for c in C_TEXT},
    **{LABEL: _INT},
)
