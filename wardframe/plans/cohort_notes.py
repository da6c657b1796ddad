"""Discharge, radiology and ECG texts of each admission."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardframe.operators.keys import restricted, unique_rows
from wardframe.operators.notes import ecg_by_patient, radiology_by_admission


def patient_reports(cohort: DataFrame, ecg: DataFrame) -> DataFrame:
    """Every admission with all ECG reports of its patient."""
    per_patient = restricted(ecg_by_patient(ecg), cohort, "subject_id")
    return cohort.select("hadm_id", "subject_id").join(per_patient, "subject_id")


def cohort_notes(
    cohort: DataFrame, discharge: DataFrame, radiology: DataFrame, ecg: DataFrame, ordered: bool = True
) -> DataFrame:
    """One row per admission and discharge note.

    Each kind of note is joined into one text before it meets the cohort, so
    no note is multiplied by the notes of another kind. An admission with two
    discharge notes has two rows, one without any note has one row of nulls.
    """
    admissions = unique_rows(cohort.select("hadm_id", "subject_id"), "hadm_id")
    discharge_notes = discharge.select(
        "hadm_id", F.col("note_id").alias("discharge_note_id"), F.col("text").alias("discharge_text")
    )
    notes = (
        admissions.join(restricted(radiology_by_admission(radiology), cohort, "hadm_id"), "hadm_id", "left")
        .join(discharge_notes, "hadm_id", "left")
        .join(restricted(ecg_by_patient(ecg), cohort, "subject_id"), "subject_id", "left")
        .select(
            "hadm_id",
            "discharge_note_id",
            "discharge_text",
            "radiology_note_ids",
            "radiology_texts",
            "ecd_study_ids",
            "ecd_combined_reports",
        )
    )
    return notes.orderBy("hadm_id") if ordered else notes
