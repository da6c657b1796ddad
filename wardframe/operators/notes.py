"""Joining note texts into one text per admission or patient.

A joined text is one cell, so its size is bounded by what a row can hold; the
labeller in ``wardframe.operators.note_parts`` reads the same text without
building that cell.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardframe.fixed_values import ID_SEPARATOR, NOTE_SEPARATOR, REPORT_COLUMNS
from wardframe.functions.texts import joined_reports


def report_texts(ecg: DataFrame) -> DataFrame:
    """The numbered report columns of each study as one text."""
    reports = [F.col(f"report_{i}") for i in range(REPORT_COLUMNS)]
    return ecg.select(
        "subject_id", F.col("study_id").cast("string").alias("study_id"), joined_reports(reports).alias("report_text")
    )


def joined_ids(column: str, name: str, order: str) -> F.Column:
    return F.expr(f"string_agg({column}, '{ID_SEPARATOR}') WITHIN GROUP (ORDER BY {order})").alias(name)


def joined_texts(column: str, name: str, order: str) -> F.Column:
    return F.expr(f"string_agg({column}, '{NOTE_SEPARATOR}') WITHIN GROUP (ORDER BY {order})").alias(name)


def distinct_ids(column: str, name: str) -> F.Column:
    return F.expr(
        f"string_agg(DISTINCT {column}, '{ID_SEPARATOR}') WITHIN GROUP (ORDER BY {column})"
    ).alias(name)


def radiology_by_admission(radiology: DataFrame) -> DataFrame:
    """All radiology notes of an admission, in note order; null texts are left out."""
    notes = radiology.select("hadm_id", F.col("note_id").cast("string").alias("note_id"), "text")
    return notes.groupBy("hadm_id").agg(
        joined_ids("note_id", "radiology_note_ids", "note_id, text"),
        joined_texts("text", "radiology_texts", "note_id, text"),
    )


def ecg_by_patient(ecg: DataFrame) -> DataFrame:
    """All ECG reports of a patient, joined once however many admissions share them."""
    return (
        report_texts(ecg)
        .groupBy("subject_id")
        .agg(
            distinct_ids("study_id", "ecd_study_ids"),
            joined_texts("report_text", "ecd_combined_reports", "study_id, report_text"),
        )
    )
