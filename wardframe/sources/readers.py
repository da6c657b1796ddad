"""Table sources: typed Parquet and CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from wardframe import schemas
from wardframe.sources.quoted_csv import read_quoted_csv


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, line_breaks: bool = True) -> DataFrame:
    """CSV with a header and quoted fields.

    Where fields may hold line breaks a file is read by one task; without them
    large files are split.
    """
    return spark.read.csv(
        path, schema=schema, header=True, multiLine=line_breaks, quote='"', escape='"', enforceSchema=False
    )


def read_notes_csv(spark: SparkSession, path: str) -> DataFrame:
    """The consolidated notes; a missing text becomes the empty text. A large file is read by many tasks."""
    return read_quoted_csv(spark, path, schemas.COHORT_NOTES).na.fill("")


def read_modelling_csv(spark: SparkSession, path: str) -> DataFrame:
    """The modelling table; it holds numbers only, so its files can be split."""
    return read_csv(spark, path, schemas.MODELLING, line_breaks=False)
