"""Table sinks: append-only label tables that may be re-run, and fitted weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from wardframe.fixed_values import KEY
from wardframe.sources.readers import read_csv, read_parquet

_CSV = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def write_csv(df: DataFrame, path: str) -> None:
    """CSV that ``read_csv`` restores: quotes, line breaks and outer blanks included."""
    df.write.csv(path, **_CSV)


def existing_labels(spark: SparkSession, path: str, like: DataFrame, fmt: str = "parquet") -> DataFrame | None:
    """The label table written so far, or None before the first write."""
    try:
        return read_csv(spark, path, like.schema) if fmt == "csv" else read_parquet(spark, path, like.schema)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def label_keys(labels: DataFrame, key: str = KEY) -> list[str]:
    """What names a label: the key, and the concept where the table holds several."""
    return [key, *(["concept"] if "concept" in labels.columns else [])]


def append_labels(
    labels: DataFrame, path: str, keys: str | Sequence[str] | None = None, fmt: str = "parquet"
) -> None:
    """Append the rows whose keys (``label_keys`` if not given) the table does not hold yet.

    A run that is repeated after a failure therefore adds no row twice, and
    keys doubled within ``labels`` are added once. Each CSV part file carries
    its own header.
    """
    keys = label_keys(labels) if keys is None else [keys] if isinstance(keys, str) else list(keys)
    written = existing_labels(labels.sparkSession, path, labels, fmt)
    fresh = labels.dropDuplicates(keys)
    if written is not None:
        fresh = fresh.join(written.select(*keys), keys, "left_anti")
    writer = fresh.write.mode("append")
    if fmt == "csv":
        writer.csv(path, **_CSV)
    else:
        writer.parquet(path)

