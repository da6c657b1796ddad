"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession

# The JVM never compiles a method above this size, and the generated code of a
# model with dozens of columns exceeds it; Spark then splits it into smaller ones.
_METHOD_LIMIT = ("spark.sql.codegen.hugeMethodLimit", "8000")

# Arrow batches of wide cells (texts, blocks of rows) grow to this size at most; a Python
# worker holds a few times as much.
_BATCH_LIMIT = ("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))

# Timestamps are zone-free in the sources, so UTC keeps minute arithmetic plain.
SETTINGS = {
    _METHOD_LIMIT[0]: _METHOD_LIMIT[1],
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(app: str = "wardframe", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def _set(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def compiled_methods(spark: SparkSession) -> AbstractContextManager[None]:
    """Run wide expressions in methods the JVM compiles, in any session."""
    return _set(spark, *_METHOD_LIMIT)


def small_batches(spark: SparkSession) -> AbstractContextManager[None]:
    """Hand Python workers a few megabytes at a time, however large the cells, in any session."""
    return _set(spark, *_BATCH_LIMIT)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can read, as the session names it.

    Only a local session without the setting gets a folder of its own; on a
    cluster a machine-local folder would not survive a lost executor.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="wardframe-"))
    return context.getCheckpointDir().rstrip("/")


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Later jobs then scan a pruned columnar table instead of recomputing the
    lineage, and losing an executor loses nothing.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    with compiled_methods(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
