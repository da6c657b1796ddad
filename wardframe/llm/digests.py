"""Exact dedup against a persistent index of text digests.

The index is a table bucketed and sorted by digest, so the anti-join that finds
new digests does not shuffle what is already there. Spark does sort each bucket
again: after several appends it holds several sorted files.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardframe.llm.texts import ascii_lower
from wardframe.session import materialize, shared_folder

#: Files per appended batch; with 100 TB of texts, about 40 bytes of index a text.
BUCKETS = 64


def text_digest(text: Column) -> Column:
    """Hex SHA-256 of the text with A-Z lower-cased; null counts as empty."""
    return F.sha2(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))).cast("binary"), 256)


class DigestIndex:
    """A table of the digests met so far, one row each: ``digest``, ``keep_id``, ``batch``.

    ``path`` lies in storage that all executors share. The table's name lives in
    the session's catalog: with a persistent catalog a later session goes on.
    """

    def __init__(self, spark: SparkSession, table: str, path: str, buckets: int = BUCKETS) -> None:
        self.spark, self.table, self.path, self.buckets = spark, table, path, buckets

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def add(self, found: DataFrame, batch: str) -> None:
        """Append the rows of ``found`` (``digest``, ``keep_id``; one row a digest) not in the index yet.

        A batch that is added again, after a failure, finds its own rows and adds none.
        """
        marked = found.select("digest", "keep_id", F.lit(batch).alias("batch"))
        if not self.spark.catalog.tableExists(self.table):
            self._append(marked.where("false"))
        self._append(marked.join(self.rows().select("digest").hint("merge"), "digest", "left_anti"))

    def _append(self, rows: DataFrame) -> None:
        (
            rows.repartition(self.buckets, "digest")
            .sortWithinPartitions("digest")
            .write.mode("append")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .option("path", self.path)
            .saveAsTable(self.table)
        )


def new_index(spark: SparkSession) -> DigestIndex:
    """An empty index of its own in the shared folder."""
    name = f"digest_index_{uuid.uuid4().hex}"
    return DigestIndex(spark, name, f"{shared_folder(spark)}/{name}")


def deduplicate(
    docs: DataFrame,
    index: DigestIndex,
    id_column: str = "doc_id",
    text_column: str = "text",
    batch: str | None = None,
) -> DataFrame:
    """One row per document: ``id_column``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when identical after lower-casing A-Z; null counts as empty.
    Of equal texts in ``docs`` the row with the largest id stays, unless the
    index holds the text from an earlier batch: then that one is ``keep_id`` and
    none of the batch stays. ``group_size`` counts the rows of the batch. Repeated
    rows (same id and text) share one verdict. Ids may be null: such a row is
    never kept beside one with an id, and ``keep_id`` is null where no row of
    the group has one; then the group's rows count as kept. A ``batch`` that was
    named and is repeated gets the same verdicts.

    Texts are read once and only digests travel. Groups are counted before the
    shuffle, so a group with a third of all rows is one row per task; what of
    them the index lacks goes into it, and verdicts are read off the index. The
    join that hands them to each row has a plain exchange on both sides,
    which adaptive execution splits where one digest is hot.
    """
    batch = batch or uuid.uuid4().hex
    digests = materialize(
        docs.select(F.col(id_column).alias("id"), text_digest(F.col(text_column)).alias("digest")), "digests"
    )
    groups = materialize(
        digests.groupBy("digest").agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size")), "groups"
    )
    index.add(groups, batch)
    verdicts = materialize(
        groups.select("digest", "group_size")
        .join(index.rows().hint("merge"), "digest")
        .select("digest", "keep_id", "group_size", (F.col("batch") == batch).alias("first")),
        "verdicts",
    )
    return digests.join(verdicts, "digest").select(
        F.col("id").alias(id_column),
        "keep_id",
        "group_size",
        (F.col("id").eqNullSafe(F.col("keep_id")) & F.col("first")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def distinct_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents that stay, with all their columns; a repeated row stays once.

    Whole rows are shuffled once, by id and digest together, which no document
    shares with another but its own repetitions.
    """
    spark = docs.sparkSession
    verdicts = deduplicate(docs, new_index(spark), id_column, text_column)
    kept = verdicts.where("kept").select(_key(id_column, F.col("text_sha256")).alias("__key"))
    keyed = docs.withColumn("__key", _key(id_column, text_digest(F.col(text_column))))
    return keyed.join(kept, "__key", "left_semi").dropDuplicates(["__key"]).select(*docs.columns)


def _key(id_column: str, digest: Column) -> Column:
    return F.concat_ws(":", F.coalesce(F.col(id_column).cast("string"), F.lit("")), digest)
