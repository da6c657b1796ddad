"""A label table whose appends are whole or not there, and whose keys need no shuffle.

Every append writes one bucketed folder and becomes visible by one entry in a log
of commits. An entry is put there by a rename that fails if its number is taken, so
of two writers one comes second: it takes out what the first one added and tries the
next number. Readers see the folders that the log names and nothing else, so a
batch that broke off leaves no rows, and a batch that is repeated adds none.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardframe.fixed_values import KEY
from wardframe.session import small_batches

CONCEPT = "concept"


class LabelTable:
    """Labels by ``key``, and by concept where the schema has one, bucketed and sorted by key."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str = KEY, buckets: int = 64) -> None:
        self.spark, self.path, self.schema, self.key, self.buckets = spark, path.rstrip("/"), schema, key, buckets
        self.by_concept = CONCEPT in schema.fieldNames()
        self._tables: dict[str, str] = {}

    # --- the log of commits --------------------------------------------------------------

    def _files(self):
        java = self.spark._jvm.org.apache.hadoop.fs
        return java, java.Path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def commits(self) -> list[dict]:
        """The entries of the log in order; each has the batch, its folder and the folders that it stands for."""
        java, files = self._files()
        log = java.Path(f"{self.path}/_commits")
        if not files.exists(log):
            return []
        names = sorted(s.getPath().getName() for s in files.listStatus(log))
        rows = self.spark.read.text([f"{log}/{n}" for n in names if n.isdigit()]).collect() if names else []
        return sorted((json.loads(r["value"]) for r in rows), key=lambda c: c["number"])

    def _folders(self, commits: Sequence[dict]) -> list[str]:
        gone = {f for c in commits for f in c["instead_of"]}
        return [c["folder"] for c in commits if c["folder"] and c["folder"] not in gone]

    def _commit(self, entry: dict) -> bool:
        """Put the entry at its number; False if another writer was there first."""
        java, files = self._files()
        log, draft = java.Path(f"{self.path}/_commits"), java.Path(f"{self.path}/_drafts/{uuid.uuid4().hex}")
        files.mkdirs(log)
        stream = files.create(draft)
        stream.write(bytearray(json.dumps(entry).encode()))
        stream.close()
        context = java.FileContext.getFileContext(files.getUri(), self.spark._jsc.hadoopConfiguration())
        no_overwriting = self.spark.sparkContext._gateway.new_array(java.Options.Rename, 0)
        try:
            context.rename(draft, java.Path(log, f"{entry['number']:012d}"), no_overwriting)
        except Exception as error:  # noqa: BLE001 - what Hadoop throws arrives wrapped
            if "FileAlreadyExists" not in str(error):
                raise
            files.delete(draft, False)
            return False
        return True

    # --- reading -------------------------------------------------------------------------

    def _table(self, folder: str) -> DataFrame:
        """A folder as a bucketed table of this session's catalog."""
        if folder not in self._tables:
            name = f"labels_{uuid.uuid4().hex}"
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{self.path}/{folder}' "
                f"CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {self.buckets} BUCKETS"
            )
            self._tables[folder] = name
        return self.spark.table(self._tables[folder])

    def rows(self) -> DataFrame:
        """All labels of committed batches."""
        found = self.spark.createDataFrame([], self.schema)
        for folder in self._folders(self.commits()):
            found = found.unionByName(self._table(folder))
        return found

    def with_known(self, rows: DataFrame, folders: Sequence[str] | None = None) -> DataFrame:
        """``rows`` with ``known``: the concepts that the table holds for the key (for a table without any, ``['']``).

        Only ``rows`` are shuffled, once, to the buckets; each folder is read where it lies.
        """
        folders = self._folders(self.commits()) if folders is None else folders
        concept = F.col(CONCEPT) if self.by_concept else F.lit("")
        none = F.array().cast("array<string>")
        rows = rows.repartition(self.buckets, self.key).withColumn("known", none)
        for folder in folders:
            held = self._table(folder).groupBy(self.key).agg(F.collect_set(concept).alias("__held"))  # a key has few concepts
            rows = rows.join(held.hint("merge"), self.key, "left")
            rows = rows.withColumn("known", F.array_union("known", F.coalesce("__held", none))).drop("__held")
        return rows

    def unseen(self, rows: DataFrame, folders: Sequence[str] | None = None) -> DataFrame:
        """The rows whose key (and concept) the table does not hold."""
        concept = F.col(CONCEPT) if self.by_concept else F.lit("")
        marked = self.with_known(rows, folders)
        return marked.where(~F.array_contains("known", concept)).drop("known")

    # --- writing -------------------------------------------------------------------------

    def draft(self, rows: DataFrame) -> str:
        """Write ``rows`` to a folder that no commit names yet, so that nobody reads it."""
        folder, name = f"data-{uuid.uuid4().hex}", f"labels_{uuid.uuid4().hex}"
        writer = rows.select(*self.schema.fieldNames()).repartition(self.buckets, self.key).sortWithinPartitions(self.key)
        writer = writer.write.format("parquet").bucketBy(self.buckets, self.key).sortBy(self.key)
        with small_batches(self.spark):  # labels may be asked for as they are written
            writer.option("path", f"{self.path}/{folder}").saveAsTable(name)
        self._tables[folder] = name
        return folder

    def _alone(self, labels: DataFrame) -> DataFrame:
        """One row a key and concept: of several the smallest."""
        keys = [self.key, *([CONCEPT] if self.by_concept else [])]
        rest = [n for n in self.schema.fieldNames() if n not in keys]
        dealt = labels.repartition(self.buckets, self.key)
        return dealt.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("rest")).select(*keys, "rest.*")

    def append(self, labels: DataFrame, batch: str) -> bool:
        """Add the labels that the table lacks, all of them or none; False if ``batch`` was added before.

        A label is asked for once, however often another writer commits first: rows are
        written, and only those that the other one added too are taken out again.
        """
        commits = self.commits()
        if any(c["batch"] == batch for c in commits):
            return False
        seen = self._folders(commits)
        folder = self.draft(self.unseen(self._alone(labels), seen))
        while not self._commit({"number": len(commits), "batch": batch, "folder": folder, "instead_of": []}):
            commits = self.commits()
            if any(c["batch"] == batch for c in commits):
                return False
            fresh = [f for f in self._folders(commits) if f not in seen]
            seen += fresh
            folder = self.draft(self.unseen(self._table(folder), fresh))
        return True

    def compact(self) -> bool:
        """Put one folder in place of all, so that reading does not slow down; False if another writer was first."""
        commits = self.commits()
        folders = self._folders(commits)
        if len(folders) < 2:
            return True
        folder = self.draft(self.rows())
        entry = {"number": len(commits), "batch": f"compact-{uuid.uuid4().hex}", "folder": folder, "instead_of": folders}
        return self._commit(entry)

    def close(self) -> None:
        """Take the folders out of the session's catalog; their files stay."""
        for name in self._tables.values():
            try:
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            except PySparkException:
                continue
        self._tables = {}
