"""CSV whose quoted fields hold line breaks, read by many tasks a file.

Spark splits the file by lines. Whether a split begins inside a quoted field follows
from the number of quotes before it: a first pass counts them per split, a prefix sum
over splits gives each its state, and a second pass joins lines to records. Only the
pieces of records that reach over the end of a split are shuffled.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Splits that begin at other places than the start of a file; a number each goes to all tasks.
MOST_SPLITS = 4_000_000
_BATCH_CHARS = 4 << 20
_CLOSED = -1
_OUT = "path string, owner bigint, begin bigint, text string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.text(path, lineSep="\n")
    return lines.select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("begin")
    )


def _owners(lines: DataFrame) -> dict[str, dict[int, int]]:
    """Per file with several splits: where each later one begins, and the split that holds the
    start of the record it begins in (``_CLOSED`` where it begins between records)."""
    odd = F.pmod(F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit(""))), F.lit(2))
    splits = lines.groupBy("path", "begin").agg(F.sum(odd).alias("odd"))
    before = Window.partitionBy("path").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
    opened = F.pmod(F.coalesce(F.sum("odd").over(before), F.lit(0)), F.lit(2)) == 1
    # a record reaches over a split's end, and starts in it unless the split is all inside one field
    starts = (F.pmod(F.col("odd") + F.col("open").cast("int"), F.lit(2)) == 1) & (~F.col("open") | (F.col("odd") > 0))
    owner = F.last(F.when(F.col("starts"), F.col("begin")), ignorenulls=True).over(before)
    found = (
        splits.withColumn("open", opened)
        .withColumn("starts", starts)
        .withColumn("owner", F.when(F.col("open"), owner).otherwise(F.lit(_CLOSED)))
        .where("begin > 0")
    )
    rows = found.select("path", "begin", "owner").limit(MOST_SPLITS + 1).collect()
    if len(rows) > MOST_SPLITS:
        raise ValueError(f"more than {MOST_SPLITS} splits: raise spark.sql.files.maxPartitionBytes")
    owners: dict[str, dict[int, int]] = {}
    for row in rows:
        owners.setdefault(row["path"], {})[row["begin"]] = row["owner"]
    return owners


def _checked(header: str, names: list[str]) -> None:
    found = next(csv.reader(io.StringIO(header.removeprefix("﻿"), newline="")), [])
    if found != names:
        raise ValueError(f"the header is {found}, not {names}")


def _records(lines: DataFrame, shared, names: list[str], pieces: bool) -> DataFrame:
    """Whole records of the splits, or the pieces of those that reach over an end."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[str, int, int, str]] = []
        chars = 0
        place: tuple[str, int] | None = None
        owner, held, inside = _CLOSED, [], False

        def done(piece: bool) -> None:
            nonlocal chars, held
            text, held = "\n".join(held), []
            if not piece and owner == _CLOSED:
                text = text.removesuffix("\r")
                if place[1] == 0 and place not in headed:
                    headed.add(place)
                    _checked(text, names)
                    return
                if not text:
                    return
            if piece and place[1] == 0 and place not in headed:
                raise ValueError(f"the header of {place[0]} goes over several lines")
            if piece == pieces:
                out.append((place[0], owner, place[1], text))
                chars += len(text)

        headed: set[tuple[str, int]] = set()
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("value", "path", "begin"))
            for value, path, begin in zip(*columns, strict=True):
                if place != (path, begin):
                    if held:  # the record goes on in the next split
                        owner = owner if owner != _CLOSED else place[1]
                        done(piece=True)
                    place = path, begin
                    owner = _CLOSED if begin == 0 else shared.value.get(path, {}).get(begin)
                    if owner is None:
                        raise ValueError(f"{path} was split at other places before; read it again")
                    inside = owner != _CLOSED
                held.append(value)
                inside ^= value.count('"') % 2 == 1
                if not inside:
                    done(piece=owner != _CLOSED)
                    owner = _CLOSED
                if chars > _BATCH_CHARS:
                    yield _batch(out)
                    out, chars = [], 0
        if held:
            owner = owner if owner != _CLOSED else place[1]
            done(piece=True)
        yield _batch(out)

    return lines.mapInArrow(run, _OUT)


def _batch(rows: list[tuple[str, int, int, str]]) -> pa.RecordBatch:
    paths, owners, begins, texts = zip(*rows, strict=True) if rows else ((), (), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(paths, pa.string()), pa.array(owners, pa.int64()), pa.array(begins, pa.int64()),
         pa.array(texts, pa.string())],
        names=["path", "owner", "begin", "text"],
    )


def read_quoted_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """UTF-8 CSV files with a header, fields quoted by ``"`` and quotes doubled inside, as one table.

    Lines end in ``\\n`` or ``\\r\\n``; a quote may only stand in a quoted field. Line breaks inside
    fields stay as they are; empty fields, quoted or not, are null. Lines without text between records are no records; empty files and files
    with a header only have none. A field that is never closed reaches to the end of its file. A
    header that departs from ``schema``, or goes over several lines, is an error. Counting quotes is a job of its own, run at once;
    files that change afterwards need a new call.
    """
    lines = _lines(spark, path)
    owners = _owners(lines)
    shared = spark.sparkContext.broadcast(owners)
    names = schema.fieldNames()
    texts = _records(lines, shared, names, pieces=False).select("text")
    if any(o != _CLOSED for starts in owners.values() for o in starts.values()):
        pieces = _records(lines, shared, names, pieces=True).groupBy("path", "owner")
        joined = pieces.agg(F.sort_array(F.collect_list(F.struct("begin", "text"))).alias("pieces"))
        whole = F.array_join(F.transform("pieces", lambda p: p["text"]), "\n")
        texts = texts.union(joined.select(F.regexp_replace(whole, r"\r\z", "").alias("text")))
    options = {"quote": '"', "escape": '"', "multiLine": "true"}
    return texts.select(F.from_csv("text", schema.toDDL(), options).alias("row")).select("row.*")
