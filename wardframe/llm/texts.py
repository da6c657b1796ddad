"""Helpers that the operators on texts share inside their tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a task splits into words at a time, so that memory does
#: not grow with the length of a text.
PIECE_BYTES = 4 << 20

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Lower-cases A-Z; every ASCII byte that is neither digit nor letter becomes a blank.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, UPPER.lower())


def byte_values(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of each text."""
    return column.cast(pa.binary()).to_pylist()


def _pieces(data: bytes, blanks: bytes) -> Iterator[bytes]:
    """``data`` in pieces that end where a word ends."""
    at = 0
    while len(data) - at > PIECE_BYTES:
        cut = at + PIECE_BYTES
        while cut < len(data) and data[cut] not in blanks:
            cut += 1
        yield data[at:cut]
        at = cut
    yield data[at:] if at else data


def alnum_words(data: bytes | None) -> Iterator[list[bytes]]:
    """Words of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z, piece by piece."""
    for piece in _pieces((data or b"").translate(_WORD_BYTES), b" "):
        yield piece.split()


def blank_words(data: bytes | None) -> Iterator[list[bytes]]:
    """Words of ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z, piece by piece."""
    for piece in _pieces((data or b"").lower(), b" \t\n\r\x0b\x0c"):
        yield piece.split()


def slices(batches: Iterable[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column`` has about ``most`` bytes in each; a longer text stands alone."""
    for batch in batches:
        per_row = max(1, batch.column(column).nbytes // max(1, batch.num_rows))
        if per_row * batch.num_rows <= most:
            yield batch
            continue
        lengths = [len(x) if x else 0 for x in byte_values(batch.column(column))]
        begin = held = 0
        for i, length in enumerate(lengths):
            if i > begin and held + length > most:
                yield batch.slice(begin, i - begin)
                begin, held = i, 0
            held += length
        yield batch.slice(begin)


def with_columns(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    """``batch`` with the columns added at its end, in place of any of the same name."""
    kept = [n for n in batch.schema.names if n not in columns]
    return pa.RecordBatch.from_arrays(
        [batch.column(n) for n in kept] + list(columns.values()), names=kept + list(columns)
    )


def schema_with(df: DataFrame, added: str) -> str:
    """The DDL of what ``with_columns`` makes of rows of ``df``."""
    names = {part.strip().split(" ", 1)[0] for part in added.split(",")}
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name not in names]
    return ", ".join([*kept, added])
