"""Adding up small vectors computed from batches of rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardframe.session import compiled_methods, small_batches

Compute = Callable[[np.ndarray], np.ndarray]
#: Numbers of a vector that are shuffled together.
SLICE = 2_048
_PARTS = "place bigint, part array<double>"


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])


def as_blocks(rows: DataFrame) -> DataFrame:
    """An all-double frame packed into one binary block per Arrow batch.

    A fit that passes over the same rows many times keeps the blocks, and each
    pass then reads them without converting row by row again.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([_matrix(batch).tobytes()], pa.binary())], names=["block"])

    return rows.mapInArrow(pack, "block binary")


def _added(parts: DataFrame, size: int) -> np.ndarray:
    """Position-wise sum of one vector per task, which come in slices; only ``size`` numbers are fetched.

    A short vector is added up cell by cell; of a long one each slice goes to one task.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for place, part in zip(batch.column("place").to_pylist(), batch.column("part"), strict=True):
                values = part.values.to_numpy()
                found[place] = found[place] + values if place in found else values
        yield _sliced(found)

    if size <= SLICE:
        cells = parts.select(F.posexplode("part").alias("place", "part"))
        added = cells.groupBy("place").agg(F.array(F.sum("part")).alias("part"))
    else:
        added = parts.repartition("place").mapInArrow(add, _PARTS)
    result = np.zeros(size)
    with compiled_methods(parts.sparkSession), small_batches(parts.sparkSession):
        rows = added.collect()
    for row in rows:
        result[row["place"] : row["place"] + len(row["part"])] = row["part"]
    return result


def _sliced(found: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.list_(pa.float64()))],
        names=["place", "part"],
    )


def _totals(matrices: Iterator[np.ndarray], size: int, compute: Compute) -> Iterator[pa.RecordBatch]:
    total = np.zeros(size)
    for matrix in matrices:
        total += compute(matrix)
    yield _sliced({place: total[place : place + SLICE] for place in range(0, size, SLICE)})


def batch_totals(rows: DataFrame, size: int, compute: Compute) -> np.ndarray:
    """Sum of ``compute(batch)`` over all batches of an all-double frame."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _totals(map(_matrix, batches), size, compute)

    return _added(rows.mapInArrow(partial, _PARTS), size)


def block_totals(blocks: DataFrame, width: int, size: int, compute: Compute) -> np.ndarray:
    """The same over packed blocks of ``width`` columns."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = (np.frombuffer(b.as_buffer(), np.float64) for batch in batches for b in batch.column(0))
        return _totals((m.reshape(-1, width) for m in packed), size, compute)

    return _added(blocks.mapInArrow(partial, _PARTS), size)
