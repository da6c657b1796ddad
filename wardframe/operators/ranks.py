"""Places of rows in an order, and slices of it, without a task that sees the whole order or a whole key."""

from __future__ import annotations

import bisect
from collections.abc import Iterable, Iterator, Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardframe.session import materialize

_PART, _LOCAL = "__part", "__local"


def _changes(column: pa.Array) -> np.ndarray:
    """Whether each value but the first differs from the one before; nulls equal each other."""
    now, before = column.slice(1), column.slice(0, len(column) - 1)
    differ = pc.fill_null(pc.not_equal(now, before), False)
    return pc.or_(differ, pc.xor(pc.is_null(now), pc.is_null(before))).to_numpy(zero_copy_only=False)


def _in_ranges(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """``df`` written in ranges of keys and order: ``__part``, and ``__local``, the place among the part's rows of the key."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        last, held = None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            new = np.zeros(n, dtype=bool)
            for key in keys:
                new[1:] |= _changes(batch.column(key))
            ends = [batch.column(key)[0].as_py() for key in keys]
            new[0] = ends != last
            starts = np.flatnonzero(new)
            rows = np.arange(n, dtype=np.int64)
            begin = np.full(n, -held, dtype=np.int64)
            if len(starts):
                since = np.searchsorted(starts, rows, side="right") - 1
                begin[since >= 0] = starts[since[since >= 0]]
            local = rows - begin + 1
            last, held = [batch.column(key)[n - 1].as_py() for key in keys], int(local[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, part, dtype=np.int32)), pa.array(local)],
                [*batch.schema.names, _PART, _LOCAL],
            )

    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    by = [*(F.col(k) for k in keys), *order]
    dealt = df.repartitionByRange(n, *by).sortWithinPartitions(*by)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return materialize(dealt.mapInArrow(run, f"{kinds}, {_PART} int, {_LOCAL} bigint"), "ranges")


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """``df`` with ``name``: the place of each row, from 1, among the rows of its keys in the order.

    Rows are sorted in ranges, so a key with a third of all rows lies in many tasks. Of each
    range only its first and last key reach the driver: how many rows of the first key lie in
    ranges before is a sum over them. Rows equal in keys and order get places in any order.
    """
    held = _in_ranges(df, keys, order)
    key = F.struct(*(F.col(k) for k in keys), F.lit(0).alias("__none"))
    ranges = held.groupBy(_PART).agg(
        F.min(key).alias("first"), F.max(F.struct(key.alias("key"), F.col(_LOCAL).alias("n"))).alias("last")
    )
    before, rows, end, count = [], sorted(ranges.collect(), key=lambda r: r[_PART]), None, 0
    for r in rows:
        carried = count if end == r["first"] else 0
        before.append((r[_PART], *r["first"][:-1], carried))
        count = r["last"]["n"] + (carried if r["first"] == r["last"]["key"] else 0)
        end = r["last"]["key"]
    kinds = ", ".join(f"`__key_{i}` {df.schema[k].dataType.simpleString()}" for i, k in enumerate(keys))
    carried = df.sparkSession.createDataFrame(
        [b for b in before if b[-1]], ", ".join(filter(None, ["__in int", kinds, "__before bigint"]))
    )
    same = [held[_PART] == carried["__in"], *(held[k].eqNullSafe(carried[f"__key_{i}"]) for i, k in enumerate(keys))]
    joined = held.join(F.broadcast(carried), same, "left")  # a row per range at most
    return joined.select(*df.columns, (F.col(_LOCAL) + F.coalesce("__before", F.lit(0))).alias(name))


def ordered_slice(df: DataFrame, order: Sequence[Column], start: int, count: int) -> DataFrame:
    """Rows ``start`` to ``start + count - 1`` (from 0) of ``df`` in the order.

    Rows are sorted in ranges; counts of the ranges, added up, tell which ranges the
    slice reaches, and only their files are read again.
    """
    held = _in_ranges(df, [], order)
    counts = sorted((r[_PART], r["count"]) for r in held.groupBy(_PART).count().collect())
    ends = list(accumulate(n for _, n in counts))
    first, last = bisect.bisect_right(ends, start), bisect.bisect_left(ends, start + count)
    reached = F.lit(False)
    for i in range(first, min(last + 1, len(counts))):
        part, n = counts[i]
        begin = ends[i] - n
        place = F.col(_LOCAL) - 1 + begin
        reached = reached | ((F.col(_PART) == part) & (place >= start) & (place < start + count))
    lowest, highest = (counts[first][0], counts[min(last, len(counts) - 1)][0]) if first < len(counts) else (0, -1)
    return held.where(F.col(_PART).between(lowest, highest) & reached).select(*df.columns)
