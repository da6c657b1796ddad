"""Chunking joined notes without ever holding a joined text in one row.

The joined text of an admission is its notes in order with a separator between
them. Here every note learns its offset in that text and is cut into the
pieces of the windows it reaches into; a window is then put together from at
most a window's worth of characters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardframe.fixed_values import CHUNK_OVERLAP, CHUNK_SIZE, NOTE_SEPARATOR

#: Blocks that one window accumulates, and how often blocks are grouped by so many.
FAN, LEVELS = 1000, 2
_EARLIER = (Window.unboundedPreceding, -1)


def _block_starts(totals: DataFrame, key: str, levels: int = LEVELS) -> DataFrame:
    """The width of all blocks before each block of its key: ``key``, ``block``, ``block_start``.

    Blocks are summed in groups of ``FAN`` and accumulated within their group, the groups
    likewise, so a window holds a key's blocks divided by ``FAN`` as often as there are levels.
    """
    if not levels:
        window = Window.partitionBy(key).orderBy("block").rowsBetween(*_EARLIER)
        return totals.select(key, "block", F.coalesce(F.sum("block_width").over(window), F.lit(0)).alias("block_start"))
    grouped = totals.withColumn("outer", F.floor(F.col("block") / FAN))
    outer = grouped.groupBy(key, "outer").agg(F.sum("block_width").alias("block_width")).withColumnRenamed("outer", "block")
    starts = _block_starts(outer, key, levels - 1).select(key, F.col("block").alias("outer"), F.col("block_start").alias("start"))
    window = Window.partitionBy(key, "outer").orderBy("block").rowsBetween(*_EARLIER)
    inside = F.coalesce(F.sum("block_width").over(window), F.lit(0))
    return (
        grouped.withColumn("inside", inside)
        .join(starts, [key, "outer"])
        .select(key, "block", (F.col("start") + F.col("inside")).alias("block_start"))
    )


def with_offsets(notes: DataFrame, key: str, order: str, block: F.Column, text: str = "text") -> DataFrame:
    """Add each note's first position in the joined text of its key.

    A running sum per key would put a very large key in one task. Lengths are
    summed per key and block first; block totals are accumulated in groups,
    and notes only within their block. ``block`` is a whole number that must not decrease
    along ``order``. The separator is counted as part of every note but the first.
    """
    sized = notes.where(F.col(text).isNotNull()).select(
        key, order, text, block.alias("block"), (F.length(text) + F.lit(len(NOTE_SEPARATOR))).alias("width")
    )
    by_block = Window.partitionBy(key, "block").orderBy(order).rowsBetween(*_EARLIER)
    starts = _block_starts(sized.groupBy(key, "block").agg(F.sum("width").alias("block_width")), key)
    inside = F.coalesce(F.sum("width").over(by_block), F.lit(0))
    return (
        sized.withColumn("inside", inside)
        .join(starts, [key, "block"])
        .select(key, order, text, (F.col("block_start") + F.col("inside")).alias("offset"))
    )


def chunks_from_notes(
    notes: DataFrame,
    key: str,
    order: str,
    block: F.Column,
    text: str = "text",
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
) -> DataFrame:
    """Windows over the joined notes of each key: (key, chunk_no, chunk)."""
    step = size - overlap
    placed = with_offsets(notes, key, order, block, text)
    # all but the first note carry the separator in front; offsets then shift by it
    gap = len(NOTE_SEPARATOR)
    piece = F.when(F.col("offset") == 0, F.col(text)).otherwise(F.concat(F.lit(NOTE_SEPARATOR), F.col(text)))
    start = F.when(F.col("offset") == 0, F.lit(0)).otherwise(F.col("offset") - gap)
    located = placed.select(key, piece.alias("piece"), start.cast("long").alias("start")).where(F.length("piece") > 0)
    end = F.col("start") + F.length("piece")
    first = F.greatest(F.lit(0).cast("long"), F.floor((F.col("start") - size) / step) + 1)
    last = F.floor((end - 1) / step)
    reached = located.withColumn("chunk_no", F.explode(F.sequence(first.cast("long"), last.cast("long"))))
    window_start = F.col("chunk_no") * step
    low = F.greatest(F.col("start"), window_start)
    high = F.least(end, window_start + size)
    cut = F.substring(F.col("piece"), (low - F.col("start") + 1).cast("int"), (high - low).cast("int"))
    return (
        reached.select(key, "chunk_no", low.alias("low"), cut.alias("cut"))
        .groupBy(key, "chunk_no")
        .agg(F.expr("string_agg(cut, '') WITHIN GROUP (ORDER BY low)").alias("chunk"))
    )
