"""Benchmark decontamination by the multi-pattern search of Wu and Manber, over words.

Patterns of one length share a shift table keyed by blocks of words: a block
that no pattern holds lets the search skip a whole pattern's length. Where a
block ends some pattern, the patterns of its bucket are compared with the text.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardframe.llm.texts import alnum_words, byte_values, schema_with, slices, with_columns
from wardframe.session import materialize

#: Consecutive words of an item that make a window.
WINDOW_WORDS = 10
#: Bytes of benchmark text in one search; a larger benchmark is searched for in blocks.
#: The tables of a block take some 150 times as much in each Python worker.
BLOCK_BYTES = 2 << 20
SLICE_BYTES = 4 << 20

ADDED = "n_words bigint, hit_spans array<struct<begin:bigint,end:bigint>>, hit_items array<string>"


class Patterns:
    """Tables of all windows of some items."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW_WORDS) -> None:
        self.vocabulary: dict[bytes, int] = {}
        found: dict[int, dict[tuple[int, ...], set[str]]] = {}
        for item, text in items:
            words = [w for part in alnum_words((text or "").encode()) for w in part]
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            length = min(window, len(ids))
            for i in range(len(ids) - length + 1 if length else 0):
                found.setdefault(length, {}).setdefault(tuple(ids[i : i + length]), set()).add(item)
        self.groups = [_Group(length, found[length]) for length in sorted(found)]
        self.longest = max(found, default=1)

    def search(self, data: bytes | None) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Words of the text, the runs of words inside occurrences, and the items that occur."""
        total, carried = 0, []
        hits: list[tuple[int, int]] = []
        items: set[str] = set()
        known = self.vocabulary.get
        for words in alnum_words(data):
            fresh = [known(w, 0) for w in words]
            ids = carried + fresh
            for group in self.groups:
                skip = max(0, len(carried) - group.length + 1)
                for begin, found in group.occurrences(ids, skip):
                    begin += total - len(carried)
                    hits.append((begin, begin + group.length))
                    items |= found
            total += len(fresh)
            carried = ids[len(ids) - self.longest + 1 :] if self.longest > 1 and len(ids) >= self.longest else (
                ids if self.longest > 1 else []
            )
        return total, merged(hits), items


class _Group:
    """Shift and bucket tables of the patterns of one length."""

    def __init__(self, length: int, patterns: dict[tuple[int, ...], set[str]]) -> None:
        self.length, self.block = length, min(2, length)
        self.most = length - self.block + 1
        self.shift: dict[tuple[int, ...], int] = {}
        self.buckets: dict[tuple[int, ...], dict[tuple[int, ...], list]] = {}
        for pattern, items in patterns.items():
            for end in range(self.block, length + 1):
                block = pattern[end - self.block : end]
                self.shift[block] = min(self.shift.get(block, self.most), length - end)
            bucket = self.buckets.setdefault(pattern[length - self.block :], {})
            bucket.setdefault(pattern[: self.block], []).append((list(pattern), items))

    def occurrences(self, ids: list[int], begin: int = 0) -> Iterator[tuple[int, set[str]]]:
        """Where patterns stand in ``ids`` from ``begin`` on, and the items they come from."""
        length, block, most, n = self.length, self.block, self.most, len(ids)
        shift, buckets = self.shift.get, self.buckets
        end = begin + length
        while end <= n:
            last = (ids[end - 2], ids[end - 1]) if block == 2 else (ids[end - 1],)
            by = shift(last, most)
            if by:
                end += by
                continue
            start = end - length
            for pattern, items in buckets[last].get(tuple(ids[start : start + block]), ()):
                if ids[start:end] == pattern:
                    yield start, items
            end += 1


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return [(b, e) for b, e in out]


def _blocks(
    benchmark: DataFrame, item_column: str, text_column: str, block_bytes: int
) -> Iterator[list[tuple[str, str | None]]]:
    """The benchmark's items, about ``block_bytes`` of text at a time."""
    items = benchmark.select(
        F.col(item_column).cast("string").alias("item"), F.col(text_column).cast("string").alias("text")
    ).where("item IS NOT NULL AND text IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    for i in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == i)
        yield [(r["item"], r["text"]) for r in part.collect()]


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    window: int = WINDOW_WORDS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with ``n_words``, ``hit_spans`` and ``hit_items`` added (in place of columns of that name).

    A window is ``window`` consecutive words of an item; an item of fewer words,
    but not none, is one window. A span is a run of words, end excluded, each
    inside an occurrence of a window. Null texts have no words; items that are
    null or whose id is null are no items; two items of one id count as one.

    The size of the benchmark is measured first: each search takes about
    ``block_bytes`` of it, so what is broadcast is bounded. With more than one
    block the documents are written between searches and results are joined
    row by row in the same pass, without a shuffle.
    """
    spark = docs.sparkSession
    result = docs
    for i, items in enumerate(_blocks(benchmark, item_column, item_text_column, block_bytes)):
        if i:
            result = materialize(result, "passages")
        result = _search(result, spark.sparkContext.broadcast(Patterns(items, window)), text_column, first=not i)
    return result


def _search(docs: DataFrame, shared, text_column: str, first: bool) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = shared.value
        for batch in slices(batches, text_column, SLICE_BYTES):
            found = [patterns.search(data) for data in byte_values(batch.column(text_column))]
            if not first:
                spans, items = batch.column("hit_spans").to_pylist(), batch.column("hit_items").to_pylist()
                found = [
                    (n, merged(new + [(s["begin"], s["end"]) for s in old]), names | set(have))
                    for (n, new, names), old, have in zip(found, spans, items, strict=True)
                ]
            yield with_columns(
                batch,
                {
                    "n_words": pa.array([n for n, _, _ in found], pa.int64()),
                    "hit_spans": pa.array([[{"begin": b, "end": e} for b, e in s] for _, s, _ in found], _SPANS),
                    "hit_items": pa.array([sorted(names) for _, _, names in found], pa.list_(pa.string())),
                },
            )

    return docs.mapInArrow(run, schema_with(docs, ADDED))


_SPANS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))


def n_hit() -> Column:
    return F.aggregate("hit_spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["begin"])


def decontaminated(docs: DataFrame, benchmark: DataFrame, most_hit: float = 0.0) -> DataFrame:
    """The documents of which no more than ``most_hit`` of the words stand in benchmark windows."""
    aside = {c: f"__{c}" for c in docs.columns if c in ("n_words", "hit_spans", "hit_items")}
    found = find_passages(docs.withColumnsRenamed(aside), benchmark)
    kept = found.where(n_hit() <= F.lit(most_hit) * F.col("n_words"))
    return kept.select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])
