"""Spelling variants of frequent words: generated edits, probed in Bloom filters before any shuffle.

Words are counted per task and added up by one shuffle. Every word of the
vocabulary then generates its neighbourhood, the words one deletion or one
replacement away (an insertion is a deletion of the other word), as hashes only:
a word's hash is a polynomial in its letters, so each edit's hash follows from
it by one addition. Blocked Bloom filters of the vocabulary, one for each length,
are broadcast; only edits that pass are spelled out and shuffled to an exact join
with the vocabulary, which removes what passed falsely.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardframe.llm.texts import _pieces, byte_values, slices
from wardframe.session import materialize

SLICE_BYTES = 4 << 20
#: Distinct words, and their bytes, that a task gathers before it hands their counts on.
HELD_WORDS, HELD_BYTES = 200_000, 16 << 20
#: Least code points and occurrences of a word; times that a form must be more frequent.
LEAST_LETTERS, LEAST_COUNT, TIMES = 6, 5, 5
#: A run whose checksum this number divides loses a letter.
MISSPELT = 199
#: Bits of filter for each word, bits set in its block of 64, and blocks that are broadcast at a time (32 MB).
WORD_BITS, SET_BITS, MOST_BLOCKS = 32, 5, 4 << 20
#: Words of this length and longer ones share one filter.
LONG = 64
#: Places of words of which a task holds the edits of one letter at a time.
HELD_EDITS = 1 << 17

# Of lower-cased text; a shorter run has no place where a match could begin.
_RUN = re.compile(f"[a-z\u00C0-\u00FF]{{{LEAST_LETTERS},}}")
_BLANKS = b" \t\n\r\x0b\x0c"
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def word_counts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``word`` and ``n`` of all words of the texts, few at a time: sum ``n`` by ``word``.

    A word is a maximal run of A-Z, a-z and U+00C0 to U+00FF, with A-Z lower-cased. Where
    ``MISSPELT`` divides the CRC-32 h of ``<id>:<run>`` (a null id is empty), the run loses its
    code point h modulo its length. Words under ``LEAST_LETTERS`` code points are left out.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, size = Counter(), 0
        for batch in slices(batches, "t", SLICE_BYTES):
            keys = batch.column("k").to_pylist()
            for key, data in zip(keys, byte_values(batch.column("t")), strict=True):
                before = zlib.crc32(f"{'' if key is None else key}:".encode())
                for piece in _pieces((data or b"").lower(), _BLANKS):
                    for word, n in Counter(_RUN.findall(piece.decode())).items():
                        h = zlib.crc32(word.encode(), before)
                        if h % MISSPELT == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < LEAST_LETTERS:
                                continue
                        if word not in total:
                            size += len(word)
                        total[word] += n
                if len(total) > HELD_WORDS or size > HELD_BYTES:
                    yield _count_batch(total)
                    total, size = Counter(), 0
        if total:
            yield _count_batch(total)

    keyed = docs.select(F.col(id_column).cast("string").alias("k"), F.col(text_column).cast("string").alias("t"))
    return keyed.mapInArrow(run, "word string, n bigint")


def _count_batch(total: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(total)), pa.array(total.values(), pa.int64())], ["word", "n"])


def vocabulary(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: int = LEAST_COUNT) -> DataFrame:
    """``word`` and ``n`` of the words that occur ``least`` times or more in all texts."""
    counts = word_counts(docs, id_column, text_column).groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= least)


# --- hashes and filters -------------------------------------------------------------------------


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(length: int) -> np.ndarray:
    return np.cumprod(np.array([1] + [_BASE] * (length - 1), dtype=np.uint64)[:length])


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places among ``words`` and the letters, a row of Latin-1 bytes a word, of words of one length."""
    lengths = np.array([len(w) for w in words])
    for length in np.unique(lengths):
        places = np.flatnonzero(lengths == length)
        letters = np.frombuffer("".join(words[i] for i in places).encode("latin-1"), dtype=np.uint8)
        yield places, letters.reshape(len(places), length)


def _terms(letters: np.ndarray) -> np.ndarray:
    return (letters.astype(np.uint64) + np.uint64(1)) * _powers(letters.shape[1])


class Layout:
    """Where the filter of each length has its blocks; all filters stand in one row of blocks."""

    def __init__(self, counts: dict[int, int]) -> None:
        """``counts``: words by length, lengths of ``LONG`` and above together."""
        self.first, self.blocks = np.zeros(LONG + 1, dtype=np.int64), np.zeros(LONG + 1, dtype=np.int64)
        for length, n in counts.items():
            self.blocks[length] = max(1, n * WORD_BITS // 64)
        self.first[1:] = np.cumsum(self.blocks)[:-1]
        self.total = int(self.blocks.sum())

    def block(self, mixed: np.ndarray, length: int) -> np.ndarray:
        """The block of each mixed hash."""
        length = min(length, LONG)
        block = ((mixed >> np.uint64(32)) * np.uint64(self.blocks[length])) >> np.uint64(32)
        return block.view(np.int64) + self.first[length]

    def passing(self, hashes: np.ndarray, length: int, part: np.ndarray, begin: int) -> np.ndarray:
        """Which of the hashes have all their bits set in ``part``, the blocks from ``begin`` on."""
        if not self.blocks[min(length, LONG)]:
            return np.zeros(0, dtype=np.int64)
        mixed = _mixed(hashes)
        block = self.block(mixed, length) - begin
        if len(part) < self.total:
            left = np.flatnonzero((block >= 0) & (block < len(part)))
            mixed, block = mixed[left], block[left]
        else:
            left = None
        held = part[block]
        for i in range(SET_BITS):
            among = np.flatnonzero((held >> _bit(mixed, i)) & np.uint64(1))
            mixed, held = mixed[among], held[among]
            left = among if left is None else left[among]
        return left


def _bit(mixed: np.ndarray, i: int) -> np.ndarray:
    return (mixed >> np.uint64(6 * i)) & np.uint64(63)


def _layout(words: DataFrame) -> Layout:
    length = F.least(F.length("word"), F.lit(LONG)).alias("length")
    return Layout({r["length"]: r["count"] for r in words.groupBy(length).count().collect()})  # 64 rows at most


def _blocks(words: DataFrame, layout: Layout) -> DataFrame:
    """``block`` and ``bits`` of the filters of all ``words``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, letters in _by_length(batch.column("word").to_pylist()):
                mixed = _mixed(_terms(letters).sum(axis=1, dtype=np.uint64))
                block, bits = layout.block(mixed, letters.shape[1]), np.zeros(len(mixed), dtype=np.uint64)
                for i in range(SET_BITS):
                    bits |= np.uint64(1) << _bit(mixed, i)
                yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(bits.view(np.int64))], ["block", "bits"])

    made = words.select("word").mapInArrow(run, "block bigint, bits bigint")
    return made.groupBy("block").agg(F.bit_or("bits").alias("bits"))


def _filter_part(spark: SparkSession, blocks: DataFrame, begin: int, end: int) -> np.ndarray:
    """Blocks ``begin`` to ``end`` of the filters, ``MOST_BLOCKS`` at most."""
    part = np.zeros(end - begin, dtype=np.uint64)
    rows = blocks.where((F.col("block") >= begin) & (F.col("block") < end)).toArrow()
    part[rows.column("block").to_numpy() - begin] = rows.column("bits").to_numpy().view(np.uint64)
    return part


# --- neighbourhoods -----------------------------------------------------------------------------


def _edits(letters: np.ndarray, alphabet: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """Words one deletion or replacement away from words of one length, as hashes.

    Yields, part by part, the edits' length, their hashes, where each edit stands (row
    of ``letters`` times their length, plus place) and the new letter (0: deleted). Of
    the two directions of a replacement only the one to the larger letter is generated,
    and of equal letters in a row only the first is deleted, so that each pair of words
    comes up once.
    """
    length, powers = letters.shape[1], _powers(letters.shape[1])
    step = max(1, HELD_EDITS // length)
    for at in range(0, len(letters), step):
        part = letters[at : at + step]
        terms = _terms(part)
        whole = terms.sum(axis=1, dtype=np.uint64)[:, None]
        if length > LEAST_LETTERS:
            before = np.cumsum(terms, axis=1, dtype=np.uint64) - terms
            hashes = (before + (whole - before - terms) * np.uint64(_INVERSE)).ravel()
            first = np.flatnonzero(np.diff(part.astype(np.int16), axis=1, prepend=np.int16(-1)))
            yield length - 1, hashes[first], first + at * length, 0
        # in order of the old letters, the places that get a larger letter stand first
        order = np.argsort(part, axis=None, kind="stable")
        old, rest = part.ravel()[order], (whole - terms).ravel()[order]
        power = powers[order % length]
        order += at * length
        for letter, end in zip(alphabet.tolist(), np.searchsorted(old, alphabet).tolist(), strict=True):
            if end:
                yield length, rest[:end] + np.uint64(letter + 1) * power[:end], order[:end], letter


def _alphabet(words: DataFrame) -> np.ndarray:
    """The letters of all ``words``, each a byte of Latin-1, ascending."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(256, dtype=bool)
        for batch in batches:
            found[np.frombuffer("".join(batch.column("word").to_pylist()).encode("latin-1"), dtype=np.uint8)] = True
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(found))], ["letter"])

    rows = words.select("word").mapInArrow(run, "letter bigint").distinct().collect()  # 90 rows at most
    return np.array(sorted(r["letter"] for r in rows), dtype=np.uint8)


def candidates(words: DataFrame, layout: Layout, alphabet: np.ndarray, part: np.ndarray, begin: int) -> DataFrame:
    """``near``, ``word`` and ``n`` of the edits of ``words`` that ``part`` of the filters, from block ``begin``, lets pass."""
    shared = words.sparkSession.sparkContext.broadcast(part)  # MOST_BLOCKS blocks at most

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spelled, counts = batch.column("word").to_pylist(), batch.column("n").to_numpy()
            near, of = [], []
            for places, letters in _by_length(spelled):
                for length, hashes, where, letter in _edits(letters, alphabet):
                    passed = where[layout.passing(hashes, length, shared.value, begin)]
                    new = chr(letter) if letter else ""
                    row, at = places[passed // letters.shape[1]], passed % letters.shape[1]
                    for i, p in zip(row.tolist(), at.tolist(), strict=True):
                        near.append(spelled[i][:p] + new + spelled[i][p + 1 :])
                        of.append(i)
                if sum(map(len, near[-1:])) * len(near) > SLICE_BYTES:
                    yield _edit_batch(near, of, spelled, counts)
                    near, of = [], []
            if near:
                yield _edit_batch(near, of, spelled, counts)

    return words.mapInArrow(run, "near string, word string, n bigint")


def _edit_batch(near: list[str], of: list[int], spelled: list[str], counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(near), pa.array([spelled[i] for i in of]), pa.array(counts[of])], ["near", "word", "n"]
    )


def near_words(words: DataFrame) -> DataFrame:
    """All pairs of ``words`` (``word``, ``n``) one edit apart, in both orders: ``word``, ``n``, ``near``, ``near_n``.

    The filters are probed ``MOST_BLOCKS`` blocks at a time, so what is broadcast has a bound
    whatever the vocabulary's size; each further part is one more pass over the words.
    """
    spark = words.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    dealt = words.select("word", "n").repartition(tasks, "word")
    layout, alphabet = _layout(words), _alphabet(words)
    blocks = materialize(_blocks(words, layout), "filter-blocks")
    found = None
    for begin in range(0, max(1, layout.total), MOST_BLOCKS):
        part = _filter_part(spark, blocks, begin, min(begin + MOST_BLOCKS, layout.total))
        passed = candidates(dealt, layout, alphabet, part, begin)
        found = passed if found is None else found.unionByName(passed)
    known = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = materialize(found.join(known, "near").select("word", "n", "near", "near_n"), "near-words")
    back = pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return pairs.unionByName(back)


# --- forms --------------------------------------------------------------------------------------


def _roots(forms: DataFrame, most: int) -> DataFrame:
    """``word`` and ``root`` of the words with a form: the end of the chain of forms.

    Each form is ``TIMES`` times as frequent, so a chain has at most log(``most``) links, and
    every round halves what is left of it.
    """
    links = max(1, math.ceil(math.log(max(most, 2), TIMES)))
    found = materialize(forms, "forms")
    for _ in range(math.ceil(math.log2(links))):
        further = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        found = materialize(found.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
    return found


def spelling_variants(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least: int = LEAST_COUNT,
    times: int = TIMES,
) -> DataFrame:
    """One row per word of the vocabulary: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``.

    ``vocabulary`` says what words are. Two are near if they differ by exactly one
    inserted, deleted or replaced code point; ``n_near`` counts a word's near ones.
    ``form`` is the near word of largest ``n`` (of ties the smallest in code-point
    order), if it occurs ``times`` times as often or more, else null; ``root`` is the
    end of the chain of forms, the word itself if it has none.

    Null and empty texts have no words, a null id counts as an empty one, a repeated
    row counts again, an empty table gives no rows, and other columns are not read.
    No word is left out: the filters only spare edits that are no words the shuffle.
    """
    if times < TIMES:
        raise ValueError(f"chains of forms end for times of {TIMES} and above")
    words = materialize(vocabulary(docs, id_column, text_column, least), "vocabulary")
    best = near_words(words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best")
    )
    best = best.select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))
    fit = F.col("form_n") >= times * F.col("n")
    judged = words.join(best, "word", "left").select(
        "word",
        F.when(fit, F.col("form")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(fit, F.col("form_n")).alias("form_n"),
    )
    judged = materialize(judged, "judged-words")
    most = words.agg(F.max("n")).first()[0] or 1
    roots = _roots(judged.where("form IS NOT NULL").select("word", F.col("form").alias("root")), most)
    rooted = judged.join(roots, "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
