"""URL filters: rules by host and path, then a list of URLs behind a blocked Bloom filter.

The keys of a URL (its host and parent hosts, with and without its path) are
tested against the filter, whose bits of one key lie in one block of 64 bytes.
Few keys pass; they alone meet the list in an exact hash join.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardframe.llm.texts import ascii_lower
from wardframe.session import materialize

#: Bits of the filter for each listed key, bits set by a key, and the filter's most bytes:
#: a longer list makes more false positives, which the join removes, not a larger filter.
BITS_PER_KEY, HASHES, MOST_BYTES = 16, 6, 16 << 20
_BLOCK_WORDS = 8  # of 64 bits

# fixed values: (host, path, verdict)
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    rest = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    return F.coalesce(ascii_lower(rest), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def parent_hosts(host: Column) -> Column:
    """The host, without a leading ``www.`` or ``m.``, and each parent of two labels or more."""
    bare = F.regexp_replace(host, r"\A(?:www|m)\.", "")
    labels = F.split(bare, r"\.")
    tails = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(tails)


def canonical(host: Column, path: Column) -> Column:
    """The URL without scheme, ``www.``, query, fragment, index page or closing slash."""
    bare = F.regexp_replace(host, r"\A(?:www|m)\.", "")
    return F.concat(bare, F.regexp_replace(F.regexp_replace(path, r"(?:\.html?)?/*\z", ""), r"/+", "/"))


def rule_for(host: Column, path: Column, rules: Iterable[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, written like ``net/``, and its verdict; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, prefix, decision in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0] + r[1])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(prefix)
        rule = F.when(fits, F.lit(name + prefix)).otherwise(rule)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return rule, verdict


class BloomFilter:
    def __init__(self, blocks: int) -> None:
        self.words = np.zeros((blocks, _BLOCK_WORDS), dtype=np.uint64)

    @staticmethod
    def bits(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
        """The block of each 64-bit hash, and its bits (0 to 511) there."""
        h = hashes.view(np.uint64)
        block = (h >> np.uint64(32)) % np.uint64(blocks)
        low = h & np.uint64(0xFFFFFFFF)
        step = (low * np.uint64(0x9E3779B1) >> np.uint64(7)) | np.uint64(1)
        turns = np.arange(HASHES, dtype=np.uint64)[None, :]
        return block.astype(np.int64), ((low[:, None] + turns * step[:, None]) % np.uint64(64 * _BLOCK_WORDS)).astype(np.int64)

    def passes(self, hashes: np.ndarray) -> np.ndarray:
        block, bits = self.bits(hashes, len(self.words))
        found = self.words[block[:, None], bits >> 6] >> (bits & 63).astype(np.uint64)
        return (found & np.uint64(1)).all(axis=1)


def build_filter(keys: DataFrame, most_bytes: int = MOST_BYTES) -> BloomFilter:
    """The filter of ``key``; at most ``most_bytes`` whatever the length of the list.

    Tasks make the words of their keys and Spark ORs them by block, so only the
    finished filter reaches the driver.
    """
    n = keys.count()
    blocks = min(max(1, math.ceil(n * BITS_PER_KEY / (64 * _BLOCK_WORDS))), max(1, most_bytes // (8 * _BLOCK_WORDS)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, where = BloomFilter.bits(batch.column("h").to_numpy(), blocks)
            rows, at = np.unique(own, return_inverse=True)
            words = np.zeros((len(rows), _BLOCK_WORDS), dtype=np.uint64)
            np.bitwise_or.at(words, (at[:, None], where >> 6), np.uint64(1) << (where & 63).astype(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), *(pa.array(words[:, i].view(np.int64)) for i in range(_BLOCK_WORDS))],
                ["block", *(f"w{i}" for i in range(_BLOCK_WORDS))],
            )

    names = [f"w{i}" for i in range(_BLOCK_WORDS)]
    made = keys.select(F.xxhash64("key").alias("h")).mapInArrow(
        run, "block bigint, " + ", ".join(f"{n} bigint" for n in names)
    )
    table = made.groupBy("block").agg(*[F.bit_or(n).alias(n) for n in names]).toArrow()
    out = BloomFilter(blocks)
    if table.num_rows:
        at = table.column("block").to_numpy()
        for i, name in enumerate(names):
            out.words[at, i] = table.column(name).to_numpy().view(np.uint64)
    return out


def judge(
    pages: DataFrame,
    listed: DataFrame,
    rules: Iterable[tuple[str, str, str]] = RULES,
    id_column: str = "page_id",
    url_column: str = "url",
) -> DataFrame:
    """One row per page: ``id_column``, ``host``, ``path``, ``rule``, ``verdict``, ``listed_key``.

    The longest rule that fits decides. Where none fits, a URL is blocked if
    its canonical form, its host or a parent host is in ``listed`` (``key``),
    else allowed. A listed key with ``://`` is a URL and made canonical here; one
    without a path then stands for its host. A null URL, or one without ``://``, has neither host nor path and
    is allowed. ``listed_key`` is the longest listed key of a URL no rule fits.

    Verdicts of the list are found once per distinct URL that passes the
    filter; a URL or host with a third of all rows is one row per task there.
    """
    given = F.col("key").cast("string")
    key = F.when(given.contains("://"), canonical(host_of(given), path_of(given))).otherwise(given)
    keys = listed.select(key.alias("key")).where("key <> ''").distinct()
    keys = materialize(keys, "listed-keys")
    shared = pages.sparkSession.sparkContext.broadcast(build_filter(keys))  # at most MOST_BYTES

    url = F.col(url_column).cast("string")
    host, path = host_of(url), path_of(url)
    rule, decided = rule_for(F.col("host"), F.col("path"), rules)
    parsed = (
        pages.select(F.col(id_column).alias("k"), host.alias("host"), path.alias("path"))
        .withColumns({"rule": rule, "decided": decided})
        .withColumn(
            "keys",
            F.when(F.col("rule").isNotNull() | (F.col("host") == ""), F.array().cast("array<string>")).otherwise(
                F.array_distinct(F.concat(F.array(canonical(F.col("host"), F.col("path"))), parent_hosts(F.col("host"))))
            ),
        )
        .withColumn("hashes", F.transform("keys", lambda x: F.xxhash64(x)))
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column("hashes")
            flat = hashes.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            good = shared.value.passes(flat)
            cuts = np.concatenate([[0], np.cumsum(hashes.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
            chosen = np.concatenate([[0], np.cumsum(good)])[cuts].astype(np.int32)
            kept = pa.ListArray.from_arrays(pa.array(chosen), batch.column("keys").flatten().filter(pa.array(good)))
            rest = [batch.column(n) for n in ("k", "host", "path", "rule", "decided")]
            yield pa.RecordBatch.from_arrays([*rest, kept], ["k", "host", "path", "rule", "decided", "possible"])

    kind = parsed.schema["k"].dataType.simpleString()
    tested = materialize(
        parsed.mapInArrow(
            run, f"k {kind}, host string, path string, rule string, decided string, possible array<string>"
        ),
        "tested-urls",
    )
    possible = tested.where(F.size("possible") > 0)
    pairs = possible.select("host", "path", F.explode("possible").alias("key")).distinct()
    hits = materialize(
        pairs.join(keys.hint("shuffle_hash"), "key")
        .groupBy("host", "path")
        .agg(F.max_by("key", F.struct(F.length("key"), "key")).alias("listed_key")),
        "listed-urls",
    )
    out = ["k", "host", "path", "rule", "decided"]
    checked = possible.select(*out).join(hits, ["host", "path"], "left").select(*out, "listed_key")
    passed = tested.where(F.size("possible") == 0).select(*out, F.lit(None).cast("string").alias("listed_key"))
    return passed.unionByName(checked).select(
        F.col("k").alias(id_column),
        "host",
        "path",
        "rule",
        F.coalesce("decided", F.when(F.col("listed_key").isNotNull(), "block").otherwise("allow")).alias("verdict"),
        "listed_key",
    )
