"""SimHash near-dedup: BK-trees over fingerprints.

Fingerprints of 64 bits that differ in at most three agree in one of four
quarters of their bits, and, of the other 48 bits, in one of four quarters
again. So each distinct fingerprint goes to 16 shards, named by the 28 bits it
must share, and every linked pair meets in one of them. A shard's fingerprints
form a BK-tree (children keyed by their distance to the parent); each asks the
tree for what lies within the radius, following only the edges that can lead there.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardframe.llm.digests import text_digest
from wardframe.llm.texts import blank_words, byte_values, slices
from wardframe.session import materialize

SHINGLE, SEED, RADIUS = 3, 42, 3
SLICE_BYTES = 4 << 20
#: Fingerprints of a shard that one task compares with each other. A larger
#: shard is cut into blocks, and each pair of blocks is a shard of its own.
SHARD = 4_000
#: A subtree of so few fingerprints is not divided any further.
LEAF = 4


def _hashes(data: bytes | None, shingle: int, seed: int) -> Iterator[np.ndarray]:
    """The XXH64 of every shingle of a text, in parts; of fewer words, that of the whole sequence."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    carried, met = [], False
    for fresh in blank_words(data):
        words = carried + fresh
        n = max(0, len(words) - shingle + 1)
        hashes = np.fromiter((digest(b" ".join(words[i : i + shingle]), seed) for i in range(n)), dtype=np.uint64, count=n)
        for at in range(0, n, 1 << 16):
            yield hashes[at : at + (1 << 16)]
        met = met or n > 0
        carried = words[n:] if shingle > 1 else []
    if carried and not met:
        yield np.array([digest(b" ".join(carried), seed)], dtype=np.uint64)


def _ones(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def fingerprint(data: bytes | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The SimHash of a text: bit by bit, whether over half of the shingles' XXH64 have it set."""
    ones, total = np.zeros(64, dtype=np.int64), 0
    for hashes in _hashes(data, shingle, seed):
        ones += _ones(hashes)
        total += len(hashes)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])




def fingerprints(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = SHINGLE, seed: int = SEED
) -> DataFrame:
    """``id`` and ``fp`` (the fingerprint as a signed long) of every whole text; null texts have no words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "t", SLICE_BYTES):
            found = np.array([fingerprint(d, shingle, seed) for d in byte_values(batch.column("t"))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("k"), pa.array(found.view(np.int64))], ["id", "fp"])

    keyed = docs.select(F.col(id_column).alias("k"), F.col(text_column).cast("string").alias("t"))
    return keyed.mapInArrow(run, f"id {keyed.schema['k'].dataType.simpleString()}, fp bigint")






class BKTree:
    """Distinct fingerprints; the children of a node are keyed by their distance to it."""

    def __init__(self, values: np.ndarray, places: np.ndarray | None = None) -> None:
        places = np.arange(len(values)) if places is None else places
        self.root = None
        self.leaf = places
        self.values = values
        if len(places) > LEAF:
            self.root, rest = places[0], places[1:]
            apart = np.bitwise_count(values[rest] ^ values[self.root])
            order = np.argsort(apart, kind="stable")
            cuts = np.flatnonzero(np.diff(apart[order])) + 1
            self.children = {
                int(apart[group[0]]): BKTree(values, rest[group]) for group in np.split(order, cuts) if len(group)
            }

    def within(self, radius: int, queries: np.ndarray, places: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (place among ``queries``, place in the tree) no further apart than ``radius``."""
        if not len(places):
            return
        if self.root is None:
            apart = np.bitwise_count(queries[places][:, None] ^ self.values[self.leaf][None, :])
            a, b = np.nonzero(apart <= radius)
            yield places[a], self.leaf[b]
            return
        apart = np.bitwise_count(queries[places] ^ self.values[self.root]).astype(np.int16)
        near = places[apart <= radius]
        yield near, np.full(len(near), self.root)
        for edge, child in self.children.items():
            yield from child.within(radius, queries, places[np.abs(apart - edge) <= radius])


class Forest:
    """Disjoint sets of fingerprints, each named by its smallest."""

    def __init__(self) -> None:
        self.above: dict[int, int] = {}

    def top(self, x: int) -> int:
        above = self.above
        root = x
        while above.get(root, root) != root:
            root = above[root]
        while x != root:
            above[x], x = root, above.get(x, x)
        return root

    def join(self, a: int, b: int) -> None:
        a, b = self.top(a), self.top(b)
        if a != b:
            self.above[max(a, b)] = min(a, b)
            self.above.setdefault(min(a, b), min(a, b))

    def links(self) -> list[tuple[int, int]]:
        return [(x, root) for x in list(self.above) if (root := self.top(x)) != x]


def _tops(above: np.ndarray, x: np.ndarray) -> np.ndarray:
    x = above[x]
    while (up := above[x]).tobytes() != x.tobytes():
        x = up
    return x


def _join_all(above: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of ``a`` and ``b``, pair by pair; ``above`` points to smaller places."""
    while len(a):
        a, b = _tops(above, a), _tops(above, b)
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(above, np.maximum(a, b), np.minimum(a, b))


def _shard_links(node: np.ndarray, values: np.ndarray, halves: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Stars over what is linked in one shard; ``halves`` tells tree (0), queries (1) or both (2) of each."""
    order = np.argsort(node, kind="stable")
    node, values, halves = node[order], values[order], halves[order]
    above = np.arange(len(node))
    tree, queries = np.flatnonzero(halves != 1), np.flatnonzero(halves != 0)
    if len(tree) and len(queries):
        for a, b in BKTree(values, tree).within(radius, values, queries):
            _join_all(above, a, b)
    tops = _tops(above, np.arange(len(node)))
    linked = np.flatnonzero(tops != np.arange(len(node)))
    return node[linked], node[tops[linked]]


def links(distinct: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """Links among distinct fingerprints (``fp``), enough to connect all that are: ``a``, ``b`` with a > b.

    Every pair no further apart than ``radius`` (3 at most) is compared in some
    shard; of what a task finds connected it reports a star, not all pairs.
    """
    if not 0 <= radius <= 3:
        raise ValueError("four times four shards find pairs up to three bits apart")
    shards = []
    for outer in range(4):
        quarter = F.shiftrightunsigned("fp", 16 * outer).bitwiseAND(0xFFFF)
        low = F.col("fp").bitwiseAND((1 << 16 * outer) - 1)
        high = F.lit(0).cast("bigint") if outer == 3 else F.shiftleft(F.shiftrightunsigned("fp", 16 * (outer + 1)), 16 * outer)
        others = low.bitwiseOR(high)
        for inner in range(4):
            part = F.shiftrightunsigned(others, 12 * inner).bitwiseAND(0xFFF)
            shards.append(
                F.lit(4 * outer + inner).cast("bigint") * F.lit(1 << 28) + quarter * F.lit(1 << 12) + part
            )
    keyed = distinct.select(F.col("fp").alias("node"), F.explode(F.array(*shards)).alias("key"))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    large = materialize(sizes.where(F.col("size") > shard), "large-shards")
    blocks = F.coalesce(F.ceil(F.col("size") / shard), F.lit(1)).cast("int")
    placed = (
        keyed.join(large, "key", "left")
        .select("node", "key", blocks.alias("blocks"))
        .select("*", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("mine"))
        .select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    )
    return _linked(placed, radius)




def _by_pairs_of_blocks(placed: DataFrame, given: list[str]) -> DataFrame:
    """The columns ``given``, dealt and sorted by shard: a row goes to the pair of ``mine`` and ``other`` of its ``key``."""
    paired = placed.select(
        *given[:-3],
        F.least("mine", "other").alias("i"),
        F.greatest("mine", "other").alias("j"),
        F.when(F.col("mine") == F.col("other"), 2).when(F.col("mine") < F.col("other"), 0).otherwise(1).alias("half"),
    )
    n = max(1, int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return paired.repartition(n, "key", "i", "j").sortWithinPartitions("key", "i", "j")


def _whole_shards(
    batches: Iterable[pa.RecordBatch], given: list[str]
) -> Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray]]:
    """The columns ``given`` of whole pairs of blocks, and where each pair begins and ends."""
    held: list[np.ndarray] = []  # of the pair that the last batch did not end
    for batch in batches:
        rows = [batch.column(n).to_numpy(zero_copy_only=False) for n in given]
        if held:
            rows = [np.concatenate(x) for x in zip(held, rows, strict=True)]
        if not len(rows[0]):
            continue
        key, i, j = rows[-4:-1]
        new = (np.diff(key) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)
        starts = np.concatenate([[0], np.flatnonzero(new) + 1])
        yield rows, starts[:-1], starts[1:]
        held = [x[starts[-1] :].copy() for x in rows]
    if held:
        yield held, np.array([0]), np.array([len(held[0])])


def _linked(placed: DataFrame, radius: int) -> DataFrame:
    """Links found by comparing blocks of fingerprints, which are their nodes."""
    given = ["node", "key", "i", "j", "half"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        for rows, starts, ends in _whole_shards(batches, given):
            _each(rows[0], rows[0].view(np.uint64), rows[-1], starts, ends, forest, radius)
        found = forest.links()
        for at in range(0, len(found), 50_000):
            part = found[at : at + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in part], pa.int64()), pa.array([y for _, y in part], pa.int64())], ["a", "b"]
            )

    return _by_pairs_of_blocks(placed, given).mapInArrow(run, "a bigint, b bigint").distinct()


def _each(node, values, half, starts, ends, forest: Forest, radius: int) -> None:
    """Search the shards from ``starts`` to ``ends`` that have more than one fingerprint, each by its tree."""
    several = ends - starts > 1
    for at, end in zip(starts[several].tolist(), ends[several].tolist(), strict=True):
        a, b = _shard_links(node[at:end], values[at:end], half[at:end], radius)
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            forest.join(x, y)


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """The smallest value reachable from each value with a link: ``fp``, ``root``; ``edges`` has ``a`` > ``b``.

    Rounds of two steps, large star and small star: each value hangs its larger
    neighbours, then its smaller ones, under the smallest that it knows, until
    all hang under the smallest of their component. Only minima are gathered by
    value, by partial aggregation; each round is written to the shared folder.
    """
    edges = materialize(edges.select("a", "b"), "links")
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        least = materialize(least, "least")  # a plain exchange on both sides of the join lets Spark split hubs
        large = (
            both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        )
        large = materialize(large, "large-star")
        least = materialize(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(least, "a").select(
            F.explode(
                F.array(
                    F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
                    F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                )
            ).alias("e")
        )
        small = materialize(small.select("e.a", "e.b").where("a > b").distinct(), "small-star")
        if _mark(small) == _mark(edges):
            return small.select(F.col("a").alias("fp"), F.col("b").alias("root"))
        edges = small
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = SHINGLE,
    seed: int = SEED,
    radius: int = RADIUS,
    shard: int = SHARD,
) -> DataFrame:
    """One row per document: ``id_column``, ``fingerprint`` (16 hex digits), ``component_id``.

    Fingerprints link at ``radius`` or fewer differing bits; ``component_id`` is
    the smallest id reachable over links, the document's own included. Texts
    without words (null ones too) have fingerprint 0. A null id is larger than
    any other: it names a component only if no member has an id.
    """
    marked = materialize(fingerprints(docs, id_column, text_column, shingle, seed), "fingerprints")
    distinct = materialize(marked.groupBy("fp").agg(F.min("id").alias("least")), "distinct-fingerprints")
    labels = _named(distinct, components(links(distinct.select("fp"), radius, shard)))
    return marked.join(labels, "fp").select(
        F.col("id").alias(id_column),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def _named(distinct: DataFrame, roots: DataFrame) -> DataFrame:
    """``fp`` and ``component_id``, the smallest id of its component, of each of ``distinct`` (``fp``, ``least``)."""
    rooted = distinct.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = materialize(named, "component-names")  # a plain exchange on both sides of the join lets Spark split a large one
    return materialize(rooted.join(named, "root").select("fp", "component_id"), "components")


def representatives(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = SHINGLE,
    seed: int = SEED,
    radius: int = RADIUS,
) -> DataFrame:
    """One document of each component of ``near_duplicates``, with all its columns: the one that names it.

    Rows without an id name a component only where no member has one; then the
    one whose text has the smallest digest stays. Verdicts go by row, that is by
    id and text: another text under the same id, or also without one, has a
    verdict of its own. Repeated rows of what stays all stay.
    """
    digest = F.unhex(text_digest(F.col(text_column)))
    keyed = docs.withColumn("__row", F.struct(F.col(id_column).isNull().alias("none"), F.col(id_column).alias("id"), digest.alias("digest")))
    marked = materialize(fingerprints(keyed, "__row", text_column, shingle, seed), "fingerprints")
    distinct = materialize(marked.groupBy("fp").agg(F.min("id").alias("least")), "distinct-fingerprints")
    labels = _named(distinct, components(links(distinct.select("fp"), radius)))
    gone = marked.join(labels, "fp").where(F.col("id") != F.col("component_id")).select(F.col("id").alias("__gone"))
    same = [keyed["__row"][c].eqNullSafe(F.col("__gone")[c]) for c in ("none", "id", "digest")]
    return keyed.join(gone.distinct(), same, "left_anti").select(*docs.columns)
