"""MinHash near-dedup: one-permutation hashing, banded buckets, stars of candidates, exact confirmation.

One hash of each distinct shingle serves all bins: a bin holds the least hash of its
range, and an empty bin takes over the value of another one, the first that is not
empty in a random order of its own (optimal densification). Values of several bins
together name a bucket. Candidates form stars: a document is compared with one hub of
its buckets, so that their number follows the documents, not the pairs. Buckets that
still hold several components are searched whole, inside tasks and in blocks, and
report stars again. Every link is confirmed on the full sets of shingles.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardframe.llm.simhash import Forest, _by_pairs_of_blocks, components
from wardframe.llm.texts import ascii_lower, blank_words, byte_values, slices
from wardframe.session import materialize

SHINGLE = 4
#: Links have 100 times the intersection at or above this many times the union.
PERCENT = 80
#: Buckets of each document, and bins that name one: at a similarity of 0.8 two documents
#: share none with a probability of (1 - 0.8^5)^30, 7 in a million.
BANDS, ROWS = 30, 5
BINS = BANDS * ROWS
#: Bins in which documents agree at least to be compared exactly: at 0.8 the mean is 120, give or take 4.9.
LEAST_AGREED = 93
#: Documents of a bucket, or members of a star, that one task compares; shingles of those compared exactly.
BLOCK, STAR, BLOCK_SHINGLES = 4_000, 2_000, 1 << 20
SLICE_BYTES = 4 << 20
#: Bits of filter for each text to read again, bits set in its block of 64, and blocks at most (32 MB).
TEXT_BITS, SET_BITS, MOST_BLOCKS = 24, 5, 4 << 20
#: Word hashes that a task remembers, and hashes of a text from which repetitions are taken out at a time.
REMEMBERED, SET_PART = 500_000, 1 << 20
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > REMEMBERED:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


def shingle_set(data: bytes | None, hashes: dict[bytes, int] | None = None) -> np.ndarray:
    """The sorted hashes of a text's distinct shingles of ``SHINGLE`` words, or of its whole sequence of fewer words."""
    hashes = _WordHashes() if hashes is None else hashes
    found, parts, held, carried = np.zeros(0, dtype=np.uint64), [], 0, np.zeros(0, dtype=np.uint64)
    met = False
    for words in blank_words(data):
        fresh = np.fromiter((hashes[w] for w in words), dtype=np.uint64, count=len(words))
        run = np.concatenate([carried, fresh])
        n = len(run) - SHINGLE + 1
        if n > 0:
            made = sum(run[j : j + n] * _ODD[j] for j in range(SHINGLE))
            parts.append(_mixed(made))
            held, met = held + n, True
            run = run[n:]
        carried = run
        if held > max(SET_PART, len(found)):
            found, parts, held = np.unique(np.concatenate([found, *parts])), [], 0
    if len(carried) and not met:
        whole = sum(carried[j : j + 1] * _ODD[j] for j in range(len(carried)))
        parts.append(_mixed(whole + np.uint64(len(carried)) * _ODD[4]))
    return np.unique(np.concatenate([found, *parts])) if parts else found


_RANKS = np.argsort(np.random.default_rng(BINS).random((BINS, BINS)), axis=1).astype(np.int16)


def signature(every: np.ndarray) -> np.ndarray:
    """The value of each bin of a set of sorted hashes that is not empty."""
    bins = ((every >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)
    first = np.flatnonzero(np.diff(bins.astype(np.int64), prepend=-1))
    filled = bins[first].astype(np.int64)
    values = np.zeros(BINS, dtype=np.uint64)
    values[filled] = every[first]
    if len(filled) < BINS:
        empty = np.setdiff1d(np.arange(BINS), filled, assume_unique=True)
        nearest = filled[_RANKS[np.ix_(empty, filled)].argmin(axis=1)]
        values[empty] = values[nearest]
    return values


def bucket_names(values: np.ndarray) -> np.ndarray:
    """The names of the ``BANDS`` buckets of a signature."""
    rows = values.reshape(BANDS, ROWS)
    return _mixed((rows * _ODD[:ROWS]).sum(axis=1, dtype=np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64))


def _text_key(text: Column) -> Column:
    return F.xxhash64(F.lit("text"), ascii_lower(text))


def _marked(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``id``, ``th``, ``n``, ``node`` (names the set), ``names`` of buckets, and ``agree``: a byte of each bin's value."""
    import xxhash

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in slices(batches, "t", SLICE_BYTES):
            sizes, nodes, names, agree = [], [], [], []
            for data in byte_values(batch.column("t")):
                every = shingle_set(data, hashes)
                sizes.append(len(every))
                nodes.append(xxhash.xxh64_intdigest(every.tobytes(), SHINGLE) if len(every) else 0)
                values = signature(every) if len(every) else None
                names.append(None if values is None else bucket_names(values).tobytes())
                agree.append(None if values is None else (values & np.uint64(0xFF)).astype(np.uint8).tobytes())
            columns = [
                batch.column("k"), batch.column("th"), pa.array(sizes, pa.int64()),
                pa.array(np.array(nodes, dtype=np.uint64).view(np.int64)), pa.array(names, pa.binary()), pa.array(agree, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "th", "n", "node", "names", "agree"])

    text = F.col(text_column).cast("string")
    keyed = docs.select(F.col(id_column).alias("k"), _text_key(text).alias("th"), text.alias("t"))
    kind = keyed.schema["k"].dataType.simpleString()
    return keyed.mapInArrow(run, f"id {kind}, th bigint, n bigint, node bigint, names binary, agree binary")


def _buckets(distinct: DataFrame) -> DataFrame:
    """``node``, ``n`` and ``key`` of every place in a bucket of two or more, with the bucket's hub (``hub``, ``hub_n``)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                keys = np.frombuffer(b"".join(part.column("names").to_pylist()), dtype=np.int64)
                columns = [np.repeat(part.column(c).to_numpy(), BANDS) for c in ("node", "n")]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(keys)], ["node", "n", "key"])

    keyed = distinct.select("node", "n", "names").mapInArrow(run, "node bigint, n bigint, key bigint")
    hubs = keyed.groupBy("key").agg(F.min(F.struct("node", "n")).alias("hub"), F.count("*").alias("size")).where("size > 1")
    hubs = materialize(hubs.select("key", "hub.node", "hub.n").toDF("key", "hub", "hub_n"), "hubs")
    return materialize(keyed.join(hubs, "key"), "shared-buckets")


def _row_key(key: Column, th: Column) -> Column:
    return F.xxhash64(th, key.cast("string"))


def _filter_places(rows: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    mixed = _mixed(rows.view(np.uint64))
    bits = np.zeros(len(mixed), dtype=np.uint64)
    for i in range(SET_BITS):
        bits |= np.uint64(1) << ((mixed >> np.uint64(6 * i)) & np.uint64(63))
    return (((mixed >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)).astype(np.int64), bits


def _row_filter(wanted: DataFrame) -> np.ndarray:
    """A blocked Bloom filter of the rows that ``wanted`` names, ``MOST_BLOCKS`` blocks at most."""
    blocks = int(min(MOST_BLOCKS, max(1, wanted.count() * TEXT_BITS // 64)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block, bits = _filter_places(batch.column("row").to_numpy(), blocks)
            yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(bits.view(np.int64))], ["block", "bits"])

    rows = wanted.select(_row_key(F.col("id"), F.col("th")).alias("row")).mapInArrow(run, "block bigint, bits bigint")
    found = rows.groupBy("block").agg(F.bit_or("bits").alias("bits")).toArrow()
    held = np.zeros(blocks, dtype=np.uint64)
    held[found.column("block").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return held


def _sets(docs: DataFrame, wanted: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """The columns of ``wanted`` (with ``id``, ``th``) and ``shingles`` of the texts that they name.

    Texts stay where they are read: a filter of bounded size passes the wanted ones, and a
    few others, and only their sets are shuffled to the exact join.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_row_filter(wanted))  # MOST_BLOCKS blocks at most
    text = F.col(text_column).cast("string")
    rows = docs.select(F.col(id_column).alias("__id"), _text_key(text).alias("th"), text.alias("t"))
    rows = rows.select("__id", "th", _row_key(F.col("__id"), F.col("th")).alias("row"), "t")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, hashes = shared.value, _WordHashes()
        for batch in batches:
            block, bits = _filter_places(batch.column("row").to_numpy(), len(held))
            passed = batch.filter(pa.array(held[block] & bits == bits))
            for part in slices([passed], "t", SLICE_BYTES):
                found = [shingle_set(d, hashes).view(np.int64) for d in byte_values(part.column("t"))]
                ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
                flat = pa.array(np.concatenate([np.zeros(0, dtype=np.int64), *found]))
                arrays = pa.ListArray.from_arrays(pa.array(ends), flat)
                yield pa.RecordBatch.from_arrays([part.column("__id"), part.column("th"), arrays], ["__id", "th", "shingles"])

    kind = rows.schema["__id"].dataType.simpleString()
    sets = rows.mapInArrow(run, f"__id {kind}, th bigint, shingles array<bigint>")
    same = (sets["th"] == wanted["th"]) & sets["__id"].eqNullSafe(wanted["id"])
    kept = [c for c in wanted.columns if c not in ("id", "th")]
    return sets.join(wanted.hint("merge"), same).select(*(wanted[c] for c in kept), "shingles")


def linked(shared: int, a: int, b: int) -> bool:
    """Whether sets of ``a`` and ``b`` shingles with ``shared`` common ones link."""
    return 100 * shared >= PERCENT * (a + b - shared)


def _fit(a: str, b: str) -> Column:
    """Whether sets of so many shingles can link at all."""
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def _hashed_list(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    column = batch.column("shingles")
    flat, ends = column.values.to_numpy(), column.offsets.to_numpy()
    for begin, end in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        yield flat[begin:end].view(np.uint64)


def _star_links(docs: DataFrame, distinct: DataFrame, shared: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Confirmed links (``a`` > ``b``) of each node with the least hub of its buckets.

    The members of a hub are dealt to groups of some ``STAR``; the hub's set goes to each.
    """
    stars = shared.where((F.col("node") != F.col("hub")) & _fit("n", "hub_n")).groupBy("node").agg(F.min("hub").alias("hub"))
    stars = materialize(stars, "stars")
    parts = F.ceil(F.count("*") / STAR).cast("int").alias("parts")
    sizes = materialize(stars.groupBy("hub").agg(parts), "star-sizes")
    members = stars.join(sizes, "hub").select(
        "node", "hub", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("member")
    )
    centres = sizes.select(
        F.col("hub").alias("node"), "hub", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("member")
    )
    # a node's groups travel with its name, so that each text is read for all of them at once
    groups = members.unionByName(centres).groupBy("node").agg(F.collect_list(F.struct("hub", "part", "member")).alias("groups"))
    wanted = materialize(groups.join(distinct.select("node", "id", "th"), "node"), "star-members")
    sets = _sets(docs, wanted, id_column, text_column)
    rows = sets.select(F.explode("groups").alias("g"), "node", "shingles").select("g.hub", "g.part", "g.member", "node", "shingles")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, centre = None, None
        for batch in batches:
            found = []
            columns = [batch.column(c).to_pylist() for c in ("hub", "part", "member", "node")]
            for hub, part, member, node, every in zip(*columns, _hashed_list(batch), strict=True):
                if (hub, part) != group:
                    group, centre = (hub, part), None
                if not member:
                    centre = every.copy()
                elif centre is not None:
                    at = np.minimum(np.searchsorted(centre, every), len(centre) - 1)
                    if linked(int((centre[at] == every).sum()), len(centre), len(every)):
                        found.append((max(node, hub), min(node, hub)))
            if found:
                a, b = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    n = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.repartition(n, "hub", "part").sortWithinPartitions("hub", "part", "member")
    return materialize(dealt.mapInArrow(run, "a bigint, b bigint"), "star-links")


def _whole_groups(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each pair of blocks (``key``, ``i``, ``j``), which come sorted."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        names = [batch.column(c).to_numpy() for c in ("key", "i", "j")]
        cuts = np.flatnonzero(np.any([np.diff(x) != 0 for x in names], axis=0)) + 1
        if held and any(held[-1].column(c)[-1].as_py() != batch.column(c)[0].as_py() for c in ("key", "i", "j")):
            yield pa.Table.from_batches(held)
            held = []
        begin = 0
        for cut in [*cuts.tolist(), batch.num_rows]:
            part = batch.slice(begin, cut - begin)
            begin = cut
            held.append(part)
            if cut < batch.num_rows:
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


def _placed(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """The rows (``node``, ``key``), each for all blocks of its bucket (``key``, ``blocks``)."""
    mine = F.pmod(F.xxhash64("node", "key"), F.col("blocks")).cast("int")
    return rows.join(blocks, "key").select(
        *rows.columns, mine.alias("mine"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    )


def _unsettled(distinct: DataFrame, shared: DataFrame, roots: DataFrame) -> DataFrame:
    """``key`` and ``node`` of documents to compare exactly: in a bucket with one of another component that may be similar.

    A pair is looked at only in the bucket of least name that it shares, in pairs of blocks.
    """
    rooted = shared.select("node", "n", "key").join(roots.withColumnRenamed("fp", "node"), "node", "left")
    rooted = materialize(rooted.select("node", "n", "key", F.coalesce("root", "node").alias("root")), "rooted-buckets")
    blocks = rooted.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    blocks = materialize(blocks.where("r0 <> r1").select("key", "blocks"), "mixed-buckets")
    placed = _placed(rooted, blocks).join(distinct.select("node", "names", "agree"), "node")
    given = ["node", "n", "root", "names", "agree", "key", "i", "j", "half"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches):
            key = table.column("key")[0].as_py()
            node, n, root, half = (table.column(c).to_numpy() for c in ("node", "n", "root", "half"))
            names = np.frombuffer(b"".join(table.column("names").to_pylist()), dtype=np.int64).reshape(-1, BANDS)
            agree = np.frombuffer(b"".join(table.column("agree").to_pylist()), dtype=np.uint8).reshape(-1, BINS)
            flagged = _flagged(key, n, root, half, names, agree)
            if flagged.any():
                kept = node[flagged]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(kept), key)), pa.array(kept)], ["key", "node"])

    found = _by_pairs_of_blocks(placed, given).mapInArrow(run, "key bigint, node bigint")
    return materialize(found.distinct(), "unsettled")


def _flagged(key: int, n, root, half, names, agree) -> np.ndarray:
    """Which documents of a pair of blocks have a candidate of another component in the other block."""
    flagged = np.zeros(len(n), dtype=bool)
    left, right = np.flatnonzero(half != 1), np.flatnonzero(half != 0)
    for a in left.tolist():
        few, many = np.minimum(n[a], n[right]), np.maximum(n[a], n[right])
        others = right[(root[right] != root[a]) & (100 * few >= PERCENT * many)]
        others = others[(agree[others] == agree[a]).sum(axis=1) >= LEAST_AGREED] if len(others) else others
        if len(others):
            common = np.where(names[others] == names[a], names[others], np.iinfo(np.int64).max).min(axis=1)
            others = others[common == key]
        if len(others):
            flagged[a] = True
            flagged[others] = True
    return flagged


def _rest_links(
    docs: DataFrame, distinct: DataFrame, unsettled: DataFrame, roots: DataFrame, id_column: str, text_column: str
) -> DataFrame:
    """Confirmed links between components, of what ``_unsettled`` found; each pair of blocks reports stars."""
    nodes = unsettled.select("node").distinct().join(distinct.select("node", "n", "id", "th"), "node")
    nodes = nodes.join(roots.withColumnRenamed("fp", "node"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    nodes = materialize(nodes, "unsettled-nodes")
    sets = materialize(_sets(docs, nodes.select("node", "root", "id", "th"), id_column, text_column), "unsettled-sets")
    sized = unsettled.join(nodes.select("node", "n"), "node")
    blocks = sized.groupBy("key").agg(
        F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks")
    )
    placed = _placed(unsettled.select("node", "key"), materialize(blocks, "unsettled-blocks")).join(sets, "node")
    given = ["node", "root", "shingles", "key", "i", "j", "half"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        for table in _whole_groups(batches):
            node, root, half = (table.column(c).to_numpy() for c in ("node", "root", "half"))
            sets_ = [x for part in table.to_batches() for x in _hashed_list(part)]
            for a, b in _exact_links(root, half, sets_):
                forest.join(int(node[a]), int(node[b]))
        found = forest.links()
        for at in range(0, len(found), 50_000):
            a, b = zip(*found[at : at + 50_000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    found = _by_pairs_of_blocks(placed, given).mapInArrow(run, "a bigint, b bigint")
    return materialize(found.distinct(), "rest-links")


def _exact_links(root: np.ndarray, half: np.ndarray, sets: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    """Places of linked sets of different components, one of each block: common shingles are counted by postings."""
    sizes = np.array([len(s) for s in sets])
    right = np.flatnonzero(half != 0)
    held = np.concatenate([sets[i] for i in right]) if len(right) else np.zeros(0, dtype=np.uint64)
    owner = np.repeat(np.arange(len(right)), sizes[right])
    order = np.argsort(held, kind="stable")
    held, owner = held[order], owner[order]
    for a in np.flatnonzero(half != 1).tolist():
        begin, end = np.searchsorted(held, sets[a], "left"), np.searchsorted(held, sets[a], "right")
        among = [owner[x:y] for x, y in zip(begin.tolist(), end.tolist(), strict=True) if y > x]
        if not among:
            continue
        shared = np.bincount(np.concatenate(among), minlength=len(right))
        fit = (100 * shared >= PERCENT * (sizes[a] + sizes[right] - shared)) & (root[right] != root[a])
        for b in right[fit].tolist():
            yield a, b


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: ``id_column``, ``n_shingles``, ``component_id``, ``kept``.

    Words are runs without white space after lower-casing A-Z; a document's set holds its
    distinct shingles of ``SHINGLE`` words, of fewer words the whole sequence. Documents
    link if 100 times the intersection of their sets is at least ``PERCENT`` times the
    union; ``component_id`` is the smallest id reachable. A text without words (also
    a null or empty one) has an empty set and is linked with nothing. Equal sets are one
    node, so copies and repeated rows cost one row each. A null id is larger than
    any other: it names a component only if no member has an id. An empty table gives no
    rows; other columns are not read.

    Sets hold 64-bit hashes of shingles. Of pairs that link, at a similarity of just 0.8,
    7 in a million share no bucket, and fewer agree in under ``LEAST_AGREED`` bins.
    """
    marked = materialize(_marked(docs, id_column, text_column), "minhash-marks")
    some = marked.where("n > 0")
    distinct = some.groupBy("node").agg(
        F.min("n").alias("n"), F.min("names").alias("names"), F.min("agree").alias("agree"),
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "th")).alias("one"),
    )
    distinct = materialize(distinct.select("node", "n", "names", "agree", "one.id", "one.th"), "distinct-sets")
    shared = _buckets(distinct)
    stars = _star_links(docs, distinct, shared, id_column, text_column)
    roots = components(stars)
    unsettled = _unsettled(distinct, shared, roots)
    if not unsettled.isEmpty():
        rest = _rest_links(docs, distinct, unsettled, roots, id_column, text_column)
        if not rest.isEmpty():
            roots = components(stars.unionByName(rest))
    rooted = distinct.select("node", "id").join(roots.withColumnRenamed("fp", "node"), "node", "left")
    rooted = rooted.select("node", "id", F.coalesce("root", "node").alias("root"))
    least = materialize(rooted.groupBy("root").agg(F.min("id").alias("component_id")), "component-names")
    labels = materialize(rooted.join(least, "root").select("node", "component_id"), "components")
    some = some.select("id", "n", "node").join(labels, "node").select("id", "n", "component_id")
    alone = marked.where("n = 0").select("id", "n", F.col("id").alias("component_id"))
    return some.unionByName(alone).select(
        F.col("id").alias(id_column),
        F.col("n").alias("n_shingles"),
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
