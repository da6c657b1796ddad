"""The trie of conversation prefixes, its subtrees summed by time-forward processing.

A prefix is named by its depth and the exclusive or of hashes of its turns with
their places, so that no conversation is held whole and a parent's name follows
from its child's. Subtree sums are carried from children to parents: nodes are
dealt to shards and sorted by reverse level order, and a node takes what its
children sent from a priority queue that spills. What leaves a shard goes to nodes
of other shards; these, and the ways from them out of their own shards, are a
much smaller forest, which is summed in the same manner, in fewer shards. A
second pass over the shards then adds what came from outside.
"""

from __future__ import annotations

import heapq
import hashlib
import pickle
import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardframe.operators.ranks import ranked
from wardframe.session import materialize

#: Conversations that share a head: those of one multiple of this number.
NEAR = 20
#: Turns that a conversation takes over are fewer than this.
MOST_HEAD = 4
#: Levels of a chain of turns that lie together in a shard, and in a block of running hashes.
LEVELS = 4096
#: Messages that a priority queue holds before it spills; characters of ids in a row.
HELD_MESSAGES, CHUNK = 200_000, 1 << 20
#: Shards for each shuffle partition; the next forest has so many times fewer.
SHARDS, FEWER = 4, 16
BATCH = 20_000
_WORD = r"[^\x20\x09-\x0D]+"


# --- rebuilt conversations ----------------------------------------------------------------------


def _turns(conversations: DataFrame) -> DataFrame:
    """``conv``, ``place`` from 1, the digest ``a``, ``b`` and the words ``w`` of each turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    slim = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv"),
        F.col("turn").alias("turn"),
        digest.alias("digest"),
        F.regexp_count(text, F.lit(_WORD)).cast("bigint").alias("w"),
    )
    placed = ranked(slim, ["conv"], [F.col("turn").asc_nulls_first(), F.col("digest")], "place")
    return materialize(placed.select("conv", "place", "digest", "w"), "turns")


def head_length(conv: Column) -> Column:
    """How many turns a conversation takes over."""
    return F.crc32(conv.cast("string").cast("binary")) % MOST_HEAD


def rebuilt(conversations: DataFrame) -> DataFrame:
    """``conv``, ``depth`` from 0, ``digest`` and ``w`` of the turns of every rebuilt conversation.

    The first turns come from the conversation of the next lower multiple of ``NEAR``,
    as many as ``head_length`` says; own turns follow, without as many first ones.
    The row of depth 0 has no turn. Turns are ordered by ``turn``, null first; equal
    ones by their digest. Rows without ``conv_id`` belong to no conversation.
    """
    turns = _turns(conversations)
    heads = turns.where((F.col("conv") % NEAR == 0) & (F.col("place") < MOST_HEAD)).select(
        F.col("conv").alias("base"), F.col("place").alias("depth"), "digest", "w"
    )
    ids = turns.groupBy("conv").agg(F.max("place").alias("own")).select(
        "conv", "own", (F.col("conv") - F.col("conv") % NEAR).alias("base"), head_length(F.col("conv")).alias("head")
    )
    sizes = heads.groupBy("base").agg(F.max("depth").alias("has"))
    ids = materialize(
        ids.join(sizes, "base", "left").select(
            "conv", "base", "own", "head", F.least("head", F.coalesce("has", F.lit(0).cast("bigint"))).alias("taken")
        ),
        "conversation-heads",
    )
    own = turns.join(ids.select("conv", "head", "taken"), "conv").where("place > head")
    own = own.select("conv", (F.col("place") - F.col("head") + F.col("taken")).alias("depth"), "digest", "w")
    taken = ids.where("taken > 0").join(heads, "base").where("depth <= taken").select("conv", "depth", "digest", "w")
    root = ids.select("conv", F.lit(0).cast("bigint").alias("depth"), F.lit("").alias("digest"), F.lit(0).cast("bigint").alias("w"))
    length = (F.col("taken") + F.greatest(F.col("own") - F.col("head"), F.lit(0))).alias("length")
    rows = root.unionByName(taken).unionByName(own)
    return rows.join(ids.select("conv", length), "conv")


def _named(rows: DataFrame) -> DataFrame:
    """The rows of ``rebuilt`` with the name ``p``, ``q`` of their prefix and ``f``, ``g``, what its last turn added to it.

    Running exclusive ors are taken in blocks of ``LEVELS`` turns, so a conversation with
    a third of all turns lies in many tasks; the blocks of longer ones are added up apart.
    """
    some = F.col("depth") > 0
    rows = rows.select(
        "conv",
        "depth",
        "w",
        "length",
        F.when(some, F.xxhash64("depth", "digest")).otherwise(0).alias("f"),
        F.when(some, F.xxhash64(F.lit("other"), "digest", "depth")).otherwise(0).alias("g"),
        F.expr(f"depth div {LEVELS}").alias("block"),
    )
    inside = Window.partitionBy("conv", "block").orderBy("depth")
    rows = materialize(rows.select("*", *[F.bit_xor(c).over(inside).alias(n) for c, n in (("f", "p"), ("g", "q"))]), "prefixes")
    ends = rows.groupBy("conv", "block").agg(F.bit_xor("f").alias("f"), F.bit_xor("g").alias("g"), F.max("length").alias("length"))
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = ends.where(F.col("length") >= LEVELS).select(
        "conv", "block", *[F.bit_xor(c).over(earlier).alias(f"{c}0") for c in ("f", "g")]
    )
    whole = rows.join(before.where("block > 0"), ["conv", "block"], "left")
    zero = F.lit(0).cast("bigint")
    return whole.select(
        "conv",
        "depth",
        "w",
        "length",
        "f",
        "g",
        F.col("p").bitwiseXOR(F.coalesce("f0", zero)).alias("p"),
        F.col("q").bitwiseXOR(F.coalesce("g0", zero)).alias("q"),
    )


# --- ids that end at a node ---------------------------------------------------------------------


def _ends(rows: DataFrame) -> DataFrame:
    """``depth``, ``p``, ``q`` and ``ends``: the SHA-256 of the ascending ids that end there, joined by commas.

    Ids are sorted in ranges and joined where they lie, so that a node at which a third of
    all conversations end comes to the task that hashes it in a few long rows, one at a time.
    """
    key = ["depth", "p", "q"]

    def joined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, held, node, first, ids, size = [], 0, None, None, [], 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in [*key, "conv"]), strict=True):
                if row[:3] != node or size > CHUNK:
                    if ids:
                        made.append((*node, first, ",".join(ids)))
                    held += size
                    node, first, ids, size = row[:3], row[3], [], 0
                    if len(made) >= BATCH or held > CHUNK:
                        yield _batch(made, [*key, "first", "ids"])
                        made, held = [], 0
                ids.append(str(row[3]))
                size += len(ids[-1]) + 1
        if ids:
            made.append((*node, first, ",".join(ids)))
        if made:
            yield _batch(made, [*key, "first", "ids"])

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, node, digest = [], None, None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in [*key, "ids"]), strict=True):
                if row[:3] == node:
                    digest.update(b"," + row[3].encode())
                    continue
                if node:
                    made.append((*node, digest.hexdigest()))
                node, digest = row[:3], hashlib.sha256(row[3].encode())
            if len(made) >= BATCH:
                yield _batch(made, [*key, "ends"])
                made = []
        if node:
            made.append((*node, digest.hexdigest()))
            yield _batch(made, [*key, "ends"])

    n = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    last = rows.where("depth = length").select(*key, "conv")
    pieces = last.repartitionByRange(n, *key, "conv").sortWithinPartitions(*key, "conv")
    pieces = pieces.mapInArrow(joined, "depth bigint, p bigint, q bigint, first bigint, ids string")
    whole = pieces.repartition(n, *key).sortWithinPartitions(*key, "first")
    return whole.mapInArrow(hashed, "depth bigint, p bigint, q bigint, ends string")


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names)


# --- subtree sums -------------------------------------------------------------------------------

Key = tuple[int, int, int]


class SpillingQueue:
    """Messages to nodes, given out by descending key; beyond ``held`` they go to sorted runs on disk.

    The runs are a task's own scratch: nothing else reads them, a repeated task writes
    its own, and their file has no name, so that nothing is left of it.
    """

    def __init__(self, held: int = HELD_MESSAGES) -> None:
        self.held, self.heap, self.heads, self.put_so_far = held, [], [], 0

    def put(self, key: Key, message: tuple) -> None:
        self.put_so_far += 1  # messages to one key are not compared
        heapq.heappush(self.heap, (-key[0], -key[1], -key[2], self.put_so_far, message))
        if len(self.heap) > self.held:
            self.heap.sort()
            run = self._written(self.heap)
            self.heap = []
            heapq.heappush(self.heads, (next(run), run))

    def _written(self, rows: list[tuple]) -> Iterator[tuple]:
        scratch = tempfile.TemporaryFile()
        for at in range(0, len(rows), 1000):
            pickle.dump(rows[at : at + 1000], scratch)
        scratch.seek(0)
        parts = -(-len(rows) // 1000)

        def read() -> Iterator[tuple]:
            with scratch:
                for _ in range(parts):
                    yield from pickle.load(scratch)

        return read()

    def take(self, key: Key) -> Iterator[tuple]:
        """The messages to ``key``, which no later call names a larger one than."""
        top = (-key[0], -key[1], -key[2])
        while self.heap and self.heap[0][:3] == top:
            yield heapq.heappop(self.heap)[4]
        while self.heads and self.heads[0][0][:3] == top:
            head, run = self.heads[0]
            yield head[4]
            following = next(run, None)
            if following is None:
                heapq.heappop(self.heads)
            else:
                heapq.heapreplace(self.heads, (following, run))


_KEY, _PARENT = ["depth", "conv", "side"], ["pdepth", "pconv", "pside"]
_ROW = ["shard", *_KEY, "kind", *_PARENT, "leaves", "x", "y"]


def _nodes_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, Key, bool, Key | None, bool, int, int]]:
    """Shard, key, whether it is a node that others send to, parent, whether that lies elsewhere, and sums, of each node.

    The rows of a node's key lie together: its own row, and one with what comes from outside.
    """
    held = None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in _ROW]
        for shard, d, c, s, kind, pd, pc_, ps, leaves, x, y in zip(*columns, strict=True):
            if kind:
                _, key, _, parent, out, x0, y0 = held  # a node's own row stands first
                held = (shard, key, True, parent, out, x0 + x, y0 + y)
                continue
            if held:
                yield held
            held = (shard, (d, c, s), False, None if pd is None else (pd, pc_, ps), leaves, x, y)
    if held:
        yield held


def _ways(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What leaves the shards: sums to nodes of others, and the ways out of nodes that others send to.

    A way is named by the node it begins at. Where ways meet, the least goes on and the
    others join it, so that a message holds one way at most.
    """
    made, names = [], ["what", *_KEY, *_PARENT, "x", "y"]
    queue, at = SpillingQueue(), None
    for shard, key, sent_to, parent, leaves, x, y in _nodes_of(batches):
        if shard != at:
            queue, at = SpillingQueue(), shard
        ways = {key} if sent_to else set()
        for dx, dy, way in queue.take(key):
            x, y = x + dx, y + dy
            if way:
                ways.add(way)
        way = min(ways, default=None)
        made += [("way", *other, *way, 0, 0) for other in ways if other != way]
        if parent is None or leaves:
            if way:
                made.append(("out", *way, *(parent or (None, None, None)), 0, 0))
            if parent:
                made.append(("sum", *key, *parent, x, y))
        else:
            queue.put(parent, (x, y, way))
        if len(made) >= BATCH:
            yield _ways_batch(made, names)
            made = []
    if made:
        yield _ways_batch(made, names)


def _ways_batch(made: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*made, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(columns[0]), *(pa.array(c, pa.int64()) for c in columns[1:])], names)


def _totals(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of every node's subtree, given what comes from other shards."""
    made = []
    queue, at = SpillingQueue(), None
    for shard, key, _, parent, leaves, x, y in _nodes_of(batches):
        if shard != at:
            queue, at = SpillingQueue(), shard
        for dx, dy in queue.take(key):
            x, y = x + dx, y + dy
        made.append((*key, x, y))
        if parent and not leaves:
            queue.put(parent, (x, y))
        if len(made) >= BATCH:
            yield _batch(made, [*_KEY, "x", "y"])
            made = []
    if made:
        yield _batch(made, [*_KEY, "x", "y"])


def _shard(depth: str, conv: str, shards: int, near: int) -> Column:
    """The shard of a node: those of near conversations, some ``LEVELS`` at a time, lie together."""
    return F.pmod(F.xxhash64(F.expr(f"{conv} div {near}"), F.expr(f"{depth} div {LEVELS}")), F.lit(shards))


def _by_shard(nodes: DataFrame, others: DataFrame, tasks: int) -> DataFrame:
    rows = nodes.select(*_ROW).unionByName(others.select(*_ROW))
    order = ["shard", F.desc("depth"), F.desc("conv"), F.desc("side"), "kind"]
    return rows.repartition(tasks, "shard").sortWithinPartitions(*order)


def subtree_sums(nodes: DataFrame, shards: int, near: int = NEAR) -> DataFrame:
    """``x`` and ``y`` summed over the subtree of each node of a forest, by ``depth``, ``conv``, ``side``.

    ``nodes`` names each node by these three and its parent by ``pdepth``, ``pconv``,
    ``pside`` (null: a root); a parent's name is smaller than its child's. Each shard
    is summed in one task with bounded memory. A node that takes sums from other shards
    becomes two nodes of the forest between shards: what comes in, and the way on from it.
    """
    tasks = max(1, min(shards, int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    mine, theirs = _shard("depth", "conv", shards, near), _shard("pdepth", "pconv", shards, near)
    nodes = nodes.select(
        mine.alias("shard"), *_KEY, F.lit(0).alias("kind"), *_PARENT,
        (F.col("pdepth").isNotNull() & (mine != theirs)).alias("leaves"), "x", "y",
    )
    none, nothing = F.lit(None).cast("bigint"), F.lit(0).cast("bigint")

    def from_outside(rows: DataFrame) -> DataFrame:
        return rows.select(
            mine.alias("shard"), *_KEY, F.lit(1).alias("kind"), *[none.alias(c) for c in _PARENT],
            F.lit(False).alias("leaves"), "x", "y",
        )

    sums = "depth bigint, conv bigint, side bigint, x bigint, y bigint"
    if shards == 1:
        return _by_shard(nodes, from_outside(nodes).where("false"), 1).mapInArrow(_totals, sums)
    sent_to = nodes.where("leaves").select(*[F.col(p).alias(k) for p, k in zip(_PARENT, _KEY, strict=True)]).distinct()
    flagged = from_outside(sent_to.select("*", nothing.alias("x"), nothing.alias("y")))
    kinds = "what string, depth bigint, conv bigint, side bigint, pdepth bigint, pconv bigint, pside bigint, x bigint, y bigint"
    ways = materialize(_by_shard(nodes, flagged, tasks).mapInArrow(_ways, kinds), "ways")
    coming = ways.where("what = 'sum'").groupBy(*_PARENT).agg(F.sum("x").alias("x"), F.sum("y").alias("y"))
    coming = coming.selectExpr(
        "pdepth AS depth", "pconv AS conv", "2 * pside + 1 AS side", "pdepth", "pconv", "2 * pside AS pside", "x", "y"
    )
    on = ways.where("what <> 'sum'").selectExpr(
        "depth", "conv", "2 * side AS side", "pdepth", "pconv",
        "2 * pside + CAST(what = 'out' AS bigint) AS pside", "x", "y",
    )
    between = materialize(coming.unionByName(on), "between-shards")
    further = subtree_sums(between, max(1, shards // FEWER), near)
    came = further.where("side % 2 = 1").withColumn("side", F.expr("side div 2"))
    came = materialize(came, "from-other-shards")
    return _by_shard(nodes, from_outside(came), tasks).mapInArrow(_totals, sums)


# --- the trie -----------------------------------------------------------------------------------


def prefix_trie(conversations: DataFrame, shards: int | None = None) -> DataFrame:
    """One row per node of the trie of rebuilt conversations (``rebuilt``), the textless root included.

    ``conv_id`` the smallest member, ``depth``, ``parent_conv_id`` (null at the root),
    ``n_convs`` members, ``n_children``, ``n_leaves`` childless nodes of the subtree,
    ``saved_tokens``, summed over the subtree (n_convs - 1) times the words of a node's
    last text, ``ends_sha256`` of the ids that end at the node.

    A null role or text is empty, a null turn comes first, a repeated row is a further
    turn, rows without ``conv_id`` are not part of any conversation, an empty table gives
    no rows, and columns other than ``conv_id``, ``turn``, ``role`` and ``text`` are not read.
    """
    spark = conversations.sparkSession
    rows = materialize(_named(rebuilt(conversations)), "named-prefixes")
    name = ["depth", "p", "q"]
    nodes = rows.groupBy(*name).agg(
        F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.min("w").alias("w"), F.min("f").alias("f"), F.min("g").alias("g")
    )
    nodes = materialize(
        nodes.select(
            *name, "conv", "n_convs", "w", (F.col("depth") - 1).alias("d0"),
            F.col("p").bitwiseXOR(F.col("f")).alias("p0"), F.col("q").bitwiseXOR(F.col("g")).alias("q0"),
        ),
        "trie-nodes",
    )
    above = [F.col(n).alias(f"{n[0]}0") for n in name]
    # counts, ids of parents and ends meet on the node's name, each from a table of its own: no join is wider than its node
    children = materialize(nodes.where("depth > 0").groupBy("d0", "p0", "q0").agg(F.count("*").alias("n_children")), "children")
    parents = materialize(nodes.select(*above, F.col("conv").alias("pconv")), "parents")
    ends = materialize(_ends(rows), "trie-ends")
    zero = F.lit(0).cast("bigint")
    linked = nodes.join(parents, ["d0", "p0", "q0"], "left").select(*name, "conv", "n_convs", "w", "pconv")
    counted = linked.join(children.select(*[F.col(f"{n[0]}0").alias(n) for n in name], "n_children"), name, "left")
    counted = materialize(
        counted.join(ends, name, "left").select(
            "conv", "depth", "pconv", "n_convs", F.coalesce("n_children", zero).alias("n_children"), "w",
            F.coalesce("ends", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
        ),
        "linked-nodes",
    )
    some = F.col("pconv").isNotNull()
    own = counted.select(
        "depth", "conv", zero.alias("side"), F.when(some, F.col("depth") - 1).alias("pdepth"), "pconv",
        F.when(some, zero).alias("pside"), (F.col("n_children") == 0).cast("bigint").alias("x"),
        ((F.col("n_convs") - 1) * F.col("w")).alias("y"),
    )
    if shards is None:
        shards = SHARDS * max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    totals = materialize(subtree_sums(own, shards), "subtree-sums").select("depth", "conv", "x", "y")
    return counted.join(totals, ["depth", "conv"]).select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.col("pconv").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        F.col("x").alias("n_leaves"),
        F.col("y").alias("saved_tokens"),
        "ends_sha256",
    )
