"""Byte-level BPE in DuckDB queries that run inside each task.

A piece (one match of the pattern) becomes rows of (piece, position, token). A
recursive query joins neighbours to the merge table and contracts the leftmost
pair of minimum rank of every piece until none is left. Decoding joins ids to
their bytes and puts them together by an aggregate ordered by position.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardframe.llm.texts import slices

#: Text that is cut into pieces at a time.
SLICE_BYTES = 2 << 20
#: Pieces of a long text that are held at a time.
LONG_PIECES = 200_000
#: Longer pieces contract all their pairs of minimum rank at once.
LONG_BYTES = 64
#: Pieces per query, and rows that a recursive query may gather.
QUERY_PIECES, QUERY_ROWS = 40_000, 3_000_000
#: Pieces whose ids a worker remembers; when there are more, those met once since the last time go.
REMEMBERED = 600_000

_CONTRACT = """
WITH RECURSIVE step(piece, pos, token, done) AS (
  SELECT piece, pos, token, FALSE FROM start
  UNION ALL (
    WITH pairs AS (
      SELECT piece, pos, token, lead(token) OVER w AS right_token, lead(pos) OVER w AS right_pos
      FROM step WHERE NOT done WINDOW w AS (PARTITION BY piece ORDER BY pos)),
    best AS (
      SELECT p.piece, min((m.id::BIGINT << 32) | p.pos) AS least,
             arg_min(p.right_pos, (m.id::BIGINT << 32) | p.pos) AS gone
      FROM pairs p JOIN merges m ON m.pair = (p.token::BIGINT << 32) | p.right_token
      GROUP BY p.piece)
    SELECT s.piece, s.pos, CASE WHEN s.pos = (b.least & 4294967295) THEN (b.least >> 32)::INTEGER ELSE s.token END,
           b.least IS NULL
    FROM step s LEFT JOIN best b ON s.piece = b.piece
    WHERE NOT s.done AND (b.least IS NULL OR s.pos <> b.gone)))
SELECT piece, string_agg(token::VARCHAR, ' ' ORDER BY pos) FROM step WHERE done GROUP BY piece
"""

# The pairs of minimum rank of a piece never touch each other but where a token
# repeats; of such a run every other pair, from the left, is contracted.
_CONTRACT_LONG = """
WITH RECURSIVE step(piece, pos, token, done, depth) AS (
  SELECT piece, pos, token, FALSE, 0 FROM start
  UNION ALL (
    WITH pairs AS (
      SELECT piece, pos, token, lead(token) OVER w AS right_token, lead(pos) OVER w AS right_pos,
             row_number() OVER w AS place
      FROM step WHERE NOT done AND depth < $depth WINDOW w AS (PARTITION BY piece ORDER BY pos)),
    ranked AS (
      SELECT p.piece, p.pos, p.right_pos, p.place, m.id, min(m.id) OVER (PARTITION BY p.piece) AS least
      FROM pairs p JOIN merges m ON m.pair = (p.token::BIGINT << 32) | p.right_token),
    runs AS (
      SELECT *, place - row_number() OVER (PARTITION BY piece ORDER BY place) AS run FROM ranked WHERE id = least),
    chosen AS (
      SELECT piece, pos, right_pos, id FROM
        (SELECT *, row_number() OVER (PARTITION BY piece, run ORDER BY place) AS nth FROM runs) WHERE nth % 2 = 1)
    SELECT s.piece, s.pos, coalesce(c.id, s.token), a.piece IS NULL, s.depth + 1
    FROM step s
    LEFT JOIN chosen c ON s.piece = c.piece AND s.pos = c.pos
    LEFT JOIN chosen g ON s.piece = g.piece AND s.pos = g.right_pos
    LEFT JOIN (SELECT DISTINCT piece FROM chosen) a ON s.piece = a.piece
    WHERE NOT s.done AND s.depth < $depth AND g.piece IS NULL))
SELECT piece, pos, token, done FROM step WHERE done OR depth = $depth
"""

_DECODE = """
SELECT r.item, string_agg(v.hex, '' ORDER BY r.pos) FROM rows r JOIN vocabulary v ON r.id = v.id GROUP BY r.item
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of base64 and rank in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Codec:
    """Encodes and decodes texts; made on the driver, used in tasks through a broadcast.

    A broadcast value lives as long as its Python worker, so the merge table is
    loaded once per worker, and what is remembered serves later tasks.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks, self.pattern = ranks, pattern
        self._connection = None

    def __getstate__(self) -> dict:
        return {"ranks": self.ranks, "pattern": self.pattern, "_connection": None}

    def _open(self) -> None:
        import duckdb
        import numpy as np
        import regex

        self._pieces = regex.compile(self.pattern)
        self._ids: dict[str, str] = {}
        self._texts: dict[str, str | bytes] = {}
        self._again: set[str] = set()
        self._bytes = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self._connection = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})
        pairs, ids = [], []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs.append((left << 32) | right)
                    ids.append(rank)
        for name, rows in (
            ("merges", pa.table({"pair": pa.array(pairs, pa.int64()), "id": pa.array(ids, pa.int32())})),
            (
                "vocabulary",
                pa.table(
                    {
                        "id": pa.array(self.ranks.values(), pa.int32()),
                        "hex": pa.array([t.hex() for t in self.ranks], pa.string()),
                    }
                ),
            ),
        ):
            self._connection.register("loaded", rows)
            self._connection.execute(f"CREATE TABLE {name} AS SELECT * FROM loaded")
            self._connection.unregister("loaded")

    def _rows(self, pieces: list[bytes]) -> pa.Table:
        import numpy as np

        lengths = np.array([len(p) for p in pieces], dtype=np.int64)
        starts = np.cumsum(lengths) - lengths
        return pa.table(
            {
                "piece": np.repeat(np.arange(len(pieces), dtype=np.int32), lengths),
                "pos": (np.arange(lengths.sum()) - np.repeat(starts, lengths)).astype(np.int32),
                "token": self._bytes[np.frombuffer(b"".join(pieces), dtype=np.uint8)],
            }
        )

    def _contract(self, pieces: list[bytes]) -> dict[int, str]:
        self._connection.register("start", self._rows(pieces))
        return dict(self._connection.execute(_CONTRACT).fetchall())

    def _contract_long(self, piece: bytes) -> str:
        rows = self._rows([piece])
        while True:
            self._connection.register("start", rows)
            depth = max(1, QUERY_ROWS // rows.num_rows)
            found = self._connection.execute(_CONTRACT_LONG, {"depth": min(depth, 64)}).fetchnumpy()
            rows = pa.table({n: found[n] for n in ("piece", "pos", "token")}).sort_by("pos")
            if found["done"][0]:
                return " ".join(map(str, rows.column("token").to_pylist()))

    def _learn(self, pieces: Iterable[str]) -> None:
        """Encode pieces not met yet, and decode the ids that came out."""
        new, short, long = {}, [], []
        for piece in pieces:
            data = piece.encode()
            rank = self.ranks.get(data)
            if rank is not None:
                new[piece] = str(rank)
            else:
                (long if len(data) > LONG_BYTES else short).append((piece, data))
        for at in range(0, len(short), QUERY_PIECES):
            part = short[at : at + QUERY_PIECES]
            for i, ids in self._contract([data for _, data in part]).items():
                new[part[i][0]] = ids
        for piece, data in long:
            new[piece] = self._contract_long(data)
        self._ids.update(new)
        unread = [ids for ids in dict.fromkeys(new.values()) if ids not in self._texts]
        if unread:
            self._texts.update(zip(unread, map(_text_or_bytes, self.decoded(unread)), strict=True))

    def decoded(self, sequences: list[str]) -> list[bytes]:
        """The bytes of each sequence of blank-separated ids."""
        import numpy as np

        if self._connection is None:
            self._open()
        out = []
        for part in _parts(sequences):
            counts = np.array([s.count(" ") + 1 if s else 0 for s in part], dtype=np.int64)
            ids = np.array(" ".join(s for s in part if s).split(), dtype=np.int64)
            self._connection.register(
                "rows",
                pa.table(
                    {
                        "item": np.repeat(np.arange(len(part), dtype=np.int32), counts),
                        "pos": np.arange(len(ids), dtype=np.int64),
                        "id": ids,
                    }
                ),
            )
            found = dict(self._connection.execute(_DECODE).fetchall())
            out += [bytes.fromhex(found.get(i, "")) for i in range(len(part))]
        return out

    def _grouped(self, text: str) -> Iterator[list[str]]:
        if len(text) <= SLICE_BYTES:
            yield self._pieces.findall(text)
            return
        matches = (m.group() for m in self._pieces.finditer(text))
        while held := list(islice(matches, LONG_PIECES)):
            yield held

    def encoded(self, texts: list[str | None]) -> Iterator[tuple[list[str], list[str | bytes]] | None]:
        """Of each text in turn: ids and decoded texts of its pieces, in parts, then None."""
        if self._connection is None:
            self._open()
        if sum(len(t) for t in texts if t) > 2 * SLICE_BYTES:  # a long text stands alone
            for text in texts:
                for pieces in self._grouped(text or ""):
                    self._meet(set(pieces))
                    yield self._looked_up(pieces)
                yield None
            return
        split = [self._pieces.findall(t) if t else [] for t in texts]
        self._meet(set().union(*split))
        for pieces in split:
            yield self._looked_up(pieces)
            yield None

    def _meet(self, pieces: set[str]) -> None:
        """Have the ids of all ``pieces`` at hand; what else is remembered stays bounded."""
        if len(self._ids) > REMEMBERED:
            kept = self._again if 4 * len(self._again) <= 3 * REMEMBERED else set(islice(self._again, REMEMBERED // 2))
            self._ids = {p: ids for p, ids in self._ids.items() if p in kept}
            self._texts = {ids: self._texts[ids] for ids in self._ids.values()}
            self._again = set()
        new = pieces.difference(self._ids)
        self._again |= pieces - new
        if new:
            self._learn(new)

    def _looked_up(self, pieces: list[str]) -> tuple[list[str], list[str | bytes]]:
        ids = [self._ids[p] for p in pieces]
        return ids, [self._texts[i] for i in ids]


def _text_or_bytes(data: bytes) -> str | bytes:
    try:
        return data.decode()
    except UnicodeDecodeError:
        return data


def _parts(sequences: list[str], most: int = 1 << 20) -> Iterator[list[str]]:
    """Lists of sequences with about ``most`` characters together."""
    held, size = [], 0
    for s in sequences:
        held.append(s)
        size += len(s)
        if size > most:
            yield held
            held, size = [], 0
    if held:
        yield held


def _joined(parts: list[str | bytes]) -> bytes:
    try:
        return "".join(parts).encode()
    except TypeError:
        return b"".join(p if isinstance(p, bytes) else p.encode() for p in parts)


def encode(docs: DataFrame, codec: Codec, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Token ids of every whole text: ``id_column`` and ``token_ids`` (array of int).

    A null text is empty and has no ids. Rows repeat as they come; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(codec)  # bounded by the vocabulary

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "t", SLICE_BYTES):
            rows, held = [], []
            for part in shared.value.encoded(batch.column("t").to_pylist()):
                if part:
                    held.append(" ".join(part[0]))
                else:
                    rows.append([int(i) for i in " ".join(held).split()])
                    held = []
            yield pa.RecordBatch.from_arrays([batch.column("k"), pa.array(rows, pa.list_(pa.int32()))], ["k", "ids"])

    keyed = docs.select(F.col(id_column).alias("k"), F.col(text_column).cast("string").alias("t"))
    kind = keyed.schema["k"].dataType.simpleString()
    return keyed.mapInArrow(run, f"k {kind}, ids array<int>").toDF(id_column, "token_ids")


def decode(rows: DataFrame, codec: Codec, id_column: str = "doc_id", ids_column: str = "token_ids") -> DataFrame:
    """The bytes that token ids stand for: ``id_column`` and ``data``; null or no ids give none."""
    shared = rows.sparkSession.sparkContext.broadcast(codec)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [" ".join(map(str, x or [])) for x in batch.column("ids").to_pylist()]
            data = pa.array(shared.value.decoded(ids), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("k"), data], ["k", "data"])

    keyed = rows.select(F.col(id_column).alias("k"), F.col(ids_column).alias("ids"))
    kind = keyed.schema["k"].dataType.simpleString()
    return keyed.mapInArrow(run, f"k {kind}, data binary").toDF(id_column, "data")


def round_trip(docs: DataFrame, codec: Codec, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Encode every whole text and decode its ids again, keeping digests only.

    ``n_tokens``; ``ids_sha256`` of the decimal ids joined by blanks;
    ``decoded_sha256`` of the decoded bytes. A null text is empty. A task holds
    one slice of texts; a text longer than that is worked through in parts.
    """
    shared = docs.sparkSession.sparkContext.broadcast(codec)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "t", SLICE_BYTES):
            counts, of_ids, of_texts = [], [], []
            n, a, b = 0, hashlib.sha256(), hashlib.sha256()
            for part in shared.value.encoded(batch.column("t").to_pylist()):
                if part and part[0]:
                    line = " ".join(part[0])
                    a.update(b" " + line.encode() if n else line.encode())
                    b.update(_joined(part[1]))
                    n += line.count(" ") + 1
                elif not part:
                    counts.append(n)
                    of_ids.append(a.hexdigest())
                    of_texts.append(b.hexdigest())
                    n, a, b = 0, hashlib.sha256(), hashlib.sha256()
            yield pa.RecordBatch.from_arrays(
                [batch.column("k"), pa.array(counts, pa.int64()), pa.array(of_ids), pa.array(of_texts)],
                ["k", "n", "a", "b"],
            )

    keyed = docs.select(F.col(id_column).alias("k"), F.col(text_column).cast("string").alias("t"))
    kind = keyed.schema["k"].dataType.simpleString()
    return keyed.mapInArrow(run, f"k {kind}, n bigint, a string, b string").toDF(
        id_column, "n_tokens", "ids_sha256", "decoded_sha256"
    )
