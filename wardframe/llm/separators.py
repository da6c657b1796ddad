"""Token counts read off flat token files by the places of their separators.

A token file is a run of little-endian 16-bit ids, each document closed by the
end-of-document id, with no index beside it. Files are read in blocks by many
tasks; a prefix scan over one small row per block joins what blocks cut apart.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardframe.llm.texts import slices
from wardframe.session import materialize, shared_folder

ITEM_BYTES = 2
#: Bytes of a block; a multiple of ITEM_BYTES.
BLOCK_BYTES = 8 << 20
SLICE_BYTES = 2 << 20


class Tokenizer:
    """A byte-level BPE of the tiktoken library, built once per Python worker from its ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks, self.pattern, self._made = ranks, pattern, None

    def __getstate__(self) -> dict:
        return {"ranks": self.ranks, "pattern": self.pattern, "_made": None}

    def encode(self, text: str) -> list[int]:
        if self._made is None:
            import tiktoken

            self._made = tiktoken.Encoding(
                "ranks", pat_str=self.pattern, mergeable_ranks=self.ranks, special_tokens={}
            )
        return self._made.encode_ordinary(text)


def write_token_files(
    docs: DataFrame, tokenizer: Tokenizer, end_id: int, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Write one token file per task into the shared folder: ``id``, ``file``, ``ordinal`` of each document.

    A null text is empty. A retried task writes a file of another name; only
    files named in the returned rows, written by one committed attempt each, count.
    """
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
    shared = spark.sparkContext.broadcast(tokenizer)  # bounded by the vocabulary

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from pyarrow import fs

        out = name = None
        ordinal = 0
        for batch in slices(batches, "t", SLICE_BYTES):
            if out is None and batch.num_rows:
                store, path = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
                store.create_dir(path, recursive=True)
                name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.bin"
                out = store.open_output_stream(f"{path}/{name}")
            for text in batch.column("t").to_pylist():
                ids = shared.value.encode(text or "")
                ids.append(end_id)
                out.write(np.array(ids, dtype="<u2").tobytes())
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column("k"), pa.array([name] * n, pa.string()), pa.array(range(ordinal, ordinal + n), pa.int64())],
                ["id", "file", "ordinal"],
            )
            ordinal += n
        if out is not None:
            out.close()

    keyed = docs.select(F.col(id_column).alias("k"), F.col(text_column).cast("string").alias("t"))
    kind = keyed.schema["k"].dataType.simpleString()
    rows = materialize(keyed.mapInArrow(run, f"id {kind}, file string, ordinal bigint"), "token-manifest")
    return rows.withColumn("file", F.concat(F.lit(folder + "/"), "file"))


def count_tokens(files: DataFrame, end_id: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Tokens of each document in ``files`` (``file``): ``file``, ``ordinal``, ``n_tokens``, ``terminated``.

    ``ordinal`` counts a file's documents from 0. The separator itself is no
    token of the document. What follows the last separator is a document of its
    own, not ``terminated``, unless nothing follows. Empty files have none.
    """

    def sizes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            names = batch.column("file").to_pylist()
            found = []
            for name in names:
                store, path = fs.FileSystem.from_uri(name if "://" in name else f"file://{name}")
                found.append(store.get_file_info(path).size or 0)
            yield pa.RecordBatch.from_arrays([batch.column("file"), pa.array(found, pa.int64())], ["file", "bytes"])

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from pyarrow import fs

        for batch in batches:
            rows = []
            for name, block in zip(batch.column("file").to_pylist(), batch.column("block").to_pylist(), strict=True):
                store, path = fs.FileSystem.from_uri(name if "://" in name else f"file://{name}")
                with store.open_input_file(path) as source:
                    source.seek(block * block_bytes)
                    ids = np.frombuffer(source.read(block_bytes), dtype="<u2")
                ends = np.flatnonzero(ids == end_id)
                rows.append(
                    {
                        "file": name,
                        "block": block,
                        "n": len(ids),
                        "ends": len(ends),
                        "head": int(ends[0]) if len(ends) else len(ids),
                        "tail": len(ids) - 1 - int(ends[-1]) if len(ends) else len(ids),
                        "inner": np.diff(ends) - 1 if len(ends) else [],
                    }
                )
            yield pa.RecordBatch.from_pylist(rows, _BLOCK)

    blocks = (
        files.select("file")
        .distinct()
        .mapInArrow(sizes, "file string, bytes bigint")
        .where("bytes > 0")
        .select("file", F.explode(F.expr(f"sequence(0L, (bytes - 1) div {block_bytes}L)")).alias("block"))
    )
    n = max(1, int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    scanned = materialize(
        blocks.repartition(n, "file", "block").mapInArrow(
            scan, "file string, block bigint, n bigint, ends bigint, head bigint, tail bigint, inner array<bigint>"
        ),
        "token-blocks",
    )
    # one row of a few numbers per block; a file of a terabyte has some 10^5 of them
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last = Window.partitionBy("file").orderBy(F.col("block").desc())
    read = F.coalesce(F.sum("n").over(before), F.lit(0))
    edges = (
        scanned.drop("inner", "head")
        .withColumn("read", read)
        .withColumn("first", F.coalesce(F.sum("ends").over(before), F.lit(0)))
        .withColumn("after_end", F.when(F.col("ends") > 0, F.col("read") + F.col("n") - F.col("tail")))
        .withColumn("open", F.col("read") - F.coalesce(F.max("after_end").over(before), F.lit(0)))
        .withColumn("at_end", F.row_number().over(last) == 1)
        .select("file", "block", "first", "open", "at_end")
    )
    counts = F.concat(
        F.when(F.col("ends") > 0, F.array(F.col("open") + F.col("head"))).otherwise(F.expr("array()").cast("array<bigint>")),
        "inner",
    )
    rest = F.when(F.col("ends") > 0, F.col("tail")).otherwise(F.col("open") + F.col("n"))
    joined = scanned.join(edges, ["file", "block"]).select(
        "file",
        "first",
        F.when(F.col("at_end") & (rest > 0), F.concat(counts, F.array(rest))).otherwise(counts).alias("counts"),
        (F.col("first") + F.col("ends")).alias("ended"),
    )
    return joined.select("file", "first", "ended", F.posexplode("counts").alias("i", "n_tokens")).select(
        "file",
        (F.col("first") + F.col("i")).alias("ordinal"),
        "n_tokens",
        (F.col("first") + F.col("i") < F.col("ended")).alias("terminated"),
    )


_BLOCK = pa.schema(
    [(name, pa.string() if name == "file" else pa.int64()) for name in ("file", "block", "n", "ends", "head", "tail")]
    + [("inner", pa.list_(pa.int64()))]
)


def document_token_counts(
    docs: DataFrame, tokenizer: Tokenizer, end_id: int, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``id_column`` and ``n_tokens`` of each document, through token files of its whole text."""
    manifest = write_token_files(docs, tokenizer, end_id, id_column, text_column)
    counted = count_tokens(manifest, end_id)
    return manifest.join(counted, ["file", "ordinal"]).select(F.col("id").alias(id_column), "n_tokens")
