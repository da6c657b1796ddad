"""Labels from as few calls as the answers allow: chunks are asked in waves of growing size."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardframe.functions.texts import says_yes
from wardframe.operators.labelling import Labeller, _completed, _length, ask, chunk_rows, with_prompt
from wardframe.session import materialize, shared_folder


def wave(chunk_no: Column) -> Column:
    """The wave of a chunk: 0 the first one, 1 the next two, 2 the next four, and so on."""
    return F.length(F.bin(chunk_no.cast("bigint") + 1)) - 1


def label_in_waves(
    df: DataFrame,
    key: str,
    text: str,
    concept: str,
    make_labeller: Callable[[], Labeller],
    null_if_empty: bool = False,
) -> DataFrame:
    """``label_text`` that stops asking about a text after the wave of its first yes; with ``n_calls``.

    Label and explanation are the same, since the first yes by position lies in the first
    wave that has one, and the first answer in the first wave. A text of n chunks takes part
    in some log2(n) waves and is asked at most as many further chunks as it has been asked.

    Texts are cut once; the chunks are written by wave, so that a wave reads its own
    only, and the answers of each wave are written, so that no call is made again. What
    the waves pass on are the keys with a yes. ``key`` is unique; a text without chunks
    is not asked.
    """
    spark = df.sparkSession
    chunks = chunk_rows(df, key, text).withColumn("wave", wave(F.col("chunk_no")))
    path = f"{shared_folder(spark)}/chunk-waves-{uuid.uuid4().hex}"
    chunks.write.partitionBy("wave").parquet(path)
    written = spark.read.schema(chunks.schema).parquet(path)
    last = written.agg(F.max("wave")).first()[0]
    none = chunks.select(key, "chunk_no", F.lit("").alias("answer")).where("false")
    answers: list[DataFrame] = []
    for number in range(0 if last is None else last + 1):
        own = written.where(F.col("wave") == number).drop("wave")
        if answers:
            yes = reduce(DataFrame.unionByName, answers).where(says_yes(F.col("answer")))
            own = own.join(yes.select(key).distinct(), key, "left_anti")
        asked = ask(with_prompt(own, concept), make_labeller, key)
        answers.append(materialize(asked.select(key, "chunk_no", "answer"), "wave-answers"))
    row = F.struct("chunk_no", "answer")
    reduced = (
        reduce(DataFrame.unionByName, answers, none)
        .groupBy(key)
        .agg(
            F.min(F.when(says_yes(F.col("answer")), row)).alias("yes"),
            F.min(F.when(F.col("answer").isNotNull(), row)).alias("first"),
            F.count("*").alias("n_calls"),
        )
    )
    found = df.select(key, _length(text).alias("text_length")).join(reduced, key, "left")
    return found.select(
        key,
        "text_length",
        *_completed(F.col("yes").isNotNull(), F.col("yes.answer"), F.col("first.answer"), null_if_empty),
        F.coalesce("n_calls", F.lit(0).cast("bigint")).alias("n_calls"),
    )
