"""Several concepts asked of each text in one pass, in batches, and only where not known yet."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardframe.fixed_values import (
    LABELLER_ERROR,
    NO,
    NO_ANSWER,
    NO_RADIOLOGY,
    NULL_IF_EMPTY,
    PROMPTS,
    TEXT_SOURCES,
    YES,
)
from wardframe.functions.texts import overlapping_chunks, says_yes, stripped
from wardframe.operators.labelling import Labeller
from wardframe.sources.label_table import LabelTable
from wardframe.sources.sinks import append_labels, existing_labels

#: Answers a list of prompts with a list as long; an exception in a place is that prompt's failure.
BatchLabeller = Callable[[list[str]], Sequence["str | Exception"]]

#: Characters of the prompts that a task builds before it asks them.
PROMPT_CHARACTERS = 2_000_000

LABELS = "concept string, text_length int, detected string, explanation string"


def one_by_one(make_labeller: Callable[[], Labeller]) -> Callable[[], BatchLabeller]:
    """A batched labeller out of one that answers a single prompt."""

    def make() -> BatchLabeller:
        labeller = make_labeller()

        def answer(prompts: list[str]) -> list[str | Exception]:
            answers: list[str | Exception] = []
            for prompt in prompts:
                try:
                    answers.append(labeller(prompt))
                except Exception as error:  # noqa: BLE001 - a failed call is that prompt's answer
                    answers.append(error)
            return answers

        return answer

    return make


def _lists(
    rows: Iterable[tuple[str | None, Iterable[str]]], templates: Mapping[str, Sequence[str]]
) -> Iterator[tuple[list[tuple[int, str]], list[str]]]:
    """The prompts of the rows, with their row and concept, in lists of some ``PROMPT_CHARACTERS``."""
    places, prompts, held = [], [], 0
    for row, (chunk, concepts) in enumerate(rows):
        for concept in concepts if chunk is not None else ():
            places.append((row, concept))
            prompts.append(chunk.join(templates[concept]))
            held += len(prompts[-1])
        if held >= PROMPT_CHARACTERS:
            yield places, prompts
            places, prompts, held = [], [], 0
    if prompts:
        yield places, prompts


def _ask(spread: DataFrame, make_labeller: Callable[[], BatchLabeller]) -> Column:
    templates = {c: p.split("{text}") for c, p in PROMPTS.items()}

    @F.pandas_udf("array<struct<concept:string,answer:string,failed:boolean>>")
    def answers(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        labeller = make_labeller()
        for chunks, wanted in batches:
            rows: list[list[dict]] = [[] for _ in range(len(chunks))]
            for places, prompts in _lists(zip(chunks, wanted, strict=True), templates):
                try:
                    found = list(labeller(prompts))
                except Exception as error:  # noqa: BLE001 - the whole call failed
                    found = [error] * len(prompts)
                for (row, concept), answer in zip(places, found, strict=True):
                    failed = isinstance(answer, Exception)
                    text = f"{LABELLER_ERROR}{answer}" if failed else answer
                    rows[row].append({"concept": concept, "answer": text, "failed": failed})
            yield pd.Series(rows)

    return answers("chunk", "todo")


def label_many(
    df: DataFrame,
    key: str,
    text: str,
    make_labeller: Callable[[], BatchLabeller],
    concepts: Sequence[str] | None = None,
    null_if_empty: Sequence[str] = NULL_IF_EMPTY,
) -> DataFrame:
    """Label a text column for several concepts: ``key``, ``concept``, length, label, explanation, ``failed``.

    ``concepts`` are asked of every row; without them, those that the row's
    array ``todo`` names. ``key`` is unique. Chunks are spread once, by key and
    position, with the names of the concepts; prompts are built where they are
    asked, so a text crosses the network once however many concepts there are.
    ``failed`` tells that some call failed, which reads as no.
    """
    todo = F.array(*map(F.lit, concepts)) if concepts is not None else F.col("todo")
    chunks = df.select(
        key,
        F.coalesce(F.length(text), F.lit(0)).alias("text_length"),
        todo.alias("todo"),
        F.posexplode_outer(overlapping_chunks(F.col(text))).alias("chunk_no", "chunk"),
    )
    spread = chunks.repartition(F.col(key), F.col("chunk_no"))
    asked = spread.withColumn("answers", _ask(spread, make_labeller)).select(
        key, "text_length", "chunk_no", F.explode("todo").alias("concept"), "answers"
    )
    mine = F.get(F.filter("answers", lambda a: a["concept"] == F.col("concept")), F.lit(0))
    rows = asked.select(key, "concept", "text_length", "chunk_no", mine.alias("got")).select(
        key, "concept", "text_length", "chunk_no", stripped(F.col("got.answer")).alias("answer"), F.col("got.failed").alias("failed")
    )
    row = F.struct("chunk_no", "answer")
    reduced = rows.groupBy(key, "concept").agg(
        F.max("text_length").alias("text_length"),
        F.min(F.when(says_yes(F.col("answer")), row)).alias("yes"),
        F.min(F.when(F.col("answer").isNotNull(), row)).alias("first"),
        F.coalesce(F.max("failed"), F.lit(False)).alias("failed"),
    )
    unknown = F.col("concept").isin(list(null_if_empty)) & (F.col("text_length") == 0)
    return reduced.select(
        key,
        "concept",
        "text_length",
        F.when(~unknown, F.when(F.col("yes").isNotNull(), YES).otherwise(NO)).alias("detected"),
        F.when(unknown, NO_RADIOLOGY)
        .otherwise(F.coalesce("yes.answer", "first.answer", F.lit(NO_ANSWER)))
        .alias("explanation"),
        "failed",
    )


def _table(spark: SparkSession, path: str, key: str, kind: str, fmt: str) -> DataFrame | None:
    return existing_labels(spark, path, spark.createDataFrame([], f"{key} {kind}, {LABELS}"), fmt)


def label_new(
    df: DataFrame,
    key: str,
    concepts: Sequence[str],
    make_labeller: Callable[[], BatchLabeller],
    path: str,
    parts: int = 1,
    sources: Mapping[str, Sequence[str]] = TEXT_SOURCES,
    fmt: str = "parquet",
) -> None:
    """Ask about the texts and concepts that the table at ``path`` does not hold, and append the labels.

    What is known is taken out before texts are cut, so a repeated run asks
    nothing. A label that rests on a failed call is not stored and is asked
    for again next time. Keys are split by hash into ``parts`` that are
    committed one after the other: a run that breaks off loses one part. Each
    concept reads its first text source. ``key`` is unique.
    """
    spark = df.sparkSession
    kind = df.schema[key].dataType.simpleString()
    by_text: dict[str, list[str]] = {}
    for concept in concepts:
        by_text.setdefault(sources[concept][0], []).append(concept)
    for part in range(parts):
        own = df.where(F.pmod(F.xxhash64(key), F.lit(parts)) == part)
        for text, wanted in by_text.items():
            known = _table(spark, path, key, kind, fmt)
            todo = own.select(key, text).withColumn("todo", F.array(*map(F.lit, wanted)))
            if known is not None:
                have = (
                    known.where(F.col("concept").isin(wanted))
                    .groupBy(key)
                    .agg(F.collect_set("concept").alias("have"))  # as many as there are concepts, at most
                )
                left = F.array_except("todo", F.coalesce("have", F.array().cast("array<string>")))
                todo = todo.join(have, key, "left").withColumn("todo", left).drop("have")
            todo = todo.where(F.size("todo") > 0)
            labels = label_many(todo, key, text, make_labeller).where(~F.col("failed")).drop("failed")
            append_labels(labels, path, [key, "concept"], fmt)


def label_into(
    df: DataFrame,
    key: str,
    concepts: Sequence[str],
    make_labeller: Callable[[], BatchLabeller],
    table: LabelTable,
    batch: str,
    sources: Mapping[str, Sequence[str]] = TEXT_SOURCES,
) -> None:
    """``label_new`` into a ``LabelTable``: each text source is one batch, whole or not there.

    What the table holds is found by key where it lies, so that a run shuffles the texts'
    keys and lengths of what is new and no label. A batch that broke off is repeated under
    its name; what it had committed is not asked again.
    """
    by_text: dict[str, list[str]] = {}
    for concept in concepts:
        by_text.setdefault(sources[concept][0], []).append(concept)
    for text, wanted in by_text.items():
        todo = still_to_ask(df.select(key, text), wanted, table)
        labels = label_many(todo, key, text, make_labeller).where(~F.col("failed")).drop("failed")
        table.append(labels, f"{batch}/{text}")


def still_to_ask(texts: DataFrame, concepts: Sequence[str], table: LabelTable) -> DataFrame:
    """``texts`` with ``todo``, the concepts that the table lacks for them; without those it lacks none for."""
    todo = F.array_except(F.array(*map(F.lit, concepts)), F.col("known"))
    marked = table.with_known(texts).withColumn("todo", todo).drop("known")
    return marked.where(F.size("todo") > 0)
