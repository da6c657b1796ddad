"""Yes/no text concepts: chunk, ask, reduce."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardframe.fixed_values import (
    C_TEXT,
    CHUNK_OVERLAP,
    CHUNK_SIZE,
    LABELLER_ERROR,
    NO,
    NO_ANSWER,
    NO_RADIOLOGY,
    NULL_IF_EMPTY,
    PROMPTS,
    TEXT_SOURCES,
    YES,
)
from wardframe.functions.texts import (
    fill_template,
    keyword_answer,
    overlapping_chunks,
    says_yes,
    stripped,
)
from wardframe.session import materialize

Labeller = Callable[[str], str]


def chunk_rows(
    df: DataFrame, key: str, text: str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP
) -> DataFrame:
    """One row per window of the text; none for an empty or missing text."""
    chunks = overlapping_chunks(F.col(text), size, overlap)
    return df.select(key, F.posexplode(chunks).alias("chunk_no", "chunk"))


def _length(text: str) -> Column:
    return F.coalesce(F.length(text), F.lit(0))


def with_prompt(chunks: DataFrame, concept: str) -> DataFrame:
    return chunks.withColumn("prompt", fill_template(PROMPTS[concept], F.col("chunk")))


def prompt_rows(chunks: DataFrame, concepts: Sequence[str]) -> DataFrame:
    """One row per chunk and concept, from one pass over the chunks."""
    prompts = [
        F.struct(F.lit(c).alias("concept"), fill_template(PROMPTS[c], F.col("chunk")).alias("prompt"))
        for c in concepts
    ]
    return chunks.withColumn("asked", F.explode(F.array(*prompts))).select("*", "asked.*").drop("asked", "chunk")


def _answer(labeller: Labeller, prompt: str | None) -> str | None:
    if prompt is None:
        return None
    try:
        return labeller(prompt)
    except Exception as error:  # noqa: BLE001 - any failure of one call is that chunk's answer
        return f"{LABELLER_ERROR}{error}"


def ask(prompts: DataFrame, make_labeller: Callable[[], Labeller], key: str) -> DataFrame:
    """Answer every prompt with a user-supplied labeller, built once per task.

    Chunks are first spread by key and position, so the chunks of one very
    long text are answered by many tasks, and a retried task sees its rows
    again. A missing prompt is not asked.
    """

    @F.pandas_udf("string")
    def answer(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        labeller = make_labeller()
        for batch in batches:
            yield batch.map(lambda prompt: _answer(labeller, prompt))

    spread = prompts.drop("chunk").repartition(F.col(key), F.col("chunk_no"))
    return spread.withColumn("answer", stripped(answer("prompt"))).drop("prompt")


def _completed(found_yes: Column, first_yes: Column, first: Column, null_if_empty: bool) -> list[Column]:
    """Label and explanation from the chunk answers, or what a text without chunks gets."""
    detected = F.when(found_yes, YES).otherwise(NO)
    explanation = F.coalesce(first_yes, first, F.lit(NO_ANSWER))
    if null_if_empty:
        present = F.col("text_length") > 0
        detected = F.when(present, detected)
        explanation = F.when(present, explanation).otherwise(NO_RADIOLOGY)
    return [detected.alias("detected"), explanation.alias("explanation")]


def reduce_answers(answers: DataFrame, key: str, null_if_empty: bool = False) -> DataFrame:
    """Yes if any chunk says so, with the first such answer or else the first one.

    ``answers`` holds ``text_length`` on every row and a null answer for a text
    without chunks.
    """
    row = F.struct("chunk_no", "answer")
    answered = F.col("answer").isNotNull()
    reduced = answers.groupBy(key).agg(
        F.max("text_length").alias("text_length"),
        F.min(F.when(says_yes(F.col("answer")), row)).alias("yes"),
        F.min(F.when(answered, row)).alias("first"),
    )
    found = F.col("yes").isNotNull()
    return reduced.select(
        key, "text_length", *_completed(found, F.col("yes.answer"), F.col("first.answer"), null_if_empty)
    )


def label_text(
    df: DataFrame,
    key: str,
    text: str,
    concept: str,
    make_labeller: Callable[[], Labeller],
    null_if_empty: bool = False,
) -> DataFrame:
    """Label one text column for one concept with a user-supplied labeller.

    ``key`` is unique. A text without chunks stays as one row without a
    prompt, so the result is complete without a join back.
    """
    chunks = df.select(
        key,
        _length(text).alias("text_length"),
        F.posexplode_outer(overlapping_chunks(F.col(text))).alias("chunk_no", "chunk"),
    )
    return reduce_answers(ask(with_prompt(chunks, concept), make_labeller, key), key, null_if_empty)


def _answers(text: str, keywords: Sequence[str]) -> Column:
    chunks = overlapping_chunks(F.coalesce(F.col(text), F.lit("")))
    return F.transform(chunks, lambda chunk: keyword_answer(chunk, keywords))


def _settled(answers: str, null_if_empty: bool = False) -> list[Column]:
    yes = F.filter(answers, says_yes)
    return _completed(F.size(yes) > 0, F.get(yes, 0), F.get(answers, 0), null_if_empty)


def keyword_label_text(
    df: DataFrame, key: str, text: str, keywords: Sequence[str], null_if_empty: bool = False
) -> DataFrame:
    """The same labels from the built-in keyword labeller, row by row in the scan stage."""
    answered = df.select(key, _length(text).alias("text_length"), _answers(text, keywords).alias("answers"))
    return answered.select(key, "text_length", *_settled("answers", null_if_empty))


def keyword_cascade(df: DataFrame, key: str, texts: Sequence[str], keywords: Sequence[str]) -> DataFrame:
    """The first text's label where it is yes, else the second's, without a join."""
    first, second = texts
    answered = df.select(
        key,
        F.greatest(_length(first), _length(second)).alias("text_length"),
        _answers(first, keywords).alias("first"),
        _answers(second, keywords).alias("second"),
    )
    one, two = _settled("first"), _settled("second")
    settled = one[0] == YES
    return answered.select(
        key,
        "text_length",
        F.when(settled, one[0]).otherwise(two[0]).alias("detected"),
        F.when(settled, one[1]).otherwise(two[1]).alias("explanation"),
    )


def keyword_detections(
    df: DataFrame,
    key: str,
    keywords: Mapping[str, Sequence[str]],
    sources: Mapping[str, Sequence[str]] = TEXT_SOURCES,
    null_if_empty: Sequence[str] = NULL_IF_EMPTY,
) -> DataFrame:
    """One boolean per concept: does any chunk of any of its texts hold a keyword?

    Every text is cut once and tested for all its concepts in the scan stage.
    The concepts of ``null_if_empty`` are unknown where there is no text.
    """
    texts = dict.fromkeys(text for own in sources.values() for text in own)
    cut = df.select(
        key, *(overlapping_chunks(F.coalesce(F.col(x), F.lit(""))).alias(f"chunks_{x}") for x in texts)
    )

    def found(text: str, words: Sequence[str]) -> Column:
        def holds(chunk: Column) -> Column:
            return reduce(Column.__or__, (F.contains(chunk, F.lit(w)) for w in words))

        return F.exists(f"chunks_{text}", holds)

    flags = {}
    for concept, own in sources.items():
        flag = reduce(Column.__or__, (found(text, keywords[concept]) for text in own))
        if concept in null_if_empty:
            flag = F.when(F.size(f"chunks_{own[0]}") > 0, flag)
        flags[concept] = flag
    return cut.select(key, *(flag.alias(concept) for concept, flag in flags.items()))


def cascaded(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """The first label where it is yes, else the second; the longer of the two texts.

    ``second`` need only hold the keys that the first pass left at no.
    """
    one, two = first.alias("one"), second.alias("two")
    settled = F.col("one.detected") == YES
    return one.join(two, key, "left").select(
        key,
        F.greatest("one.text_length", F.coalesce("two.text_length", F.lit(0))).alias("text_length"),
        F.when(settled, F.col("one.detected")).otherwise(F.col("two.detected")).alias("detected"),
        F.when(settled, F.col("one.explanation")).otherwise(F.col("two.explanation")).alias("explanation"),
    )


def unsettled(df: DataFrame, first: DataFrame, key: str) -> DataFrame:
    """The rows whose first pass did not say yes."""
    return df.join(first.where(F.col("detected") == YES).select(key), key, "left_anti")


def label_cascade(
    df: DataFrame, key: str, texts: Sequence[str], concept: str, make_labeller: Callable[[], Labeller]
) -> DataFrame:
    """Label the first text; ask about the second only where that said no.

    The first pass is written before it is read twice, so no chunk is put to
    the labeller again.
    """
    first = materialize(label_text(df, key, texts[0], concept, make_labeller), "first-pass")
    second = label_text(unsettled(df, first, key), key, texts[1], concept, make_labeller)
    lengths = df.select(key, F.coalesce(F.length(texts[1]), F.lit(0)).alias("other_length"))
    return (
        cascaded(first, second, key)
        .join(lengths, key)
        .select(key, F.greatest("text_length", "other_length").alias("text_length"), "detected", "explanation")
    )


def unseen(df: DataFrame, labels: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """The rows that the label table does not hold yet, by one key or several."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.join(labels.select(*keys), keys, "left_anti")


def encoded(label: Column) -> Column:
    """Yes 1, no 0, unknown null."""
    return F.when(label == YES, 1).when(label == NO, 0)


def label_wide(labels: DataFrame, key: str, concepts: Sequence[str] = C_TEXT) -> DataFrame:
    """Long labels (key, concept, detected) to one 0/1 column per concept."""
    values = labels.select(key, "concept", encoded(F.col("detected")).alias("value"))
    return values.groupBy(key).pivot("concept", list(concepts)).agg(F.max("value"))
