"""Text column functions: overlapping windows, answers and templates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardframe.fixed_values import CHUNK_OVERLAP, CHUNK_SIZE, NO, YES

_WHITESPACE = " \t\n\r\x0b\x0c"


def overlapping_chunks(text: Column, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Column:
    """Windows of ``size`` characters starting every ``size - overlap``.

    A look-ahead captures each window while the match itself only consumes one
    step, so the text is walked once; repeated ``substring`` calls would scan
    from the front for every window. ``.`` matches whole code points.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and below size")
    pattern = f"(?s)(?=(.{{1,{size}}})).{{1,{size - overlap}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))


def fill_template(template: str, text: Column) -> Column:
    before, after = template.split("{text}")
    return F.concat(F.lit(before), text, F.lit(after))


def stripped(text: Column) -> Column:
    return F.btrim(text, F.lit(_WHITESPACE))


def says_yes(answer: Column) -> Column:
    """Case-sensitive and anywhere in the answer, so "Yesterday" counts."""
    return F.contains(answer, F.lit(YES))


def keyword_answer(chunk: Column, keywords: Sequence[str]) -> Column:
    """Deterministic stand-in for a model: yes, and the first keyword found."""
    answer = F.lit(NO)
    for word in reversed(keywords):
        answer = F.when(F.contains(chunk, F.lit(word)), F.lit(f"{YES}: {word}")).otherwise(answer)
    return answer


def joined_reports(columns: Sequence[Column]) -> Column:
    """All parts with one blank between them; missing parts keep their blank."""
    parts: list[Column] = []
    for position, column in enumerate(columns):
        if position:
            parts.append(F.lit(" "))
        parts.append(F.coalesce(column, F.lit("")))
    return F.concat(*parts)
