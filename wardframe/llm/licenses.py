"""License scans by matching template markup.

A template is the wording of a license or notice with marked regions:
``<<beginOptional>>...<<endOptional>>`` may be left out, and
``<<var;original="...";match=N>>`` stands for up to N words of any kind. Each is
compiled to an automaton over words that accepts a text only if the mandatory
wording is there word for word.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardframe.llm.texts import alnum_words, byte_values, slices

SLICE_BYTES = 4 << 20

# fixed values: phrases and their labels
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# notices and openings of well-known licenses, in their public wording
TEMPLATES = {
    "apache-2.0": (
        "licensed under the apache license<<beginOptional>> version<<endOptional>> 2 0"
        '<<beginOptional>> the license you may not use this <<var;original="file";match=2>> except in compliance'
        " with the license<<endOptional>>"
    ),
    "mit": (
        '<<beginOptional>>released <<endOptional>><<beginOptional>>licensed <<endOptional>>under the'
        "<<beginOptional>> terms of the<<endOptional>> mit license"
    ),
    "mit-text": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
        ' documentation files <<beginOptional>>the <<var;original="Software";match=1>> <<endOptional>>to deal in the'
        " software without restriction"
    ),
    "isc-text": (
        "permission to use copy modify<<beginOptional>> and or<<endOptional>> distribute this software for any purpose"
        " with or without fee is hereby granted"
    ),
    "bsd-text": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that"
        " the following conditions are met"
    ),
    "gpl-3.0": (
        '<<beginOptional>>licensed <<endOptional>>under the<<beginOptional>> terms of the<<endOptional>> gnu general'
        " public license<<beginOptional>> as published by the free software foundation either<<endOptional>>"
        " version 3"
    ),
    "gpl-2.0": (
        '<<beginOptional>>licensed <<endOptional>>under the<<beginOptional>> terms of the<<endOptional>> gnu general'
        " public license<<beginOptional>> as published by the free software foundation either<<endOptional>>"
        " version 2"
    ),
    "cc-by-4.0": "under<<beginOptional>> a<<endOptional>> cc by 4 0",
    "cc-by-sa-4.0": "under<<beginOptional>> a<<endOptional>> cc by sa 4 0",
    "cc-by-nc-4.0": "under<<beginOptional>> a<<endOptional>> cc by nc 4 0",
    "mpl-2.0": (
        "this source code form is subject to the terms of the mozilla public license"
        "<<beginOptional>> v<<endOptional>><<beginOptional>> version<<endOptional>> 2 0"
    ),
    "copyright-notice": 'copyright <<beginOptional>>c <<endOptional>><<var;original="2000 Owner";match=8>> all rights reserved',
}

_MARK = re.compile(r"<<(beginOptional|endOptional|var;[^>]*?match=(\d+))>>")


class Automaton:
    """States of a template: on a word to the next state, or on nothing past a region that may be left out."""

    def __init__(self, template: str) -> None:
        self.on_word: list[tuple[bytes | None, int]] = []  # None: any word
        self.free: dict[int, list[int]] = {}
        opened: list[int] = []
        for text, kind, times in self._parts(template):
            for word in next(alnum_words(text.encode())):
                self.on_word.append((word, len(self.on_word) + 1))
            if kind == "beginOptional":
                opened.append(len(self.on_word))
            elif kind == "endOptional":
                self.free.setdefault(opened.pop(), []).append(len(self.on_word))
            elif kind:
                begin = len(self.on_word)
                self.on_word += [(None, begin + i + 1) for i in range(times)]
                for i in range(times):
                    self.free.setdefault(begin + i, []).append(begin + times)
        self.end = len(self.on_word)
        self.starts = sorted({w for s in self._closed({0}) if s < self.end and (w := self.on_word[s][0])})
        # the rarest-looking word that every match must hold, to pass over texts without it
        inside = self._optional_states()
        fixed = [w for i, (w, _) in enumerate(self.on_word) if w and i not in inside]
        self.anchor = max(fixed, key=len)

    @staticmethod
    def _parts(template: str) -> Iterator[tuple[str, str, int]]:
        at = 0
        for mark in _MARK.finditer(template):
            yield template[at : mark.start()], mark[1].split(";")[0], int(mark[2] or 0)
            at = mark.end()
        yield template[at:], "", 0

    def _optional_states(self) -> set[int]:
        return {i for begin, ends in self.free.items() for end in ends for i in range(begin, end)}

    def _closed(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for target in self.free.get(todo.pop(), ()):
                if target not in states:
                    states.add(target)
                    todo.append(target)
        return states

    def match(self, words: list[bytes], begin: int) -> int | None:
        """Where the longest match from ``begin`` ends, or None."""
        states, found = self._closed({0}), None
        for at in range(begin, len(words) + 1):
            if self.end in states:
                found = at
            if at == len(words) or not states:
                break
            word = words[at]
            states = self._closed(
                {self.on_word[s][1] for s in states if s < self.end and self.on_word[s][0] in (None, word)}
            )
        return found


class Scanner:
    def __init__(self, templates: dict[str, str] = TEMPLATES, phrases: dict[str, str] = PHRASES) -> None:
        self.automata = {name: Automaton(t) for name, t in templates.items()}
        self.phrases = {tuple(p.encode().split()): label for p, label in phrases.items()}
        self.reach = max([a.end for a in self.automata.values()] + [len(p) for p in self.phrases])

    def scan(self, data: bytes | None) -> tuple[int, list[tuple[int, str]], list[tuple[str, int, int]]]:
        """Words of the text, places of phrases (start, label), and spans of templates (label, begin, end)."""
        total, carried = 0, []
        places: list[tuple[int, str]] = []
        spans: set[tuple[str, int, int]] = set()
        for fresh in alnum_words(data):
            words = carried + fresh
            base, new = total - len(carried), len(carried)
            line = b" " + b" ".join(words) + b" "
            for phrase, label in self.phrases.items():
                for at in _places(line, b" " + b" ".join(phrase) + b" "):
                    if at + len(phrase) > new:
                        places.append((base + at, label))
            for name, automaton in self.automata.items():
                if b" " + automaton.anchor + b" " not in line:
                    continue
                for anchor in _places(line, b" " + automaton.anchor + b" "):
                    for begin in range(max(0, anchor - automaton.end), anchor + 1):
                        if words[begin] in automaton.starts and (end := automaton.match(words, begin)) is not None:
                            if end > anchor:
                                spans.add((name, base + begin, base + end))
            total += len(fresh)
            carried = words[-2 * self.reach :]
        return total, sorted(places), _outermost(spans)


def _outermost(spans: set[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Without the spans that lie inside another of the same label."""
    out: list[tuple[str, int, int]] = []
    for span in sorted(spans, key=lambda s: (s[0], s[1], -s[2])):
        if not out or out[-1][0] != span[0] or span[2] > out[-1][2]:
            out.append(span)
    return sorted(out, key=lambda s: (s[1], s[2], s[0]))


def _places(line: bytes, part: bytes) -> Iterator[int]:
    """The numbers of the words of ``line`` where ``part`` (framed by blanks, as ``line`` is) begins."""
    at, word, seen = line.find(part), 0, 0
    while at >= 0:
        word += line.count(b" ", seen, at)
        seen = at
        yield word
        at = line.find(part, at + 1)


def scan_licenses(
    docs: DataFrame, scanner: Scanner | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """License phrases and templates in every whole text.

    ``id_column``; ``n_words``; ``n_base``, ``first_word``, ``last_word`` (places
    of phrases); ``base_labels`` and ``labels`` (those of templates too), each
    distinct, sorted and comma-joined; ``spans`` (label, first word, word after
    the last) of templates; ``score``: 1 with an accepted template, 0.5 with
    phrases only, else 0. A null text is empty.
    """
    shared = docs.sparkSession.sparkContext.broadcast(scanner or Scanner())  # the templates

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "t", SLICE_BYTES):
            rows = []
            for data in byte_values(batch.column("t")):
                n, places, spans = shared.value.scan(data)
                base = {label for _, label in places}
                rows.append(
                    {
                        "n_words": n,
                        "n_base": len(places),
                        "first_word": places[0][0] if places else None,
                        "last_word": places[-1][0] if places else None,
                        "base_labels": ",".join(sorted(base)),
                        "labels": ",".join(sorted(base | {s[0] for s in spans})),
                        "spans": [{"label": s[0], "begin": s[1], "end": s[2]} for s in spans],
                        "score": 1.0 if spans else 0.5 if base else 0.0,
                    }
                )
            found = pa.RecordBatch.from_pylist(rows, _FOUND)
            yield pa.RecordBatch.from_arrays([batch.column("k"), *found.columns], ["k", *_FOUND.names])

    keyed = docs.select(F.col(id_column).alias("k"), F.col(text_column).cast("string").alias("t"))
    kind = keyed.schema["k"].dataType.simpleString()
    return keyed.mapInArrow(
        run,
        f"k {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string,"
        " labels string, spans array<struct<label:string,begin:bigint,end:bigint>>, score double",
    ).withColumnRenamed("k", id_column)


_FOUND = pa.schema(
    [(n, pa.int64()) for n in ("n_words", "n_base", "first_word", "last_word")]
    + [(n, pa.string()) for n in ("base_labels", "labels")]
    + [
        ("spans", pa.list_(pa.struct([("label", pa.string()), ("begin", pa.int64()), ("end", pa.int64())]))),
        ("score", pa.float64()),
    ]
)
