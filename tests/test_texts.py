"""Notes, chunks and labels on small texts."""

from __future__ import annotations

import random
import uuid
from pathlib import Path

import sys

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardframe import schemas
from wardframe.fixed_values import C_TEXT, CHUNK_OVERLAP, CHUNK_SIZE, NOTE_SEPARATOR, PROMPTS
from wardframe.functions.texts import overlapping_chunks
from wardframe.operators import labelling
from wardframe.operators.note_parts import chunks_from_notes
from wardframe.plans.cohort_notes import cohort_notes, patient_reports
from wardframe.shipping import ship_by_value
from wardframe.sources.quoted_csv import read_quoted_csv
from wardframe.sources.readers import read_notes_csv, read_parquet
from wardframe.operators.keys import first_rows
from wardframe.operators import label_many as label_many_module
from wardframe.operators.label_many import label_many, label_new
from wardframe.sources.sinks import append_labels, existing_labels, write_csv

ship_by_value(sys.modules[__name__])


def windows(text: str, size: int, overlap: int) -> list[str]:
    """Brute force: every step that starts inside the text."""
    return [text[i : i + size] for i in range(0, len(text), size - overlap)]


@pytest.mark.parametrize("length", [0, 1, 3996, 3997, 4096, 4097, 9000])
def test_chunk_lengths(spark, length):
    text = ("ab\n😀é\r" * (length // 6 + 1))[:length]
    row = spark.createDataFrame([(text,)], "t string").select(overlapping_chunks(F.col("t")).alias("c")).first()
    assert row["c"] == windows(text, CHUNK_SIZE, CHUNK_OVERLAP)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    text=st.text(st.characters(blacklist_categories=("Cs",), blacklist_characters="\x00"), max_size=60),
    size=st.integers(1, 12),
    data=st.data(),
)
def test_chunks_match_brute_force(spark, text, size, data):
    overlap = data.draw(st.integers(0, size - 1))
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(overlapping_chunks(F.col("t"), size, overlap)).first()[0] == windows(text, size, overlap)


def test_chunks_of_joined_notes(spark):
    notes = {
        1: ["", "one", "a much longer note " * 3, "", "end"],
        2: ["x" * 45],
        3: ["", ""],
        4: ["ab", "c"] * 9,
    }
    rows = [(k, i, text) for k, texts in notes.items() for i, text in enumerate(texts)]
    rows.append((1, 99, None))
    df = spark.createDataFrame(rows, "k int, at int, text string").repartition(3)
    chunks = chunks_from_notes(df, "k", "at", F.floor(F.col("at") / 2), size=16, overlap=5)
    found: dict[int, dict[int, str]] = {}
    for r in chunks.collect():
        found.setdefault(r["k"], {})[r["chunk_no"]] = r["chunk"]
    for k, texts in notes.items():
        expected = windows(NOTE_SEPARATOR.join(texts), 16, 5)
        assert [found.get(k, {})[i] for i in range(len(expected))] == expected
        assert len(found.get(k, {})) == len(expected)


def ecg_row(subject, study, *reports):
    return (subject, study, *reports, *([None] * (18 - len(reports))))


@pytest.fixture(scope="module")
def note_tables(spark):
    cohort = spark.createDataFrame([(1, 11, ), (2, 11), (3, 13)], "hadm_id long, subject_id long")
    discharge = spark.createDataFrame(
        [(1, "d2", "second"), (1, "d1", "first"), (2, "d3", 'said "hi"\nthen left'), (9, "d9", "other")], schemas.DISCHARGE
    )
    radiology = spark.createDataFrame([(1, "r2", "B"), (1, "r1", "A"), (1, "r3", None)], schemas.RADIOLOGY)
    ecg = spark.createDataFrame(
        [ecg_row(11, 7, "x", None, "y"), ecg_row(11, 7, "dup"), ecg_row(11, 5), ecg_row(99, 1, "other")], schemas.ECG
    )
    return cohort, discharge, radiology, ecg


def test_consolidated_notes(note_tables):
    cohort, discharge, radiology, ecg = note_tables
    rows = cohort_notes(cohort, discharge, radiology, ecg).collect()
    assert [(r["hadm_id"], r["discharge_note_id"]) for r in sorted(rows, key=lambda r: (r[0], r[1] or ""))] == [
        (1, "d1"),
        (1, "d2"),
        (2, "d3"),
        (3, None),
    ]
    first = next(r for r in rows if r["discharge_note_id"] == "d1")
    assert (first["radiology_note_ids"], first["radiology_texts"]) == ("r1, r2, r3", "A ||| B")
    assert first["ecd_study_ids"] == "5, 7"
    # every missing report keeps its blank: 17 separators per study
    assert first["ecd_combined_reports"] == NOTE_SEPARATOR.join([" " * 17, "dup" + " " * 17, "x  y" + " " * 15])
    last = next(r for r in rows if r["hadm_id"] == 3)
    assert last["radiology_texts"] is None and last["ecd_combined_reports"] is None
    shared = patient_reports(cohort, ecg).collect()
    assert sorted(r["hadm_id"] for r in shared) == [1, 2]


def test_notes_csv(spark, note_tables, tmp_path):
    path = str(tmp_path / "notes")
    notes = cohort_notes(*note_tables)
    write_csv(notes, path)
    back = {tuple(r) for r in read_notes_csv(spark, path).collect()}
    assert back == {tuple("" if v is None else v for v in r) for r in notes.collect()}


AWKWARD = ["", "plain", 'said ""', '"', ",", "a\nb", "a\r\nb\r", "\n\n", " blank ", "é😀\n" * 40, '"\n"' * 30, "x" * 300, None]


@pytest.mark.parametrize("ends", ["\n", "\r\n"])
@pytest.mark.parametrize("size", [37, 200, 1 << 20])
def test_quoted_csv_in_splits_of_any_size(spark, tmp_path, ends, size):
    """Files of several sizes, cut anywhere, against what was written by Python's own module."""
    rng, expected = random.Random(size), []
    for file, many in (("a.csv", 40), ("b.csv", 1), ("c.csv", 0)):
        with open(tmp_path / file, "w", newline="", encoding="utf-8") as out:
            out.write(f"hadm_id,note,other{ends}")
            for _ in range(many):
                row = (len(expected), rng.choice(AWKWARD), rng.choice(AWKWARD))
                quoted = ["" if v is None else '"' + v.replace('"', '""') + '"' for v in row[1:]]
                out.write(",".join([str(row[0]), *quoted]) + ends + (ends if rng.random() < 0.1 else ""))
                expected.append(row)
    (tmp_path / "d.csv").touch()
    schema = T.StructType.fromDDL("hadm_id long, note string, other string")
    before = {n: spark.conf.get(n) for n in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for name in before:
            spark.conf.set(name, str(size))
        found = read_quoted_csv(spark, str(tmp_path), schema)
        rows = sorted(tuple(r) for r in found.collect())
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert rows == [(i, note or None, other or None) for i, note, other in expected]


def test_quoted_csv_checks_the_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text('hadm_id,text\n1,"a\nb"\n')
    with pytest.raises(Exception, match="the header is"):
        read_quoted_csv(spark, str(tmp_path), T.StructType.fromDDL("hadm_id long, note string")).collect()


ANSWERS = {
    "yes": "  Yes, clearly \n",
    "lower": "yes",
    "no": " No ",
    "yesterday": "Not before Yesterday",
}


def labeller():
    def answer(prompt: str) -> str:
        text = prompt.split("Text:\n", 1)[1].rsplit("\n\nQuery:", 1)[0]
        if "boom" in text:
            raise ValueError("x")
        return next((a for word, a in ANSWERS.items() if f"<{word}>" in text), "No")

    return answer


@pytest.fixture(scope="module")
def texts(spark):
    rows = [
        (1, "<no>" + "." * 4095 + "<yes>"),
        (2, "<lower>"),
        (3, "<yesterday>"),
        (4, "boom"),
        (5, ""),
        (6, None),
        (7, "<yes>" + "." * 4095 + "<no>"),
    ]
    return spark.createDataFrame(rows, "hadm_id long, text string")


def test_callable_labeller(texts):
    rows = {r["hadm_id"]: r for r in labelling.label_text(texts, "hadm_id", "text", "trali_detected", labeller).collect()}
    assert [rows[i]["detected"] for i in range(1, 8)] == ["Yes", "No", "Yes", "No", "No", "No", "Yes"]
    assert rows[1]["explanation"] == "Yes, clearly"
    assert rows[3]["explanation"] == "Not before Yesterday"
    assert rows[4]["explanation"] == "Error invoking model: x"
    assert rows[5]["explanation"] == rows[6]["explanation"] == "No sufficient data"
    assert (rows[1]["text_length"], rows[6]["text_length"]) == (4104, 0)


def test_missing_text_is_unknown_where_asked(texts):
    labels = labelling.label_text(texts, "hadm_id", "text", "bilateral_infiltrates_detected", labeller, null_if_empty=True)
    rows = {r["hadm_id"]: r for r in labels.collect()}
    assert tuple(rows[5]) == (5, 0, None, "No radiology text available")
    assert rows[6]["detected"] is None and rows[2]["detected"] == "No"


def test_keyword_and_callable_agree(texts):
    words = ("<yes>", "<lower>")

    def make():
        return lambda prompt: next((f"Yes: {w}" for w in words if w in prompt), "No")

    native = labelling.keyword_label_text(texts, "hadm_id", "text", words)
    called = labelling.label_text(texts, "hadm_id", "text", "trali_detected", make)
    assert sorted(native.collect()) == sorted(called.collect())


def test_cascade(spark):
    schema = "k long, text_length int, detected string, explanation string"
    first = spark.createDataFrame([(1, 9, "Yes", "a"), (2, 3, "No", "b"), (3, 0, "No", "c")], schema)
    second = spark.createDataFrame([(2, 8, "Yes", "d"), (3, 1, "No", "e")], schema)
    rows = {r["k"]: tuple(r)[1:] for r in labelling.cascaded(first, second, "k").collect()}
    assert rows == {1: (9, "Yes", "a"), 2: (8, "Yes", "d"), 3: (1, "No", "e")}
    assert [r["k"] for r in labelling.unsettled(first, first, "k").orderBy("k").collect()] == [2, 3]


def test_cascaded_label_asks_only_open_rows(spark):
    df = spark.createDataFrame(
        [(1, "<yes>", "boom"), (2, "<no>", "<yes>"), (3, "", "<no>")],
        "hadm_id long, ecd_combined_reports string, discharge_text string",
    )
    rows = labelling.label_cascade(df, "hadm_id", ["ecd_combined_reports", "discharge_text"], "cardiac_failure_detected", labeller)
    assert {r["hadm_id"]: (r["detected"], r["explanation"]) for r in rows.collect()} == {
        1: ("Yes", "Yes, clearly"),
        2: ("Yes", "Yes, clearly"),
        3: ("No", "No"),
    }


def test_wide_labels(spark):
    rows = [(1, "ards_detected", "Yes"), (1, "pneumonia_detected", "No"), (2, "trali_detected", None)]
    wide = labelling.label_wide(spark.createDataFrame(rows, "k long, concept string, detected string"), "k")
    found = {r["k"]: r for r in wide.collect()}
    assert wide.columns == ["k", *C_TEXT]
    assert (found[1]["ards_detected"], found[1]["pneumonia_detected"], found[1]["trali_detected"]) == (1, 0, None)
    assert found[2]["trali_detected"] is None


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_label_sink_adds_no_key_twice(spark, tmp_path, fmt):
    path = str(tmp_path / fmt)
    schema = "hadm_id long, text_length int, trali_detected string"
    first = spark.createDataFrame([(1, 10, "Yes"), (2, 20, "No")], schema)
    more = spark.createDataFrame([(2, 20, "No"), (3, 5, None)], schema)
    append_labels(first, path, fmt=fmt)
    append_labels(more, path, fmt=fmt)
    append_labels(more, path, fmt=fmt)
    assert sorted(r[0] for r in existing_labels(spark, path, first, fmt).collect()) == [1, 2, 3]


def test_every_prompt_has_one_place_for_the_text():
    assert set(PROMPTS) == set(C_TEXT)
    assert all(p.count("{text}") == 1 for p in PROMPTS.values())


def test_keyword_cascade_and_detections(spark):
    df = spark.createDataFrame(
        [(1, "heart", "", ""), (2, "", "a heart", "opaque"), (3, None, "calm", ""), (4, "x", "y", "clear")],
        "k long, ecd_combined_reports string, discharge_text string, radiology_texts string",
    )
    cascade = labelling.keyword_cascade(df, "k", ["ecd_combined_reports", "discharge_text"], ["heart"])
    assert {r["k"]: tuple(r)[1:] for r in cascade.collect()} == {
        1: (5, "Yes", "Yes: heart"),
        2: (7, "Yes", "Yes: heart"),
        3: (4, "No", "No"),
        4: (1, "No", "No"),
    }
    words = {c: ["nothing"] for c in C_TEXT}
    words |= {"cardiac_failure_detected": ["heart"], "bilateral_infiltrates_detected": ["opaque"]}
    flags = {r["k"]: r for r in labelling.keyword_detections(df, "k", words).collect()}
    assert [flags[i]["cardiac_failure_detected"] for i in (1, 2, 3, 4)] == [True, True, False, False]
    assert [flags[i]["bilateral_infiltrates_detected"] for i in (1, 2, 3, 4)] == [None, True, None, False]
    assert flags[3]["pneumonia_detected"] is False


def test_typed_parquet_source_prunes(spark, tmp_path):
    path = str(tmp_path / "diagnoses")
    spark.createDataFrame([(1, "4660", 9, "x")], "hadm_id long, icd_code string, icd_version int, other string").write.parquet(path)
    table = read_parquet(spark, path, schemas.DIAGNOSES)
    assert table.schema == schemas.DIAGNOSES and tuple(table.first()) == (1, "4660", 9)
    assert "other" not in table._jdf.queryExecution().executedPlan().toString()


def test_label_sink_keeps_awkward_text(spark, tmp_path):
    rows = spark.createDataFrame([(1, ' "quoted",\nnext line '), (2, "plain")], "hadm_id long, explanation string")
    append_labels(rows, str(tmp_path / "csv"), fmt="csv")
    append_labels(rows, str(tmp_path / "csv"), fmt="csv")
    assert sorted(existing_labels(spark, str(tmp_path / "csv"), rows, "csv").collect()) == sorted(rows.collect())


def test_label_sink_keeps_concepts_apart(spark, tmp_path):
    path = str(tmp_path / "long")
    schema = "hadm_id long, concept string, detected string"
    for concept in ("a", "b"):
        rows = spark.createDataFrame([(1, concept, "Yes"), (2, concept, "No"), (2, concept, "No")], schema)
        append_labels(rows, path)
        append_labels(rows, path)
    assert sorted(r[:2] for r in existing_labels(spark, path, rows).collect()) == [(1, "a"), (1, "b"), (2, "a"), (2, "b")]


def _counting(folder, fail=None):
    """A batched labeller that leaves a line per prompt, and fails on prompts that hold ``fail``."""

    def make():
        def label(prompts):
            with open(f"{folder}/{uuid.uuid4().hex}", "w") as out:
                out.write("x" * len(prompts))
            return [ValueError("down") if fail and fail in p else "Yes" if "bad" in p else "No" for p in prompts]

        return label

    return make


def _calls(folder):
    return sum(f.stat().st_size for f in Path(folder).iterdir())


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_only_new_texts_and_concepts_are_asked(spark, tmp_path, broadcast):
    asked, path = tmp_path / "asked", str(tmp_path / "labels")
    asked.mkdir()
    df = spark.createDataFrame(
        [(1, "bad", "", ""), (2, "fine", "bad", ""), (3, None, None, None)],
        "k long, discharge_text string, radiology_texts string, ecd_combined_reports string",
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        concepts = ["ards_detected", "bilateral_infiltrates_detected"]
        label_new(df.where("k < 2"), "k", concepts[:1], _counting(asked), path)
        assert _calls(asked) == 1
        label_new(df, "k", concepts, _counting(asked), path, parts=2)
        assert _calls(asked) == 3  # text 2 for one concept, radiology 2 for the other
        label_new(df, "k", concepts, _counting(asked), path)
        assert _calls(asked) == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    found = {(r["k"], r["concept"]): (r["detected"], r["explanation"]) for r in read_parquet(spark, path).collect()}
    assert found == {
        (1, "ards_detected"): ("Yes", "Yes"),
        (2, "ards_detected"): ("No", "No"),
        (3, "ards_detected"): ("No", "No sufficient data"),
        (1, "bilateral_infiltrates_detected"): (None, "No radiology text available"),
        (2, "bilateral_infiltrates_detected"): ("Yes", "Yes"),
        (3, "bilateral_infiltrates_detected"): (None, "No radiology text available"),
    }


def test_failed_calls_are_asked_again(spark, tmp_path):
    asked, path = tmp_path / "asked", str(tmp_path / "labels")
    asked.mkdir()
    df = spark.createDataFrame([(1, "bad"), (2, "fine")], "k long, discharge_text string")
    label_new(df, "k", ["ards_detected"], _counting(asked, fail="fine"), path)
    assert [r["k"] for r in read_parquet(spark, path).collect()] == [1]
    label_new(df, "k", ["ards_detected"], _counting(asked), path)
    assert _calls(asked) == 3
    assert sorted(r["k"] for r in read_parquet(spark, path).collect()) == [1, 2]


def test_many_concepts_cross_the_network_once(spark):
    df = spark.createDataFrame([(1, "bad")], "k long, discharge_text string")
    labels = label_many(df, "k", "discharge_text", _counting("/nowhere"), ["ards_detected", "trali_detected"])
    plan = labels._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1


def test_batch_starts_anywhere(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    assert [r["k"] for r in first_rows(df, ["k"], rows=3, start=4).collect()] == [4, 5, 6]


def _telling_size():
    def label(prompts):
        return [f"Yes: {sum(map(len, prompts))}"] * len(prompts)

    return label


def test_prompts_are_built_a_few_megabytes_at_a_time(spark):
    """Each answer tells how long its list of prompts was; every chunk is asked once for both concepts."""
    df = spark.range(30).select(F.col("id").alias("k"), F.expr("repeat('word ', 60000)").alias("discharge_text"))
    rows = label_many(df, "k", "discharge_text", _telling_size, ["ards_detected", "trali_detected"]).collect()
    assert len(rows) == 60 and {r["detected"] for r in rows} == {"Yes"} and not any(r["failed"] for r in rows)
    assert max(int(r["explanation"].split()[-1]) for r in rows) < 2_100_000


def test_lists_of_prompts_hold_every_prompt_once(monkeypatch):
    monkeypatch.setattr(label_many_module, "PROMPT_CHARACTERS", 10)
    rows = [("abcde", ["x", "y"]), (None, ["x"]), ("", []), ("f", ["y"]), ("g", ["x"])]
    found = list(label_many_module._lists(rows, {"x": ("1", "2"), "y": ("3", "4")}))
    assert found == [
        ([(0, "x"), (0, "y")], ["1abcde2", "3abcde4"]),
        ([(3, "y"), (4, "x")], ["3f4", "1g2"]),
    ]
