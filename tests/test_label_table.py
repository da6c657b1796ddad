"""The label table's commits and plans, asking in waves, code rules and slices of an order."""

from __future__ import annotations

import random
import re
import threading

import pytest
from pyspark.sql import functions as F

from wardframe.operators.code_rules import MOST_RULES, interval_index, rule_flags
from wardframe.operators.label_many import label_into, still_to_ask
from wardframe.operators.label_waves import label_in_waves
from wardframe.operators.labelling import label_text
from wardframe.operators.ranks import ordered_slice, ranked
from wardframe.sources.label_table import LabelTable

KINDS = "hadm_id long, concept string, text_length int, detected string, explanation string"


def _rows(spark, keys, concept="a", said="Yes"):
    return spark.createDataFrame([(k, concept, 1, said, "x") for k in keys], KINDS)


@pytest.fixture
def table(spark, tmp_path):
    made = LabelTable(spark, f"file://{tmp_path}/labels", spark.createDataFrame([], KINDS).schema, buckets=4)
    yield made
    made.close()


def _again(table):
    return LabelTable(table.spark, table.path, table.schema, table.key, table.buckets)


def _keys(table):
    return sorted((r["hadm_id"], r["concept"]) for r in table.rows().collect())


def test_appends_are_whole_or_not_there(spark, table):
    assert table.rows().count() == 0 and table.commits() == []
    table.draft(_rows(spark, range(5)))  # written, never committed
    assert _keys(table) == [] and _keys(_again(table)) == []
    assert table.append(_rows(spark, [0, 1, 1, 2]), "one")
    assert not table.append(_rows(spark, [7]), "one")
    assert _again(table).append(_rows(spark, [2, 3]).unionByName(_rows(spark, [2], "b")), "two")
    assert _keys(table) == [(0, "a"), (1, "a"), (2, "a"), (2, "b"), (3, "a")]
    assert table.append(_rows(spark, []), "none")
    assert len(table.commits()) == 3


def test_the_smallest_of_doubled_labels_stays(spark, table):
    table.append(_rows(spark, [1], said="Yes").unionByName(_rows(spark, [1], said="No")), "one")
    assert [r["detected"] for r in table.rows().collect()] == ["No"]


@pytest.mark.parametrize("others", [1, 3])
def test_a_writer_that_is_overtaken_adds_no_key_twice(spark, table, others):
    commit, left = table._commit, list(range(others))

    def overtaken(entry):
        if left:
            i = left.pop()
            assert _again(table).append(_rows(spark, range(i, i + 4)), f"other {i}")
        return commit(entry)

    table._commit = overtaken
    assert table.append(_rows(spark, range(8)), "mine")
    assert _keys(table) == [(k, "a") for k in range(8)]
    assert len(table.commits()) == others + 1


def test_the_same_batch_by_two_writers_is_added_once(spark, table):
    commit, first = table._commit, [True]

    def overtaken(entry):
        if first:
            first.clear()
            assert _again(table).append(_rows(spark, range(3)), "batch")
        return commit(entry)

    table._commit = overtaken
    assert not table.append(_rows(spark, range(3)), "batch")
    assert _keys(table) == [(k, "a") for k in range(3)] and len(table.commits()) == 1


def test_writers_at_the_same_time(spark, table):
    failed = []

    def write(i):
        try:
            _again(table).append(_rows(spark, range(i, i + 10)), f"writer {i}")
        except Exception as error:  # noqa: BLE001 - told below
            failed.append(error)

    threads = [threading.Thread(target=write, args=(i,)) for i in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed
    assert _keys(table) == [(k, "a") for k in range(13)]


def test_compaction_keeps_rows_and_steps_back(spark, table):
    for i in range(3):
        table.append(_rows(spark, range(2 * i, 2 * i + 3)), f"b{i}")
    before, commit = _keys(table), table._commit
    table._commit = lambda entry: _again(table).append(_rows(spark, [50]), "late") and commit(entry)
    assert not table.compact()
    table._commit = commit
    assert table.compact() and len(table._folders(table.commits())) == 1
    assert _keys(table) == _keys(_again(table)) == sorted([*before, (50, "a")])
    assert not table.append(_rows(spark, [9]), "b1")


def test_no_label_is_shuffled_to_find_what_is_new(spark, table):
    for i, concept in enumerate(("a", "b", "a")):
        table.append(_rows(spark, range(4 * i, 4 * i + 6), concept), f"b{i}")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        texts = spark.createDataFrame([(k, "text") for k in range(20)], "hadm_id long, discharge_text string")
        todo = still_to_ask(texts, ["a", "b"], table)
        for frame in (todo, table.unseen(_rows(spark, range(20)))):
            plan = frame._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Bucketed: true") == 3
            assert len(re.findall(r"Exchange \w", plan)) == 1 and "REPARTITION_BY_NUM" in plan
        left = {r["hadm_id"]: r["todo"] for r in todo.select("hadm_id", "todo").collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    held = _keys(table)
    assert left == {k: t for k in range(20) if (t := [c for c in ("a", "b") if (k, c) not in held])}


def test_what_is_known_is_not_asked_again(spark, table):
    calls = spark.sparkContext.accumulator(0)

    def make():
        def answer(prompts):
            calls.add(len(prompts))
            return ["Yes" for _ in prompts]

        return answer

    texts = spark.createDataFrame([(k, "word " * k) for k in range(1, 9)], "hadm_id long, discharge_text string")
    label_into(texts.where("hadm_id < 4"), "hadm_id", ["ards_detected"], make, table, "first")
    assert calls.value == 3
    label_into(texts, "hadm_id", ["ards_detected", "trali_detected"], make, table, "second")
    assert calls.value == 3 + 5 + 8
    label_into(texts, "hadm_id", ["ards_detected", "trali_detected"], make, table, "third")
    assert calls.value == 16 and table.rows().count() == 16


@pytest.mark.parametrize("null_if_empty", [False, True])
def test_waves_give_the_same_labels_from_fewer_calls(spark, null_if_empty):
    step, size = 3996, 4096
    texts = [None, "", "short", "short yesword"]
    for n, at in [(1, 0), (2, 1), (7, 0), (7, 3), (7, 6), (9, 7), (12, None), (20, 5)]:
        text = "a" * (step * n)
        texts.append(text if at is None else text[: step * at + 200] + "yesword" + text[step * at + 207 :])
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "k long, body string").repartition(3)

    def make():
        def label(prompt):
            if "short" in prompt and "yesword" not in prompt:
                raise RuntimeError("down")
            return "Yes: it" if "yesword" in prompt else f"No {len(prompt)}"

        return label

    got = label_in_waves(df, "k", "body", "ards_detected", make, null_if_empty)
    want = label_text(df, "k", "body", "ards_detected", make, null_if_empty)
    assert sorted(map(tuple, got.drop("n_calls").collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    calls = {r["k"]: r["n_calls"] for r in got.collect()}
    for k, text in rows:
        chunks = [text[p : p + size] for p in range(0, len(text or ""), step)]
        found = next((i for i, c in enumerate(chunks) if "yesword" in c), None)
        asked = len(chunks) if found is None else min(len(chunks), 2 ** (found + 1).bit_length() - 1)
        assert calls[k] == asked
    assert label_in_waves(df.where("false"), "k", "body", "ards_detected", make).count() == 0


def test_rules_equal_brute_force(spark):
    rng = random.Random(4)
    letters = "0A9Zé"
    code = lambda n: "".join(rng.choice(letters) for _ in range(n))
    rules = [(f"g{rng.randrange(6)}", rng.choice([9, 10]), *sorted((code(rng.randrange(1, 4)), code(rng.randrange(1, 4))))) for _ in range(40)]
    rules += [("g1", 9, "Z", "0"), ("g2", 9, None, "9"), ("g3", None, "0", "9"), ("empty", 10, "zz", "zz"), rules[0], rules[0]]
    rows = [(rng.randrange(60), rng.choice([9, 10, 11, None]), rng.choice([None, "", code(rng.randrange(1, 6))])) for _ in range(400)]
    table = spark.createDataFrame(rules, "code_group string, system int, low string, high string")
    facts = spark.createDataFrame(rows, "hadm_id int, icd_version int, icd_code string")
    found = rule_flags(facts, table)
    names = sorted({r[0] for r in rules})
    assert found.columns == ["hadm_id", *names]
    want = {}
    for key, system, text in rows:
        flags = want.setdefault(key, dict.fromkeys(names, 0))
        for group, own, low, high in rules:
            if None not in (system, text, own, low, high) and own == system and low <= text[:3] <= high:
                flags[group] = 1
    assert {r["hadm_id"]: {n: r[n] for n in names} for r in found.collect()} == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    starts, groups = interval_index(table)[9]
    assert starts == sorted(set(starts)) and groups[-1] == []


def test_rules_are_bounded(spark):
    many = spark.range(MOST_RULES + 1).select(
        F.lit("g").alias("code_group"), F.lit(9).alias("system"), F.col("id").cast("string").alias("low"), F.col("id").cast("string").alias("high")
    )
    with pytest.raises(ValueError, match="rules"):
        interval_index(many)


def test_places_of_a_key_in_many_tasks(spark):
    rng = random.Random(8)
    rows = [(7, rng.randrange(500)) for _ in range(3000)] + [(rng.choice([None, 1, 2, 9]), rng.choice([None, 3, 4])) for _ in range(60)]
    df = spark.createDataFrame(rows, "k int, v int").repartition(5)
    got = ranked(df, ["k"], [F.col("v").asc_nulls_first()], "place").collect()
    by_key = {}
    for k, v in rows:
        by_key.setdefault(k, []).append(v)
    want = [(k, v, i + 1) for k, own in by_key.items() for i, v in enumerate(sorted(own, key=lambda v: (v is not None, v or 0)))]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    parts = ranked(df, ["k"], [F.col("v")], "place").where("k = 7").select(F.input_file_name()).distinct().count()
    assert parts > 1
    assert ranked(df.where("false"), ["k"], [F.col("v")], "place").count() == 0


@pytest.mark.parametrize("start,count", [(0, 5), (90, 200), (299, 10), (300, 5), (1000, 5), (50, 0), (0, 1000)])
def test_slices(spark, start, count):
    rows = [(i * 7 % 300, f"r{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "v int, name string").repartition(4)
    got = ordered_slice(df, [F.col("v")], start, count).collect()
    assert sorted(map(tuple, got)) == sorted(rows)[start : start + count]
