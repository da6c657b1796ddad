"""Plan shapes that decide whether a query survives large tables."""

from __future__ import annotations

import re
from contextlib import contextmanager
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from bindings import tables as t
from bindings.catalog import QUERIES
from wardframe.fixed_values import X_BINARY, X_CONTINUOUS
from wardframe.operators.worst_row import ORGANS, worst_row_by_window
from wardframe.session import materialize, shared_folder

SF_DIR = "/root/testdata/sf0.001"


def plan(df, optimized=False) -> list[str]:
    execution = df._jdf.queryExecution()
    text = (execution.optimizedPlan() if optimized else execution.executedPlan()).toString()
    return text.split("\n")


@contextmanager
def setting(spark, name, value):
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def order_of(lines, *words):
    return [w for line in lines for w in words if re.search(rf"[:+\- ]{w}\b", line)]


@pytest.mark.parametrize("name", ["stay_metrics", "vent_duration", "vasopressor_twa", "comorbidity_bands", "patient_level_notes"])
def test_small_cohort_filters_facts_before_the_aggregate(spark, name):
    lines = plan(QUERIES[name](spark, SF_DIR), optimized=True)
    semi = next(i for i, line in enumerate(lines) if "LeftSemi" in line)
    assert any("Aggregate" in line for line in lines[:semi])


def test_large_cohort_never_shuffles_facts(spark):
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        lines = plan(QUERIES["stay_metrics"](spark, SF_DIR))
        combined = next(i for i, line in enumerate(lines) if "partial_max" in line)
        assert next(i for i, line in enumerate(lines) if "LeftSemi" in line) < combined
        scan = next(i for i, line in enumerate(lines) if "FileScan" in line)
        exchange = max(i for i, line in enumerate(lines[:scan]) if "Exchange" in line)
        # between the fact scan and its exchange the rows are combined
        assert any("partial_max" in line for line in lines[exchange:scan])


def test_one_exchange_for_all_stay_metrics(spark):
    lines = plan(QUERIES["worst_row_struct"](spark, SF_DIR))
    assert sum("Exchange" in line for line in lines) == 1


def test_windows_keep_one_row_per_stay_before_the_shuffle(spark):
    lines = plan(worst_row_by_window(t.sofa(spark, SF_DIR), ORGANS[0]))
    assert order_of(lines, "WindowGroupLimit", "Exchange") == ["WindowGroupLimit", "Exchange", "WindowGroupLimit"]


def test_filters_and_columns_reach_the_scan(spark):
    text = "\n".join(plan(QUERIES["cohort_semi_join"](spark, SF_DIR)))
    assert "o_totalprice" not in text and "In(o_orderpriority" in text


@pytest.mark.parametrize("name", ["keyword_label", "label_cascade", "label_null_if_empty", "chunks"])
def test_keyword_labels_need_no_shuffle(spark, name):
    assert not any("Exchange" in line for line in plan(QUERIES[name](spark, SF_DIR)))


def session(master, **settings):
    """Just what the folder depends on."""
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
    return SimpleNamespace(conf=SimpleNamespace(get=settings.get), sparkContext=context)


def test_shared_folder_follows_the_session():
    named = session("spark://host", **{"spark.checkpoint.dir": "s3a://bucket/shared/"})
    assert shared_folder(named) == "s3a://bucket/shared"
    with pytest.raises(ValueError, match="shared by all executors"):
        shared_folder(session("spark://host"))


def test_materialized_tables_are_written(spark):
    table = materialize(spark.range(3).toDF("x"), "numbers")
    assert sorted(r["x"] for r in table.collect()) == [0, 1, 2]
    assert all("/numbers-" in f and shared_folder(spark).removeprefix("file:").lstrip("/") in f for f in table.inputFiles())
    assert not any("Range" in line for line in plan(table))


def test_frame_shuffles_lines_and_not_forty_aggregates_of_each_order(spark, tmp_path):
    lines = [
        # key, quantity, price, discount, tax, line, flag, status
        (1, 10.0, 1050.0, 0.05, 0.02, 1, "R", "F"),
        (1, 46.0, 99000.0, 0.10, 0.08, 4, "N", "O"),
        (1, None, None, None, None, 2, None, None),
        (2, 3.0, 500.0, 0.0, 0.0, 3, "A", "O"),
        (None, 50.0, 1.0, 0.1, 0.1, 1, "R", "F"),
    ]
    kinds = "double, l_extendedprice double, l_discount double, l_tax double, l_linenumber int"
    schema = f"l_orderkey long, l_quantity {kinds}, l_returnflag string, l_linestatus string"
    spark.createDataFrame(lines, schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = [(k, "1-URGENT", "O", 1000.0) for k in (1, 2, 2, 3, None)]
    order_schema = "o_orderkey long, o_orderpriority string, o_orderstatus string, o_totalprice double"
    spark.createDataFrame(orders, order_schema).write.parquet(f"{tmp_path}/orders.parquet")
    frame = t.frame(spark, str(tmp_path))
    first, *copies, bare, unknown = frame.orderBy(F.col("hadm_id").asc_nulls_last()).collect()
    assert [r["hadm_id"] for r in (first, *copies, bare, unknown)] == [1, 2, 2, 3, None] and copies[0] == copies[1]
    assert [first[c] for c in X_CONTINUOUS[:5]] == [46.0, 28.0, 7.5, 5.0, 500.0]
    assert [first[c] for c in X_BINARY] == [1, 0, 1, 1, 1, 1]
    assert bare[X_CONTINUOUS[0]] is None and unknown[X_CONTINUOUS[0]] is None and unknown[X_CONTINUOUS[-1]] == 0.0
    plan = frame._jdf.queryExecution().executedPlan().toString().splitlines()
    partial = next(i for i, line in enumerate(plan) if "partial_avg" in line)
    final = max(i for i, line in enumerate(plan[:partial]) if "Aggregate" in line)
    assert not any("Exchange" in line for line in plan[final:partial])
    assert any("Exchange" in line for line in plan[partial:])


def test_frame_tasks_follow_the_rows_and_not_the_shuffled_bytes(spark, tmp_path, monkeypatch):
    ids = spark.range(800)
    ids.select(
        (F.col("id") % 200).alias("l_orderkey"),
        *(F.lit(1.0).alias(f"l_{c}") for c in ("quantity", "extendedprice", "discount", "tax")),
        (F.floor(F.col("id") / 200) + 1).cast("int").alias("l_linenumber"),
        F.lit("R").alias("l_returnflag"),
        F.lit("F").alias("l_linestatus"),
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    ids.where("id < 200").selectExpr(
        "id o_orderkey", "'5-LOW' o_orderpriority", "'O' o_orderstatus", "1000.0D o_totalprice"
    ).write.parquet(f"{tmp_path}/orders.parquet")

    def tasks_and_rows() -> tuple[int, list]:
        with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
            rows = t.frame(spark, str(tmp_path)).withColumn("task", F.spark_partition_id()).orderBy("hadm_id").collect()
        return len({r["task"] for r in rows}), [r[:-1] for r in rows]

    tasks, rows = tasks_and_rows()
    assert tasks <= 4 and len(rows) == 200
    monkeypatch.setattr(t, "ROWS_PER_TASK", 100, raising=False)
    assert tasks_and_rows() == (11, rows)
