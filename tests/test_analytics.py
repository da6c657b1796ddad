"""Statistics, preparation, scoring, metrics, interventions and fits against NumPy."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wardframe.fixed_values import (
    C_BINARY,
    C_CONTINUOUS,
    C_TEXT,
    CONCEPT_LOSS_WEIGHT,
    JOINT_WEIGHT_DECAY,
    KEY,
    LABEL,
    X_BINARY,
    X_CONTINUOUS,
)
from wardframe.operators import fitting, metrics, prepare, sums
from wardframe.operators import interventions as what_if
from wardframe.operators.correlation import correlation_matrix
from wardframe.operators.scoring import (
    ALL_CONCEPTS,
    CONCEPTS,
    FEATURES,
    ConceptModel,
    LabelModel,
    load_weights,
    save_weights,
    score_model,
)
from wardframe.operators.sums import as_blocks
from wardframe.operators.statistics import column_stats, summary_rows
from wardframe.operators.summaries import SummaryStore, summarise
from wardframe.plans.concept_study import BASE, CONTEXT, ConceptStudy
from wardframe.sources.readers import read_modelling_csv
from wardframe.sources.sinks import write_csv

ROWS = 600


@pytest.fixture(scope="module")
def raw():
    """Concepts that depend on features and a label that depends on both."""
    rng = np.random.default_rng(7)
    x = rng.gamma(2.0, 10.0, (ROWS, len(X_CONTINUOUS)))
    b = rng.integers(0, 2, (ROWS, len(X_BINARY)))
    c = x @ rng.uniform(0, 0.02, (len(X_CONTINUOUS), len(C_CONTINUOUS))) + rng.normal(0, 0.5, (ROWS, len(C_CONTINUOUS)))
    kinds = b.sum(axis=1)
    text = rng.integers(0, 2, (ROWS, len(C_TEXT)))
    y = (c[:, 0] - c[:, 0].mean() + text[:, 0] * 2 - 1 + rng.normal(0, 0.5, ROWS) > 0).astype(int)
    df = pd.DataFrame(x, columns=X_CONTINUOUS)
    df[list(X_BINARY)] = b
    df[list(C_CONTINUOUS)] = c
    df[C_BINARY[0]] = (kinds >= 4).astype(int)
    df[C_BINARY[1]] = ((kinds > 1) & (kinds < 4)).astype(int)
    df[list(C_TEXT)] = text
    df[LABEL] = y
    df.insert(0, KEY, np.arange(ROWS))
    holes = rng.random((ROWS, len(X_CONTINUOUS))) < 0.1
    df[list(X_CONTINUOUS)] = df[list(X_CONTINUOUS)].mask(holes)
    df[X_CONTINUOUS[3]] = 5.0  # a constant column
    return df


@pytest.fixture(scope="module")
def frame(spark, raw):
    types = {**{c: "double" for c in (*X_CONTINUOUS, *C_CONTINUOUS)}, KEY: "long"}
    schema = ", ".join(f"{c} {types.get(c, 'int')}" for c in raw.columns)
    rows = [tuple(None if isinstance(v, float) and math.isnan(v) else v for v in r) for r in raw.astype(object).to_numpy()]
    return spark.createDataFrame(rows, schema).repartition(5)


@pytest.fixture(scope="module")
def pandas_prepared(spark, raw):
    split = {r[KEY]: r["split"] for r in prepare.with_split(spark.range(ROWS).withColumnRenamed("id", KEY)).collect()}
    df = raw.assign(split=raw[KEY].map(split))
    train = df[df["split"] == "train"]
    for c in (*X_CONTINUOUS, *C_CONTINUOUS):
        low, high = train[c].min(), train[c].max()
        filled = df[c].fillna(train[c].median())
        df[c] = (filled - low) / (high - low) if high > low else 0.0
    return df


def sigmoid(z):
    return 1 / (1 + np.exp(-z))


def random_models(seed=3):
    rng = np.random.default_rng(seed)
    concepts = {c: dict(zip(FEATURES, rng.normal(0, 0.5, len(FEATURES)))) for c in CONCEPTS}
    base = ConceptModel(concepts, LabelModel(dict(zip(CONCEPTS, rng.normal(0, 1.0, len(CONCEPTS))))))
    context = ConceptModel(concepts, LabelModel(dict(zip(ALL_CONCEPTS, rng.normal(0, 0.6, len(ALL_CONCEPTS))))))
    return base, context


@pytest.fixture(scope="module")
def study(frame):
    return ConceptStudy.build(frame, *random_models())


@pytest.fixture(scope="module")
def scored(study):
    return study.scored.toPandas().sort_values(KEY).reset_index(drop=True)


# --- statistics -----------------------------------------------------------------


@pytest.mark.parametrize("size", [1, 2, 5, 1001, 300_000])
def test_exact_quantiles(spark, size):
    rng = np.random.default_rng(size)
    values = np.round(rng.lognormal(0, 2, size), 3)
    values[: size // 3] = 1.0  # a third of all rows share one value
    pdf = pd.DataFrame({"a": values, "b": np.where(rng.random(size) < 0.5, np.nan, values)})
    df = spark.createDataFrame(pdf).select("a", F.nanvl("b", F.lit(None).cast("double")).alias("b"))
    stats = column_stats(df.repartition(7), ["a", "b"], (0.0, 0.25, 0.5, 0.9, 1.0))
    for c in ("a", "b"):
        kept = pdf[c].dropna()
        assert stats[c].count == len(kept)
        for q, found in stats[c].quantiles.items():
            assert (found is None) == kept.empty
            if found is not None:
                assert found == pytest.approx(kept.quantile(q), rel=1e-12)


def test_empty_split(spark):
    stats = column_stats(spark.createDataFrame([], "a double"), ["a"])
    assert stats["a"].count == 0 and stats["a"].median is None


@pytest.mark.parametrize("size", [0, 1, 3, 1001, 200_000])
def test_summaries_of_parts(spark, tmp_path, size):
    rng = np.random.default_rng(size)
    values = np.round(rng.lognormal(0, 2, size), 3) + 1e6
    values[: size // 3] = 1.0
    pdf = pd.DataFrame({"a": values, "b": np.where(rng.random(size) < 0.5, np.nan, values), "part": np.arange(size) % 3})
    df = spark.createDataFrame(pdf, "a double, b double, part long").withColumn("feature", F.lit("clash"))
    df = df.withColumn("c", F.lit(None).cast("double")).repartition(5)
    store = SummaryStore(spark, str(tmp_path / "kept"), ["a", "b", "c"])
    for part in (0, 1, 2, 1):
        store.add(f"p{part}", df.where(F.col("part") == part))
    stats = store.stats(df, (0.0, 0.25, 0.5, 1.0))
    assert stats["c"].count == 0 and stats["c"].mean is None and stats["c"].median is None
    for c in ("a", "b"):
        kept, found = pdf[c].dropna(), stats[c]
        assert found.count == len(kept)
        if kept.empty:
            assert found.low is None and found.median is None
            continue
        assert found.mean == pytest.approx(kept.mean(), rel=1e-12)
        assert (found.low, found.high) == (kept.min(), kept.max())
        assert found.std == (pytest.approx(kept.std(), rel=1e-9) if len(kept) > 1 else None)
        for q, at in found.quantiles.items():
            assert at == pytest.approx(kept.quantile(q), rel=1e-12)


def test_adding_a_part_reads_that_part_only(spark, tmp_path):
    df = spark.range(100).selectExpr("id % 2 AS part", "id * 1.5 AS a", "id AS other")
    df.write.partitionBy("part").parquet(str(tmp_path / "table"))
    table = spark.read.parquet(str(tmp_path / "table"))
    plan = summarise(table.where("part = 1"), ["a"])._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan.split("HashAggregate")[-1] and "PartitionFilters: [isnotnull(part" in plan
    assert "other" not in plan
    with pytest.raises(ValueError, match="name"):
        SummaryStore(spark, str(tmp_path / "kept"), ["a"]).add("../x", table)


def test_summary(frame, raw):
    rows = {r["feature"]: r for r in summary_rows(frame, X_CONTINUOUS[:3]).collect()}
    expected = raw[list(X_CONTINUOUS[:3])].describe()
    for c, row in rows.items():
        assert list(row)[1:] == pytest.approx(expected[c].tolist())


def test_correlation(study, scored):
    matrix = correlation_matrix(study.scored, ALL_CONCEPTS)
    expected = np.corrcoef(scored[list(ALL_CONCEPTS)].to_numpy(float), rowvar=False)
    found = np.array([[matrix[a, b] for b in ALL_CONCEPTS] for a in ALL_CONCEPTS])
    assert found == pytest.approx(expected, abs=1e-10)


def test_constant_column_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 0.1), (2.0, 0.1), (4.0, 0.1)], "a double, b double")
    matrix = correlation_matrix(df, ["a", "b"])
    assert matrix["a", "a"] == pytest.approx(1.0) and matrix["a", "b"] is None and matrix["b", "b"] is None


# --- preparation -------------------------------------------------------------------


def test_split_is_a_stable_partition(frame):
    one = prepare.with_split(frame).select(KEY, "split").collect()
    two = prepare.with_split(frame.repartition(2)).select(KEY, "split").collect()
    assert sorted(one) == sorted(two) and len(one) == ROWS
    shares = pd.Series([r["split"] for r in one]).value_counts(normalize=True)
    assert shares["train"] == pytest.approx(0.6, abs=0.08)


def test_preparation(frame, pandas_prepared):
    ready, stats = prepare.prepared(frame)
    found = ready.toPandas().sort_values(KEY).reset_index(drop=True)
    columns = [*X_CONTINUOUS, *C_CONTINUOUS]
    assert found[columns].to_numpy() == pytest.approx(pandas_prepared[columns].to_numpy(), abs=1e-12)
    assert (found[X_CONTINUOUS[3]] == 0).all()
    assert found[columns].max().max() > 1  # values beyond the training range are not clipped
    back = prepare.restored(ready, stats, {c: c for c in columns}).toPandas().sort_values(KEY)
    filled = prepare.imputed(prepare.with_split(frame), stats).toPandas().sort_values(KEY)
    assert back[columns].to_numpy() == pytest.approx(filled[columns].to_numpy())


def test_column_empty_in_training(spark, frame):
    holed = frame.withColumn(X_CONTINUOUS[0], F.lit(None).cast("double"))
    ready, _ = prepare.prepared(holed)
    assert ready.where(F.col(X_CONTINUOUS[0]).isNotNull()).count() == 0


def test_modelling_csv(spark, frame, tmp_path):
    own = prepare.modelling_frame(frame)
    write_csv(own, str(tmp_path / "frame"))
    back = read_modelling_csv(spark, str(tmp_path / "frame"))
    assert back.dtypes == own.dtypes and sorted(back.collect()) == sorted(own.collect())


def test_modelling_frame_without_labels(frame):
    labels = frame.where(f"{KEY} < 10").select(KEY, *(F.lit(1).alias(c) for c in C_TEXT))
    rows = prepare.modelling_frame(frame.drop(*C_TEXT), labels).orderBy(KEY).collect()
    assert [r[C_TEXT[0]] for r in rows[:12]] == [1] * 10 + [0, 0]


# --- scoring and metrics --------------------------------------------------------------


def test_scores(study, scored):
    base, context = random_models()
    x = scored[list(FEATURES)].to_numpy(float)
    for model, prefix, name in ((base, BASE, "base_prob"), (context, CONTEXT, "context_prob")):
        raw = {c: x @ np.array(list(w.values())) for c, w in model.concepts.items()}
        predicted = {c: sigmoid(z) if c in C_BINARY else z for c, z in raw.items()}
        values = {**predicted, **{c: scored[c] for c in C_TEXT}}
        for c in CONCEPTS:
            assert scored[prefix + c].to_numpy() == pytest.approx(predicted[c])
        logit = sum(w * values[c] for c, w in model.label.weights.items())
        assert scored[name].to_numpy() == pytest.approx(np.asarray(sigmoid(logit)))


def test_weights_survive_saving(spark, study, tmp_path):
    base, context = random_models()
    plain = LabelModel({"a": 0.25})
    save_weights(spark, str(tmp_path / "w"), {"base": base, "context": context, "plain": plain})
    loaded = load_weights(spark, str(tmp_path / "w"))
    assert loaded["plain"] == plain
    assert {c: dict(w) for c, w in loaded["base"].concepts.items()} == {c: dict(w) for c, w in base.concepts.items()}
    assert dict(loaded["context"].label.weights) == dict(context.label.weights)


@pytest.fixture(scope="module")
def edge(spark):
    rows = [(1, 0.5), (0, 0.5), (1, 0.9), (0, 0.1), (1, 0.2), (1, 0.7)]
    return spark.createDataFrame(rows, "y int, p double")


def test_cut_differs_between_metrics_and_information(edge):
    row = metrics.label_metrics(edge, "y", "p").first()
    # 0.5 is not above the cut: two true positives, two misses, two true negatives
    assert (row["precision"], row["recall"], row["accuracy"]) == (1.0, 0.5, 4 / 6)
    assert row["f1"] == pytest.approx(2 / 3) and row["auc"] == pytest.approx(0.75)
    counts = {(r["y"], r["predicted"]): r["n"] for r in metrics.confusion_counts(edge, "y", "p").collect()}
    assert counts == {(1, 1): 3, (1, 0): 1, (0, 1): 1, (0, 0): 1}
    outcomes = edge.select(metrics.outcome(F.col("y"), F.col("p")).alias("o")).collect()
    assert [r["o"] for r in outcomes] == ["TP", "FP", "TP", "TN", "FN", "TP"]


def information(y, p):
    total, value = len(y), 0.0
    for a in (0, 1):
        for b in (0, 1):
            n = np.sum((y == a) & (p == b))
            if n:
                value += n / total * math.log(n * total / (np.sum(y == a) * np.sum(p == b)))
    return value


def test_information(edge, spark):
    found = metrics.mutual_information(edge, "y", "p").first()[0]
    y, p = np.array([1, 0, 1, 0, 1, 1]), np.array([1, 1, 1, 0, 0, 1])
    assert found == pytest.approx(information(y, p), abs=1e-6) and found >= 0
    constant = spark.createDataFrame([(1, 0.9), (0, 0.9)], "y int, p double")
    assert metrics.mutual_information(constant, "y", "p").first()[0] == 0.0


def test_no_positive_prediction(spark):
    df = spark.createDataFrame([(1, 0.1), (0, 0.2)], "y int, p double")
    row = metrics.label_metrics(df, "y", "p").first()
    assert (row["precision"], row["recall"], row["f1"]) == (0.0, 0.0, 0.0)
    table = metrics.completeness_table(df, "y", {"m": "p"}).first()
    assert table["model"] == "m" and table["accuracy"] == 0.5 and table["mutual_information"] == 0.0


def test_concept_metrics(study, scored):
    pairs = {c: (c, BASE + c) for c in C_CONTINUOUS}
    for row in metrics.continuous_concept_metrics(study.scored, pairs).collect():
        c = row["concept"]
        miss = scored[c] - scored[BASE + c]
        mse = (miss**2).mean()
        assert row["mse"] == pytest.approx(mse, abs=6e-4) and row["mae"] == pytest.approx(miss.abs().mean(), abs=6e-4)
        assert row["r2"] == pytest.approx(1 - mse / scored[c].var(ddof=0), abs=6e-4)
    for row in metrics.binary_concept_metrics(study.scored, {c: (c, BASE + c) for c in C_BINARY}).collect():
        truth, hard = scored[row["concept"]], scored[BASE + row["concept"]] > 0.5
        assert row["accuracy"] == pytest.approx((truth == hard).mean(), abs=6e-4)


def test_outcome_difference_and_comparison(study, scored):
    found = metrics.outcome_difference(study.scored, KEY, "context_outcome", "base_outcome").collect()
    wrong = scored[scored["context_outcome"].isin(["FN", "FP"]) & (scored["context_outcome"] != scored["base_outcome"])]
    assert sorted((r[KEY], r["outcome"]) for r in found) == sorted(zip(wrong[KEY], wrong["context_outcome"]))
    cases = metrics.case_comparison(study.scored, KEY, "base_outcome", "context_outcome", ["base_prob"]).collect()
    right = scored[["base_outcome", "context_outcome"]].isin(["TP", "TN"])
    assert len(cases) == (right["base_outcome"] != right["context_outcome"]).sum()


# --- interventions -----------------------------------------------------------------------


def brute_force(scored, label, prefix, item, values, matrix, outcome):
    """Row by row: copy the concepts, replace the leads, move the followers, rescore."""
    corrected = total = 0
    for _, row in scored[scored[outcome] == item.outcome].iterrows():
        now = {c: row[c] if c in C_TEXT else row[prefix + c] for c in ALL_CONCEPTS}
        new = dict(now)
        for c in item.concepts:
            if c in C_TEXT and item.kind in ("truth", "const"):
                new[c] = 1.0 if item.outcome == "FN" else 0.0
            else:
                new[c] = row[c] if item.kind == "truth" else values[c]
        for c in item.follow:
            if c not in item.concepts:
                new[c] = now[c] + item.sign * sum(matrix[lead, c] * (now[lead] - new[lead]) for lead in item.concepts)
        p = sigmoid(sum(w * new[c] for c, w in label.weights.items()))
        hit = p >= 0.5 if item.outcome == "FN" else (p <= 0.5 if item.inclusive else p < 0.5)
        corrected += bool(hit)
        total += 1
    return corrected, total


FAMILIES = [
    (what_if.base_binary, False, BASE, False),
    (what_if.base_continuous, False, BASE, False),
    (what_if.context_continuous, True, CONTEXT, False),
    (what_if.text_concepts, True, CONTEXT, False),
    (what_if.all_kinds, True, CONTEXT, False),
    (what_if.led_by_concept, True, BASE, True),
    (what_if.led_by_text, True, BASE, True),
    (what_if.led_by_several, True, BASE, True),
    (what_if.led_in_base, False, BASE, True),
]


@pytest.mark.parametrize("kind", ["truth", "mean", "median"])
@pytest.mark.parametrize("make,enhanced,prefix,correlated", FAMILIES)
def test_interventions_match_row_by_row(study, scored, kind, make, enhanced, prefix, correlated):
    if make is what_if.text_concepts and kind == "truth":
        kind = "const"
    items = make(kind)
    outcome = "context_outcome" if enhanced else "base_outcome"
    setting = study.setting(enhanced, kind, prefix, correlated)
    found = [tuple(r)[:4] for r in what_if.correction_counts(study.scored, items, setting, outcome).collect()]
    concepts = scored[list(ALL_CONCEPTS)].astype(float)
    values = concepts.mean() if kind == "mean" else concepts.median()
    correlation = np.corrcoef(concepts.to_numpy(), rowvar=False)
    matrix = {(a, b): correlation[i, j] for i, a in enumerate(ALL_CONCEPTS) for j, b in enumerate(ALL_CONCEPTS)}
    expected = [
        (i.name, i.outcome, *brute_force(scored, setting.label, prefix, i, values, matrix, outcome)) for i in items
    ]
    assert found == expected


def test_replacing_by_the_prediction_changes_nothing(study):
    same = study.scored.withColumns({c: F.col(BASE + c) for c in CONCEPTS})
    rows = what_if.correction_counts(same, what_if.base_continuous("truth"), study.setting(False, "truth"), "base_outcome")
    assert {r["corrected"] for r in rows.collect()} == {0}


def test_no_errors_to_correct(study):
    right = study.scored.where(F.col("base_outcome").isin("TP", "TN"))
    rows = what_if.correction_counts(right, what_if.base_binary("truth"), study.setting(False, "truth"), "base_outcome")
    assert {(r["corrected"], r["total"], r["ratio"]) for r in rows.collect()} == {(0, 0, None)}


def test_replacement_values_of_another_split(study, pandas_prepared):
    train = pandas_prepared[pandas_prepared["split"] == "train"]
    values = study.replacements("mean", stats_from="train")
    assert values[C_CONTINUOUS[0]] == pytest.approx(train[C_CONTINUOUS[0]].mean())


def test_flip_listing(study, scored):
    setting = study.setting(True, "truth")
    listed = what_if.flip_listing(study.scored, KEY, what_if.single_flips(), setting, "context_outcome").collect()
    counts = what_if.correction_counts(study.scored, what_if.single_flips(), setting, "context_outcome").collect()
    assert len(listed) == sum(r["corrected"] for r in counts)
    wrong = set(scored[scored["context_outcome"].isin(["FN", "FP"])][KEY])
    assert {r[KEY] for r in listed} <= wrong


def test_case_profile(study, scored):
    values = {"a": ("feature", X_CONTINUOUS[0], None), C_CONTINUOUS[0]: ("concept", C_CONTINUOUS[0], BASE + C_CONTINUOUS[0])}
    key = int(scored[KEY][0])
    rows = metrics.case_profile(study.scored.where(F.col(KEY) == key), KEY, values).collect()
    assert [(r["name"], r["predicted"] is None) for r in rows] == [("a", True), (C_CONTINUOUS[0], False)]


# --- fits ----------------------------------------------------------------------------------


def arrays(pandas_prepared, split="train"):
    df = pandas_prepared[pandas_prepared["split"] == split]
    return tuple(df[list(c)].to_numpy(float) for c in (FEATURES, CONCEPTS, C_TEXT)) + (df[LABEL].to_numpy(float),)


def test_logistic_fit_is_stationary(frame, pandas_prepared):
    model = fitting.fit_logistic(prepare.prepared(frame)[0])
    x, _, _, y = arrays(pandas_prepared)
    w = np.array([model.weights[f] for f in FEATURES])
    gradient = x.T @ (sigmoid(x @ w) - y) / len(y) + 1e-4 * w
    assert np.abs(gradient).max() < 1e-4


def test_sequential_fit(frame, pandas_prepared):
    ready, _ = prepare.prepared(frame)
    model = fitting.fit_sequential(ready, with_text=True)
    x, c, _, _ = arrays(pandas_prepared)
    continuous = len(C_CONTINUOUS)
    w = np.array([[model.concepts[name][f] for name in C_CONTINUOUS] for f in FEATURES])
    gradient = 2 * x.T @ (x @ w - c[:, :continuous]) / (len(x) * continuous) + 1e-3 * w
    assert np.abs(gradient).max() < 1e-9
    assert tuple(model.label.weights) == ALL_CONCEPTS
    scored = score_model(ready.where("split = 'train'"), model, "p_", "prob")
    assert metrics.label_metrics(scored, LABEL, "prob").first()["accuracy"] > 0.8


def test_label_from_concepts(frame):
    ready, _ = prepare.prepared(frame)
    true = fitting.fit_label_from_concepts(ready)
    predicted = fitting.fit_label_from_concepts(ready, random_models()[0], with_text=True)
    assert tuple(true.weights) == CONCEPTS and tuple(predicted.weights) == ALL_CONCEPTS


def test_joint_gradient_matches_differences(pandas_prepared):
    x, c, s, y = (a[:40] for a in arrays(pandas_prepared))
    weights = fitting.Weights.start(len(C_TEXT))
    _, gradient = fitting.batch_sums(x, c, s, y, weights)
    flat = weights.flat()
    for i in (0, 20, 100, 250, 290, 294, 300, 308, 315):
        low, high = flat.copy(), flat.copy()
        low[i] -= 1e-6
        high[i] += 1e-6
        losses = [fitting.batch_sums(x, c, s, y, fitting.Weights.from_flat(v, len(C_TEXT)))[0] for v in (low, high)]
        assert gradient[i] == pytest.approx((losses[1] - losses[0]) / 2e-6, rel=1e-4, abs=1e-4)


def test_joint_step_adds_up_over_tasks(frame, pandas_prepared):
    ready, _ = prepare.prepared(frame)
    weights = fitting.Weights.start(len(C_TEXT))
    columns = [F.col(c).cast("double") for c in (*FEATURES, *CONCEPTS, *C_TEXT, LABEL)]
    rows = ready.where("split <> 'test'").select(*columns, (F.col("split") == "train").cast("double").alias("t"))
    step = fitting.joint_step(as_blocks(rows), weights, C_TEXT, curvature=True)
    for split, found in (("train", step.train_loss), ("validation", step.valid_loss)):
        data = arrays(pandas_prepared, split)
        loss, expected = fitting.batch_sums(*data, weights)
        assert found == pytest.approx(loss / len(data[3]))
        if split == "train":
            assert step.gradient == pytest.approx(expected / len(data[3]), abs=1e-12)
            whole = fitting.batch_curvature(data[0], data[2], weights) / len(data[3])
            assert step.curvature == pytest.approx(whole, abs=1e-12)
    assert fitting.joint_step(as_blocks(rows), weights, C_TEXT).curvature is None


def test_curvature_is_that_of_outputs_taken_as_linear(pandas_prepared):
    """By differences: the slopes of the losses in the outputs stay, the outputs follow their tangent."""
    x, c, s, y = (a[:30] for a in arrays(pandas_prepared))
    w = fitting.Weights.start(len(C_TEXT))
    binary = np.arange(len(CONCEPTS)) >= len(C_CONTINUOUS)

    def outputs(flat):
        at = fitting.Weights.from_flat(flat, len(C_TEXT))
        raw = x @ at.concept
        concepts = np.where(binary, 1 / (1 + np.exp(-raw)), raw)
        return np.concatenate([raw, (concepts @ at.label + s @ at.text)[:, None]], axis=1).ravel()

    flat = w.flat()
    tangent = np.column_stack(
        [(outputs(flat + e) - outputs(flat - e)) / 2e-6 for e in 1e-6 * np.eye(flat.size)]
    )
    out = outputs(flat).reshape(len(x), -1)
    p = 1 / (1 + np.exp(-out))
    share = np.where(binary, 1 / len(C_BINARY), 2 / len(C_CONTINUOUS)) * CONCEPT_LOSS_WEIGHT
    bend = np.concatenate([share * np.where(binary, p[:, :-1] * (1 - p[:, :-1]), 1), (p * (1 - p))[:, -1:]], axis=1)
    expected = tangent.T @ (bend.ravel()[:, None] * tangent)
    assert fitting.batch_curvature(x, s, w) == pytest.approx(expected, rel=1e-4, abs=1e-4)


def test_a_joint_pass_adds_up_few_numbers(frame, monkeypatch):
    """The curvature's 316 x 316 cells come from sums over some seventy columns, not from a sum of each cell."""
    sizes, whole = [], fitting.block_totals
    monkeypatch.setattr(fitting, "block_totals", lambda b, width, size, f: sizes.append(size) or whole(b, width, size, f))
    ready, _ = prepare.prepared(frame)
    weights = fitting.Weights.start(len(C_TEXT))
    with fitting._kept(fitting._joint_rows(ready, C_TEXT)) as blocks:
        step = fitting.joint_step(blocks, weights, C_TEXT, curvature=True)
    assert step.curvature.shape == (316, 316) and sizes[0] < 5_000


@pytest.mark.parametrize("text", [0, 8])
def test_curvature_equals_that_of_written_out_lines(text):
    rng = np.random.default_rng(5)
    x, s = rng.normal(size=(50, len(FEATURES))), rng.normal(size=(50, text))
    w = fitting.Weights.start(text)
    raw = x @ w.concept
    binary = np.arange(len(CONCEPTS)) >= len(C_CONTINUOUS)
    made = np.where(binary, sigmoid(raw), raw)
    slope = np.where(binary, made * (1 - made), 1.0)
    p = sigmoid(made @ w.label + s @ w.text)
    lines = np.concatenate([(x[:, :, None] * (slope * w.label)[:, None, :]).reshape(50, -1), made, s], axis=1)
    expected = (lines * (p * (1 - p))[:, None]).T @ lines
    for k in range(len(CONCEPTS)):
        own = np.arange(len(FEATURES)) * len(CONCEPTS) + k
        share = CONCEPT_LOSS_WEIGHT * (1 / len(C_BINARY) if binary[k] else 2 / len(C_CONTINUOUS))
        expected[np.ix_(own, own)] += share * (x * slope[:, [k]]).T @ x
    assert fitting.batch_curvature(x, s, w) == pytest.approx(expected, rel=1e-9, abs=1e-9)


def test_blocks_reach_python_a_few_megabytes_at_a_time(spark):
    cells = spark.range(0, 40, 1, 1).select(F.expr("cast(repeat('x', 1000000) as binary)").alias("block"))

    def batches_seen(batches):
        for _ in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([0], pa.int64()), pa.array([[1.0]], pa.list_(pa.float64()))], names=["place", "part"]
            )

    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None)
    assert sums._added(cells.mapInArrow(batches_seen, sums._PARTS), 1)[0] >= 4
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) == before


def test_joint_fit_beats_a_hundred_gradient_steps(frame, pandas_prepared):
    ready, _ = prepare.prepared(frame)
    fit = fitting.fit_joint(ready, with_text=True)
    train, valid = arrays(pandas_prepared), arrays(pandas_prepared, "validation")
    values = fitting.Weights.start(len(C_TEXT)).flat()
    first, second, lowest = np.zeros_like(values), np.zeros_like(values), np.inf
    for epoch in range(1, 101):  # Adam
        at = fitting.Weights.from_flat(values, len(C_TEXT))
        lowest = min(lowest, fitting.batch_sums(*valid, at)[0] / len(valid[3]))
        gradient = fitting.batch_sums(*train, at)[1] / len(train[3]) + JOINT_WEIGHT_DECAY * values
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient**2
        values = values - 0.3 * (first / (1 - 0.9**epoch)) / (np.sqrt(second / (1 - 0.999**epoch)) + 1e-8)
    assert min(fit.validation_losses) <= lowest + 1e-3
    assert len(fit.train_losses) <= 33
    assert tuple(fit.model.label.weights) == ALL_CONCEPTS
    # the weights that are kept are those of the lowest validation loss
    concept = np.array([[fit.model.concepts[c][f] for c in CONCEPTS] for f in FEATURES])
    label = [fit.model.label.weights[c] for c in ALL_CONCEPTS]
    kept = fitting.Weights(concept, np.array(label[: len(CONCEPTS)]), np.array(label[len(CONCEPTS) :]))
    assert fitting.batch_sums(*valid, kept)[0] / len(valid[3]) == pytest.approx(min(fit.validation_losses))


def test_sequential_slopes_are_those_of_the_losses(frame, pandas_prepared):
    """At weights away from the minimum, against plain NumPy."""
    ready, _ = prepare.prepared(frame)
    rng = np.random.default_rng(3)
    concept = {c: dict(zip(FEATURES, rng.normal(0, 0.3, len(FEATURES)), strict=True)) for c in CONCEPTS}
    model = ConceptModel(concept, LabelModel(dict(zip(ALL_CONCEPTS, rng.normal(0, 0.3, len(ALL_CONCEPTS)), strict=True))))
    found = fitting.sequential_slopes(ready, model, weight_decay=0.01)
    x, c, s, y = arrays(pandas_prepared)
    binary = np.array([name in C_BINARY for name in CONCEPTS])
    weights = np.array([[concept[n][f] for n in CONCEPTS] for f in FEATURES])
    raw = x @ weights
    made = np.where(binary, 1 / (1 + np.exp(-raw)), raw)
    pull, decay = np.where(binary, 1.0, 2 / len(C_CONTINUOUS)), np.where(binary, len(C_BINARY), 1) * 0.01
    expected = x.T @ (made - c) / len(y) * pull + decay * weights
    assert [[found[f, n] for n in CONCEPTS] for f in FEATURES] == pytest.approx(expected, abs=1e-9)
    into = np.concatenate([made, s], axis=1)
    label = np.array([model.label.weights[n] for n in ALL_CONCEPTS])
    error = 1 / (1 + np.exp(-into @ label)) - y
    assert [found[n, LABEL] for n in ALL_CONCEPTS] == pytest.approx(into.T @ error / len(y) + 0.01 * label, abs=1e-9)
