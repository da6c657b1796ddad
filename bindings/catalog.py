"""Every registered query: an operator bound to the test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindings import tables as t
from wardframe.fixed_values import (
    C_BINARY,
    C_CONTINUOUS,
    C_TEXT,
    CONCEPT_LABEL_WEIGHT_DECAY,
    KEY,
    LABEL,
    LOGISTIC_WEIGHT_DECAY,
    PROMPTS,
    TEXT_SOURCES,
    X_BINARY,
    X_CONTINUOUS,
    YES,
)
from wardframe.functions.measures import class_above, class_at_least
from wardframe.operators import fitting, labelling, metrics, prepare
from wardframe.operators import interventions as what_if
from wardframe.operators.classify import group_flags, split_codes
from wardframe.operators.code_rules import rule_flags
from wardframe.operators.correlation import correlation_long as correlations
from wardframe.operators.keys import first_per_key, first_rows
from wardframe.operators.label_many import label_into, label_many
from wardframe.operators.label_many import label_new as append_new_labels
from wardframe.operators.label_waves import label_in_waves
from wardframe.operators.note_parts import chunks_from_notes
from wardframe.operators.notes import ecg_by_patient, radiology_by_admission, report_texts
from wardframe.operators.ranks import ordered_slice
from wardframe.operators.scoring import (
    ALL_CONCEPTS,
    CONCEPTS,
    FEATURES,
    WEIGHTS_SCHEMA,
    load_weights,
    save_weights,
    score_label,
    score_model,
    weight_rows,
)
from wardframe.operators.statistics import QUARTILES, summary_rows, summary_table
from wardframe.operators.summaries import SummaryStore
from wardframe.operators.worst_row import ORGANS, stay_summary, worst_row_by_window
from wardframe.plans import cohort_features as features
from wardframe.plans.cohort_notes import cohort_notes, patient_reports
from wardframe.plans.concept_study import BASE, CONTEXT, ConceptStudy
from wardframe.session import shared_folder
from wardframe.sources.label_table import LabelTable
from wardframe.sources.readers import read_modelling_csv, read_notes_csv, read_parquet
from wardframe.sources.sinks import append_labels, write_csv

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- cohort features ------------------------------------------------------------


@query
def vent_duration(spark, sf_dir):
    return features.ventilation_minutes(t.cohort(spark, sf_dir), t.ventilation(spark, sf_dir)).select(
        "hadm_id", "stay_id", "mech_vent_duration_minutes"
    )


@query
def vasopressor_twa(spark, sf_dir):
    return features.vasopressor_doses(t.cohort(spark, sf_dir), t.vasopressor(spark, sf_dir)).select(
        "hadm_id", "stay_id", "avg_norepinephrine_equiv", "max_norepinephrine_equiv"
    )


@query
def code_split(spark, sf_dir):
    return split_codes(t.diagnoses(spark, sf_dir))


@query
def code_classifier(spark, sf_dir):
    return group_flags(split_codes(t.diagnoses(spark, sf_dir)))


@query
def code_classifier_rules(spark, sf_dir):
    """The same groups, and overlapping ones, from a table of rules."""
    return rule_flags(t.diagnoses(spark, sf_dir), t.code_rules(spark))


@query
def comorbidity_bands(spark, sf_dir):
    return features.comorbidities(t.cohort(spark, sf_dir), t.diagnoses(spark, sf_dir)).drop("stay_id", "subject_id", LABEL)


@query
def worst_row_struct(spark, sf_dir):
    return stay_summary(t.sofa(spark, sf_dir), first_day=False, averages=False)


@query
def first24_worst_struct(spark, sf_dir):
    return stay_summary(t.sofa(spark, sf_dir), worst=False, averages=False)


def _by_windows(spark, sf_dir, first_day):
    sofa = t.sofa(spark, sf_dir)
    result = sofa.select("stay_id").distinct()
    for organ in ORGANS:
        result = result.join(worst_row_by_window(sofa, organ, first_day), "stay_id", "left")
    return result


@query
def worst_row_window(spark, sf_dir):
    return _by_windows(spark, sf_dir, first_day=False)


@query
def first24_worst_window(spark, sf_dir):
    return _by_windows(spark, sf_dir, first_day=True)


@query
def stay_averages(spark, sf_dir):
    return stay_summary(t.sofa(spark, sf_dir), worst=False, first_day=False)


@query
def stay_metrics(spark, sf_dir):
    return features.score_metrics(t.cohort(spark, sf_dir), t.sofa(spark, sf_dir))


@query
def cohort_semi_join(spark, sf_dir):
    cohort = t.cohort(spark, sf_dir)
    return t.sofa(spark, sf_dir).join(cohort.select("stay_id"), "stay_id", "left_semi")


@query
def cohort_features(spark, sf_dir):
    return features.cohort_features(t.clinical_tables(spark, sf_dir))


@query
def cohort_features_unlabelled(spark, sf_dir):
    return features.cohort_features(t.clinical_tables(spark, sf_dir, labelled=False), label=None)


# --- notes -------------------------------------------------------------------------


@query
def wide_report_concat(spark, sf_dir):
    return report_texts(t.ecg(spark, sf_dir))


@query
def note_string_agg(spark, sf_dir):
    return radiology_by_admission(t.radiology(spark, sf_dir))


@query
def note_distinct_agg(spark, sf_dir):
    return ecg_by_patient(t.ecg(spark, sf_dir))


@query
def patient_level_notes(spark, sf_dir):
    return patient_reports(t.note_cohort(spark, sf_dir), t.ecg(spark, sf_dir))


@query
def notes_consolidated(spark, sf_dir):
    return cohort_notes(
        t.note_cohort(spark, sf_dir),
        t.discharge(spark, sf_dir),
        t.radiology(spark, sf_dir),
        t.ecg(spark, sf_dir),
    )


@query
def first_note_per_admission(spark, sf_dir):
    turns = t.table(spark, sf_dir, "conversations").select(F.col("conv_id").alias(KEY), "turn", "role", "text")
    return first_per_key(turns, KEY, ["turn"])


# --- text concepts -------------------------------------------------------------------


def _texts(spark, sf_dir):
    return t.long_notes(spark, sf_dir)


@query
def chunks(spark, sf_dir):
    return labelling.chunk_rows(_texts(spark, sf_dir), KEY, "discharge_text")


@query
def chunk_stats(spark, sf_dir):
    rows = labelling.chunk_rows(_texts(spark, sf_dir), KEY, "discharge_text")
    return rows.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("chunks"),
        F.sum(F.length("chunk")).alias("characters"),
        F.max(F.length("chunk")).alias("longest"),
    )


@query
def chunks_of_joined_notes(spark, sf_dir):
    """Small windows over all user turns of a conversation, joined in order."""
    turns = t.table(spark, sf_dir, "conversations").select(F.col("conv_id").alias(KEY), "turn", "text")
    return chunks_from_notes(turns, KEY, "turn", F.floor(F.col("turn") / 4), size=400, overlap=40)


@query
def prompt_column(spark, sf_dir):
    """The prompts of all eight concepts, each over the chunks of its first text."""
    notes = _texts(spark, sf_dir)
    parts = []
    for text in dict.fromkeys(t.first_source().values()):
        concepts = [c for c, source in t.first_source().items() if source == text]
        parts.append(labelling.prompt_rows(labelling.chunk_rows(notes, KEY, text), concepts))
    return reduce(DataFrame.unionByName, parts).select(KEY, "concept", "chunk_no", "prompt")


def _keyword_labels(spark, sf_dir, concept, text, null_if_empty=False):
    return labelling.keyword_label_text(_texts(spark, sf_dir), KEY, text, t.KEYWORDS[concept], null_if_empty)


@query
def keyword_label(spark, sf_dir):
    return _keyword_labels(spark, sf_dir, "ards_detected", "discharge_text").drop("explanation")


@query
def label_explanation(spark, sf_dir):
    return _keyword_labels(spark, sf_dir, "ards_detected", "discharge_text").select(KEY, "explanation")


@query
def label_null_if_empty(spark, sf_dir):
    concept = "bilateral_infiltrates_detected"
    return _keyword_labels(spark, sf_dir, concept, "radiology_texts", null_if_empty=True)


def _keyword_labeller(concept):
    words = t.KEYWORDS[concept]

    def make():
        def label(prompt: str) -> str:
            text = prompt.split("Text:\n", 1)[1].rsplit("\n\nQuery:", 1)[0]
            found = next((w for w in words if w in text), None)
            return f" {YES}: {found}\n" if found else "No "

        return label

    return make


@query
def label_callable(spark, sf_dir):
    """The keyword labeller as a user-supplied callable on each prompt."""
    concept = "ards_detected"
    return labelling.label_text(_texts(spark, sf_dir), KEY, "discharge_text", concept, _keyword_labeller(concept))


def _many_labeller():
    """The keyword labeller of every concept, on lists of prompts; a prompt tells its concept."""
    queries = {p.split("{text}")[1]: (c, p.split("{text}")) for c, p in PROMPTS.items()}
    words = t.KEYWORDS

    def label(prompts):
        answers = []
        for prompt in prompts:
            tail = next(q for q in queries if prompt.endswith(q))
            concept, (before, after) = queries[tail]
            text = prompt[len(before) : len(prompt) - len(after)]
            found = next((w for w in words[concept] if w in text), None)
            answers.append(f"{YES}: {found}" if found else "No")
        return answers

    return label


MANY = ("ards_detected", "trali_detected", "bilateral_infiltrates_detected")


@query
def label_callable_all(spark, sf_dir):
    """Several concepts of one text in one pass, by a labeller that takes lists of prompts."""
    texts = _texts(spark, sf_dir)
    return label_many(texts, KEY, "discharge_text", _many_labeller, MANY[:2]).drop("failed")


@query
def label_new(spark, sf_dir):
    """Two runs into one table: some admissions and one concept, then everything not known yet."""
    path = _fresh_path(spark, "labels-new")
    texts = _texts(spark, sf_dir)
    covered = t.table(spark, sf_dir, "labels").select(F.col("doc_id").alias(KEY))
    append_new_labels(texts.join(covered, KEY, "left_semi"), KEY, MANY[:1], _many_labeller, path)
    append_new_labels(texts, KEY, MANY, _many_labeller, path, parts=2)
    return read_parquet(spark, path).select(KEY, "concept", "text_length", "detected", "explanation")


@query
def label_waves(spark, sf_dir):
    """The callable's labels from as few calls as the waves allow, and their number."""
    concept = "ards_detected"
    return label_in_waves(_texts(spark, sf_dir), KEY, "discharge_text", concept, _keyword_labeller(concept))


@query
def label_table_new(spark, sf_dir):
    """Three appends to a bucketed label table, then everything that it does not hold yet."""
    texts = _texts(spark, sf_dir)
    table = _label_table(spark, "labels-bucketed")
    covered = t.table(spark, sf_dir, "labels").select(F.col("doc_id").alias(KEY))
    label_into(texts.join(covered, KEY, "left_semi"), KEY, MANY[:1], _many_labeller, table, "covered")
    label_into(texts.where(F.col(KEY) % 3 == 0), KEY, MANY[1:2], _many_labeller, table, "third")
    label_into(texts.where(F.col(KEY) % 2 == 0), KEY, MANY[2:], _many_labeller, table, "half")
    label_into(texts, KEY, MANY, _many_labeller, table, "rest")
    return table.rows()


@query
def label_cascade_callable(spark, sf_dir):
    """The second text is put to the labeller only where the first said no."""
    concept = "cardiac_failure_detected"
    return labelling.label_cascade(
        _texts(spark, sf_dir), KEY, TEXT_SOURCES[concept], concept, _keyword_labeller(concept)
    )


@query
def label_cascade(spark, sf_dir):
    words = t.KEYWORDS["cardiac_failure_detected"]
    return labelling.keyword_cascade(_texts(spark, sf_dir), KEY, TEXT_SOURCES["cardiac_failure_detected"], words)


def _all_labels(spark, sf_dir):
    """Long (key, concept, detected) for all concepts from one pass over the texts."""
    found = labelling.keyword_detections(_texts(spark, sf_dir), KEY, t.KEYWORDS)
    rows = [
        F.struct(F.lit(c).alias("concept"), F.when(F.col(c), "Yes").when(~F.col(c), "No").alias("detected"))
        for c in C_TEXT
    ]
    return found.select(KEY, F.inline(F.array(*rows)))


@query
def label_wide(spark, sf_dir):
    return labelling.label_wide(_all_labels(spark, sf_dir), KEY)


@query
def label_incremental(spark, sf_dir):
    """Label only the texts that the label table does not cover yet."""
    covered = t.table(spark, sf_dir, "labels").select(F.col("doc_id").alias(KEY))
    fresh = labelling.unseen(_texts(spark, sf_dir), covered, KEY)
    words = t.KEYWORDS["pneumonia_detected"]
    return labelling.keyword_label_text(fresh, KEY, "discharge_text", words).drop("explanation")


@query
def label_batch(spark, sf_dir):
    """A bounded batch for the labeller: so many admissions by key, from a start on."""
    lengths = _texts(spark, sf_dir).select(KEY, F.length("discharge_text").alias("text_length"))
    return first_rows(lengths, [KEY], rows=100, start=50)


@query
def label_batch_deep(spark, sf_dir):
    """A batch from the upper half of a long order: only the ranges that it reaches are read again."""
    orders = t.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias(KEY), F.col("o_orderdate").alias("written"))
    return ordered_slice(orders, [F.col("written"), F.col(KEY)], orders.count() // 4 * 3, 100)


# --- modelling frame -------------------------------------------------------------------


@query
def modelling_frame(spark, sf_dir):
    """Features with the text concepts of the label table joined on."""
    own = t.frame(spark, sf_dir).drop(*C_TEXT)
    return prepare.modelling_frame(own, labelling.label_wide(_all_labels(spark, sf_dir), KEY))


def _frame(spark, sf_dir):
    return t.written_frame(spark, sf_dir)


@query
def hash_split(spark, sf_dir):
    return prepare.with_split(_frame(spark, sf_dir)).select(KEY, prepare.SPLIT)


@query
def median_impute(spark, sf_dir):
    split = prepare.with_split(_frame(spark, sf_dir))
    filled = prepare.imputed(split, prepare.training_stats(split))
    return filled.select(KEY, prepare.SPLIT, *prepare.SCALED)


@query
def minmax_scale(spark, sf_dir):
    ready, _ = prepare.prepared(_frame(spark, sf_dir))
    return ready.select(KEY, prepare.SPLIT, *prepare.SCALED)


def _rounded_summary(rows):
    return rows.select(
        "feature", "count", *(F.round(c, 4).alias(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max"))
    )


@query
def describe(spark, sf_dir):
    return _rounded_summary(summary_rows(_frame(spark, sf_dir), [*X_CONTINUOUS, *C_CONTINUOUS]))


@query
def describe_parts(spark, sf_dir):
    """The same out of summaries of two parts kept in a folder, one of them added twice."""
    frame = _frame(spark, sf_dir)
    store = SummaryStore(spark, _fresh_path(spark, "summaries"), [*X_CONTINUOUS, *C_CONTINUOUS])
    for part in (0, 1, 0):
        store.add(f"part-{part}", frame.where(F.pmod(KEY, F.lit(2)) == part))
    return _rounded_summary(summary_table(spark, store.stats(frame, QUARTILES)))


@query
def correlation_long(spark, sf_dir):
    ready, _ = prepare.prepared(_frame(spark, sf_dir))
    long = correlations(ready.where(F.col(prepare.SPLIT) == "test"), ALL_CONCEPTS)
    return long.select("concept_a", "concept_b", F.round("r", 6).alias("r"))


# --- files: the label sink, the CSV sources and the weight table ----------------------


def _fresh_path(spark, name):
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query
def label_sink(spark, sf_dir):
    """Labels appended twice: first the covered texts, then all; none is added twice."""
    path = _fresh_path(spark, "labels")
    every = _keyword_labels(spark, sf_dir, "trali_detected", "discharge_text")
    covered = t.table(spark, sf_dir, "labels").select(F.col("doc_id").alias(KEY))
    append_labels(every.join(covered, KEY, "left_semi"), path)
    append_labels(every, path)
    return read_parquet(spark, path, every.schema)


@query
def label_sink_concepts(spark, sf_dir):
    """Labels of two concepts, with doubled rows, appended to one table one after the other."""
    path = _fresh_path(spark, "labels-long")
    for concept in MANY[:2]:
        labels = _keyword_labels(spark, sf_dir, concept, "discharge_text").withColumn("concept", F.lit(concept))
        append_labels(labels.unionByName(labels), path)
        append_labels(labels, path)
    return read_parquet(spark, path)


def _label_table(spark, name, kind=LabelTable):
    schema = spark.createDataFrame([], f"{KEY} long, concept string, text_length int, detected string, explanation string").schema
    return kind(spark, _fresh_path(spark, name), schema, buckets=8)


class _Overtaken(LabelTable):
    """A writer whose first commit comes after another one's."""

    before = None

    def _commit(self, entry):
        before, self.before = self.before, None
        if before:
            before(LabelTable(self.spark, self.path, self.schema, self.key, self.buckets))
        return super()._commit(entry)


@query
def label_table_batches(spark, sf_dir):
    """A batch that broke off and is repeated, one that is sent twice, and two writers at the same time."""
    one, two = (
        _keyword_labels(spark, sf_dir, c, "discharge_text").withColumn("concept", F.lit(c)) for c in MANY[:2]
    )
    table = _label_table(spark, "label-batches", _Overtaken)
    table.draft(one.select(*table.schema.fieldNames()).where(F.col(KEY) % 2 == 0))  # its writer died before the commit
    table.append(one.where(F.col(KEY) % 2 == 0), "even")
    table.append(one.where(F.col(KEY) % 2 == 0), "even")
    table.before = lambda other: other.append(two.unionByName(one.where(F.col(KEY) % 3 == 0)), "other")
    table.append(one.unionByName(two.where(F.col(KEY) % 5 == 0)), "all")
    table.compact()
    return table.rows()


@query
def notes_csv_source(spark, sf_dir):
    """Consolidated notes written and read as CSV, with line breaks and quotes inside."""
    path = _fresh_path(spark, "notes-csv")
    write_csv(notes_consolidated(spark, sf_dir), path)
    return read_notes_csv(spark, path)


@query
def modelling_csv_source(spark, sf_dir):
    path = _fresh_path(spark, "frame-csv")
    write_csv(_frame(spark, sf_dir), path)
    return read_modelling_csv(spark, path)


@query
def weights_roundtrip(spark, sf_dir):
    """The test rows scored with a model that was saved and loaded."""
    path = _fresh_path(spark, "weights")
    save_weights(spark, path, {"base": t.base_model(), "plain": t.plain_model()})
    model = load_weights(spark, path)["base"]
    rows = score_model(_test_rows(spark, sf_dir), model, BASE, "base_prob")
    return rows.select(KEY, LABEL, *_rounded("base_prob", *(BASE + c for c in CONCEPTS)))


# --- scoring and evaluation --------------------------------------------------------------


_studies: dict[tuple[str, str], ConceptStudy] = {}


def _study(spark, sf_dir):
    """Prepared and scored once per session and folder; its questions share it."""
    place = (spark.sparkContext.applicationId, sf_dir)
    if place not in _studies:
        _studies[place] = ConceptStudy.build(_frame(spark, sf_dir), t.base_model(), t.context_model())
    return _studies[place]


def _test_rows(spark, sf_dir):
    ready, _ = prepare.prepared(_frame(spark, sf_dir))
    return ready.where(F.col(prepare.SPLIT) == "test")


def _rounded(*names):
    return [F.round(n, 6).alias(n) for n in names]


@query
def score_logistic(spark, sf_dir):
    rows = _test_rows(spark, sf_dir)
    return score_label(rows, t.plain_model()).select(KEY, LABEL, *_rounded("y_prob"))


@query
def score_cbm(spark, sf_dir):
    rows = score_model(_test_rows(spark, sf_dir), t.base_model(), BASE, "base_prob")
    return rows.select(KEY, LABEL, *_rounded("base_prob", *(BASE + c for c in CONCEPTS)))


@query
def score_cbm_context(spark, sf_dir):
    rows = score_model(_test_rows(spark, sf_dir), t.context_model(), CONTEXT, "context_prob")
    return rows.select(KEY, LABEL, *_rounded("context_prob", *(CONTEXT + c for c in CONCEPTS)))


@query
def hard_class(spark, sf_dir):
    """Both cuts, over probabilities that hit one half exactly for many rows."""
    ratio = F.col("disc_step") / 10
    rows = t.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.round(F.col("l_discount") * 100).alias("disc_step")
    )
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        class_above(ratio).alias("above"),
        class_at_least(ratio).alias("at_least"),
    )


@query
def confusion_counts(spark, sf_dir):
    return metrics.confusion_counts(_study(spark, sf_dir).scored, LABEL, "base_prob")


@query
def label_metrics(spark, sf_dir):
    return metrics.label_metrics(_study(spark, sf_dir).scored, LABEL, "base_prob")


@query
def binary_concept_metrics(spark, sf_dir):
    return metrics.binary_concept_metrics(_study(spark, sf_dir).scored, {c: (c, BASE + c) for c in C_BINARY})


@query
def continuous_concept_metrics(spark, sf_dir):
    return metrics.continuous_concept_metrics(_study(spark, sf_dir).scored, {c: (c, BASE + c) for c in C_CONTINUOUS})


@query
def mutual_information(spark, sf_dir):
    return metrics.mutual_information(_study(spark, sf_dir).scored, LABEL, "context_prob")


@query
def outcome_tags(spark, sf_dir):
    return _study(spark, sf_dir).scored.select(KEY, "base_outcome", "context_outcome")


@query
def outcome_diff(spark, sf_dir):
    return metrics.outcome_difference(_study(spark, sf_dir).scored, KEY, "context_outcome", "base_outcome")


@query
def completeness_table(spark, sf_dir):
    """Seven models: features, both concept models, and the label from true or
    predicted concepts, without and with the text concepts."""
    scored = score_label(_study(spark, sf_dir).scored, t.plain_model(), "plain_prob")
    for name, seed, text, prefix in (
        ("true_c", 4, False, ""),
        ("true_c_text", 8, True, ""),
        ("pred_c", 4, False, BASE),
        ("pred_c_text", 8, True, CONTEXT),
    ):
        scored = score_label(scored, t.label_model(seed, text), name, prefix)
    models = {
        "plain": "plain_prob",
        "base": "base_prob",
        "context": "context_prob",
        **{n: n for n in ("true_c", "true_c_text", "pred_c", "pred_c_text")},
    }
    return metrics.completeness_table(scored, LABEL, models)


@query
def case_profile(spark, sf_dir):
    """Every test row's features and concepts in their own units."""
    study = _study(spark, sf_dir)
    columns = {c: c for c in (*X_CONTINUOUS, *C_CONTINUOUS)} | {BASE + c: c for c in C_CONTINUOUS}
    own = prepare.restored(study.scored, study.stats, columns)
    values = {c: ("feature", c, None) for c in (*X_CONTINUOUS, *X_BINARY)}
    values |= {c: ("concept", c, BASE + c) for c in CONCEPTS}
    values |= {c: ("text concept", c, None) for c in C_TEXT}
    return metrics.case_profile(own, KEY, values).select(KEY, "name", "kind", *_rounded("value", "predicted"))


@query
def case_compare(spark, sf_dir):
    scored = _study(spark, sf_dir).scored
    rows = metrics.case_comparison(scored, KEY, "base_outcome", "context_outcome", ["base_prob", "context_prob"])
    return rows.select(KEY, "verdict", *_rounded("base_prob", "context_prob"))


# --- interventions ------------------------------------------------------------------------

KINDS = ("truth", "mean", "median")

# name: (interventions by kind, enhanced model?, concepts predicted by, follow correlations?)
FAMILIES = {
    "intervene_base_binary": (what_if.base_binary, False, BASE, False),
    "intervene_base_cont": (what_if.base_continuous, False, BASE, False),
    "intervene_ctx_binary": (what_if.context_binary, True, CONTEXT, False),
    "intervene_ctx_cont": (what_if.context_continuous, True, CONTEXT, False),
    "intervene_text": (what_if.text_concepts, True, CONTEXT, False),
    "intervene_all": (what_if.all_kinds, True, CONTEXT, False),
    "propagate_concept": (what_if.led_by_concept, True, BASE, True),
    "propagate_text": (what_if.led_by_text, True, BASE, True),
    "propagate_multi": (what_if.led_by_several, True, BASE, True),
    "propagate_base": (what_if.led_in_base, False, BASE, True),
}


def family_kinds(family: str) -> tuple[str, ...]:
    return ("const", "mean", "median") if family.endswith("_text") else KINDS


def _intervention(family: str, kind: str) -> Query:
    make, enhanced, predicted_by, correlated = FAMILIES[family]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        study = _study(spark, sf_dir)
        setting = study.setting(enhanced, kind, predicted_by, correlated)
        outcome = "context_outcome" if enhanced else "base_outcome"
        return what_if.correction_counts(study.scored, make(kind), setting, outcome)

    return run


for _family in FAMILIES:
    for _kind in family_kinds(_family):
        QUERIES[f"{_family}_{_kind}"] = _intervention(_family, _kind)


@query
def flip_listing(spark, sf_dir):
    study = _study(spark, sf_dir)
    setting = study.setting(enhanced=True, kind="truth")
    rows = what_if.flip_listing(study.scored, KEY, what_if.single_flips(), setting, "context_outcome")
    return rows.select(KEY, "outcome", "intervention", *_rounded("new_prob"))


# --- fitting ------------------------------------------------------------------------------


def _prepared(spark, sf_dir):
    """Prepared frame of the session's study."""
    return _study(spark, sf_dir).frame


def _weights(spark, name, model):
    rows = spark.createDataFrame(weight_rows(name, model), WEIGHTS_SCHEMA)
    return rows.select("model", "layer", "src", "dst", F.round("w", 6).alias("w"))


@query
def fit_logistic(spark, sf_dir):
    return _weights(spark, "plain", fitting.fit_logistic(_prepared(spark, sf_dir)))


@query
def fit_cbm_sequential(spark, sf_dir):
    return _weights(spark, "base", fitting.fit_sequential(_prepared(spark, sf_dir)))


@query
def fit_cbm_sequential_context(spark, sf_dir):
    return _weights(spark, "context", fitting.fit_sequential(_prepared(spark, sf_dir), with_text=True))


@query
def fit_cbm_joint(spark, sf_dir):
    return _weights(spark, "base", _study(spark, sf_dir).joint_model())


@query
def fit_cbm_joint_context(spark, sf_dir):
    return _weights(spark, "context", _study(spark, sf_dir).joint_model(with_text=True))


def _label_fits(spark, sf_dir, predicted_by):
    frame = _prepared(spark, sf_dir)
    parts = [
        _weights(spark, name, fitting.fit_label_from_concepts(frame, predicted_by, text))
        for name, text in (("plain", False), ("with_text", True))
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def fit_c_to_y_true(spark, sf_dir):
    return _label_fits(spark, sf_dir, None)


@query
def fit_c_to_y_pred(spark, sf_dir):
    """Concepts as the joint fits predict them: without text concepts, and with them."""
    study = _study(spark, sf_dir)
    parts = [
        _weights(spark, name, fitting.fit_label_from_concepts(study.frame, study.joint_model(text), text))
        for name, text in (("plain", False), ("with_text", True))
    ]
    return reduce(DataFrame.unionByName, parts)


SLOPES_SCHEMA = "model string, src string, dst string, slope double"


def _slopes(spark, rows):
    return spark.createDataFrame(rows, SLOPES_SCHEMA).select("model", "src", "dst", F.round("slope", 6).alias("slope"))


@query
def logistic_slopes(spark, sf_dir):
    """Loss of the plain model at fixed weights and its slope in each."""
    loss, slopes = fitting.logistic_slopes(_prepared(spark, sf_dir), t.plain_model())
    return _slopes(spark, [("plain", "loss", LABEL, loss), *(("plain", n, LABEL, v) for n, v in slopes.items())])


def _joint_slopes(spark, sf_dir, name, model):
    train, valid, w = fitting.joint_slopes(_prepared(spark, sf_dir), model)
    rows = [(name, "loss", "train", train), (name, "loss", "validation", valid)]
    rows += [(name, f, c, float(w.concept[i, j])) for i, f in enumerate(FEATURES) for j, c in enumerate(CONCEPTS)]
    rows += [(name, c, LABEL, float(v)) for c, v in zip([*CONCEPTS, *C_TEXT], [*w.label, *w.text], strict=False)]
    return _slopes(spark, rows)


@query
def joint_slopes(spark, sf_dir):
    """Joint loss of the base model at fixed weights and its slope in each."""
    return _joint_slopes(spark, sf_dir, "base", t.base_model())


@query
def joint_slopes_context(spark, sf_dir):
    return _joint_slopes(spark, sf_dir, "context", t.context_model())


@query
def fits_at_minimum(spark, sf_dir):
    """The slope of each convex fit's loss at the weights it found: zero, to six digits."""
    frame = _prepared(spark, sf_dir)
    fits = {"plain": (fitting.fit_logistic(frame), LOGISTIC_WEIGHT_DECAY)}
    for name, text in (("plain", False), ("with_text", True)):
        decay = CONCEPT_LABEL_WEIGHT_DECAY[name]
        fits[f"c_to_y_{name}"] = (fitting.fit_label_from_concepts(frame, None, text), decay)
    rows = []
    for name, (model, decay) in fits.items():
        slopes = fitting.logistic_slopes(frame, model, weight_decay=decay)[1]
        rows += [(name, n, LABEL, abs(v)) for n, v in slopes.items()]
    return _slopes(spark, rows)


@query
def sequential_fits_at_minimum(spark, sf_dir):
    """The slopes of both layers' losses at the weights that the sequential fits found: zero, to six digits."""
    frame = _prepared(spark, sf_dir)
    rows = []
    for name, text in (("base", False), ("context", True)):
        slopes = fitting.sequential_slopes(frame, fitting.fit_sequential(frame, with_text=text))
        rows += [(name, src, dst, abs(v)) for (src, dst), v in slopes.items()]
    return _slopes(spark, rows)
