"""The clinical tables, derived row by row from the synthetic test tables.

Measurements are whole numbers, so sums and means come out bit-identical in
any order of addition and can be compared exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardframe.fixed_values import (
    C_BINARY,
    C_CONTINUOUS,
    C_TEXT,
    KEY,
    LABEL,
    REPORT_COLUMNS,
    RESPIRATORY_CODE_GROUPS,
    TEXT_SOURCES,
    X_BINARY,
    X_CONTINUOUS,
)
from wardframe.functions.measures import total
from wardframe.operators.scoring import CONCEPTS, FEATURES, ConceptModel, LabelModel
from wardframe.plans.cohort_features import ClinicalTables
from wardframe.session import materialize

COHORT_PRIORITIES = ("1-URGENT", "2-HIGH")
FIRST_HOUR = "2024-01-01 00:00:00"
ADMISSIONS_PER_PATIENT = 3

# words standing in for the clinical terms of each concept
KEYWORDS = {
    "ards_detected": ("thtion", "thou"),
    "aspiration_detected": ("erth",),
    "bilateral_infiltrates_detected": ("attion", "erwh"),
    "cardiac_arrest_detected": ("erly", "onthe"),
    "cardiac_failure_detected": ("thly",),
    "pancreatitis_detected": ("ersh", "ernd"),
    "pneumonia_detected": ("this",),
    "trali_detected": ("than", "from"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- admissions ---------------------------------------------------------------


def _admissions(spark: SparkSession, sf_dir: str, labelled: bool) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    chosen = F.col("o_orderpriority").isin(*COHORT_PRIORITIES)
    ids = [
        F.col("o_orderkey").alias("hadm_id"),
        F.col("o_custkey").alias("stay_id"),
        F.col("o_custkey").alias("subject_id"),
    ]
    label = (F.col("o_orderstatus") == "F").cast("int").alias(LABEL)
    return orders.where(chosen if labelled else ~chosen).select(*ids, *([label] if labelled else []))


def cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _admissions(spark, sf_dir, labelled=True)


def unlabelled_cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _admissions(spark, sf_dir, labelled=False)


def diagnoses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes around both respiratory chapters; seventh lines carry the other system's code."""
    lines = table(spark, sf_dir, "lineitem")
    digit = (F.col("l_suppkey") % 10).cast("string")
    icd9 = F.concat((F.col("l_partkey") % 70 + 455).cast("string"), digit)
    icd10 = F.concat(F.lit("J"), F.lpad((F.col("l_partkey") % 100).cast("string"), 2, "0"), digit)
    ninth = F.col("l_linestatus") == "F"
    other = F.col("l_linenumber") == 7
    return lines.select(
        F.col("l_orderkey").alias("hadm_id"),
        F.when(ninth != other, icd9).otherwise(icd10).alias("icd_code"),
        F.when(ninth, 9).otherwise(10).alias("icd_version"),
    )


# --- stays ----------------------------------------------------------------------


#: Groups beside those of single rules: they overlap these, each other and themselves.
MORE_CODE_RULES = (
    ("any_respiratory", 9, "460", "519"),
    ("any_respiratory", 10, "J00", "J99"),
    ("infections", 9, "460", "487"),
    ("infections", 10, "J00", "J22"),
    ("infections", 10, "J10", "J11"),
)


def code_rules(spark: SparkSession) -> DataFrame:
    """The code groups as a table of rules; a set of codes is one rule a code."""
    rows = list(MORE_CODE_RULES)
    for name, systems in RESPIRATORY_CODE_GROUPS.items():
        for system, rule in zip((9, 10), systems, strict=True):
            spans = [(c, c) for c in sorted(rule)] if isinstance(rule, frozenset) else [rule]
            rows += [(name, system, low, high) for low, high in spans]
    return spark.createDataFrame(rows, "code_group string, system int, low string, high string")


def _cents() -> Column:
    return F.round(F.col("value") * 100).cast("long")


def _event(*kinds: str) -> Column:
    return F.col("event_type").isin(*kinds)


def _later() -> Column:
    return F.timestamp_add("SECOND", _cents().cast("int"), F.col("ts"))


def ventilation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("stay_id"),
        F.col("ts").alias("starttime"),
        F.when(~_event("view"), _later()).alias("endtime"),
        F.when(_event("click", "view"), "InvasiveVent")
        .when(_event("purchase"), "NonInvasiveVent")
        .otherwise("SupplementalOxygen")
        .alias("ventilation_status"),
    )


def vasopressor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("stay_id"),
        F.col("ts").alias("starttime"),
        F.when(_event("signup"), F.col("ts")).otherwise(_later()).alias("endtime"),
        _cents().cast("double").alias("norepinephrine_equivalent_dose"),
    )


def sofa(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = _cents()

    def score(divisor: int, *missing: str) -> Column:
        value = (F.floor(cents / divisor) % 5).cast("int")
        return F.when(~_event(*missing), value) if missing else value

    def measure(modulus: int, offset: int = 0) -> Column:
        return (cents % modulus + offset).cast("double")

    hour = F.timestamp_diff("HOUR", F.lit(FIRST_HOUR).cast("timestamp_ntz"), F.col("ts"))
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("stay_id"),
        hour.cast("int").alias("hr"),
        score(1, "error").alias("cns"),
        score(7, "view").alias("renal"),
        score(11, "purchase").alias("respiration"),
        score(13).alias("cardiovascular"),
        score(3, "error").alias("cns_24hours"),
        score(17, "view", "click").alias("renal_24hours"),
        score(19).alias("respiration_24hours"),
        score(23, "signup").alias("cardiovascular_24hours"),
        measure(13, 3).alias("gcs_min"),
        F.when(~_event("click"), measure(97)).alias("creatinine_max"),
        measure(3001).alias("uo_24hr"),
        F.when(_event("purchase"), measure(401)).alias("pao2fio2ratio_vent"),
        F.when(_event("click", "signup", "purchase"), measure(301)).alias("pao2fio2ratio_novent"),
        measure(80, 40).alias("meanbp_min"),
        F.when(_event("error"), measure(17)).alias("rate_norepinephrine"),
    )


def clinical_tables(spark: SparkSession, sf_dir: str, labelled: bool = True) -> ClinicalTables:
    return ClinicalTables(
        _admissions(spark, sf_dir, labelled),
        diagnoses(spark, sf_dir),
        ventilation(spark, sf_dir),
        sofa(spark, sf_dir),
        vasopressor(spark, sf_dir),
    )


# --- notes ----------------------------------------------------------------------


def note_cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    patient = F.floor(F.col("conv_id") / ADMISSIONS_PER_PATIENT).cast("long")
    return (
        table(spark, sf_dir, "conversations")
        .select(F.col("conv_id").alias("hadm_id"), patient.alias("subject_id"))
        .distinct()
    )


def _note_id(kind: str) -> Column:
    return F.concat(F.col("conv_id").cast("string"), F.lit(f"-{kind}-"), F.col("turn").cast("string"))


def discharge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The opening turn, and the second one if the patient side wrote it: up to two per admission."""
    opening = (F.col("turn") == 0) | ((F.col("turn") == 1) & (F.col("role") == "user"))
    return table(spark, sf_dir, "conversations").where(opening).select(
        F.col("conv_id").alias("hadm_id"), _note_id("DS").alias("note_id"), "text"
    )


def radiology(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later turns of the same side; the fourth turn's text is missing."""
    later = (F.col("turn") >= 2) & (F.col("role") == "user")
    return table(spark, sf_dir, "conversations").where(later).select(
        F.col("conv_id").alias("hadm_id"),
        _note_id("RR").alias("note_id"),
        F.when(F.col("turn") != 4, F.col("text")).alias("text"),
    )


def ecg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One study per answer, one numbered report per line of it."""
    patient = F.floor(F.col("conv_id") / ADMISSIONS_PER_PATIENT).cast("long")
    lines = F.split("text", "\n")
    return table(spark, sf_dir, "conversations").where(F.col("role") == "assistant").select(
        patient.alias("subject_id"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("study_id"),
        *(F.get(lines, i).alias(f"report_{i}") for i in range(REPORT_COLUMNS)),
    )


def long_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long texts per admission; some admissions lack radiology or ECG texts."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias(KEY),
        F.col("text").alias("discharge_text"),
        F.when(F.col("lang") != "de", F.col("text")).otherwise("").alias("radiology_texts"),
        F.when(F.col("lang").isin("en", "es"), F.col("text")).otherwise("").alias("ecd_combined_reports"),
    )


def first_source() -> dict[str, str]:
    return {concept: sources[0] for concept, sources in TEXT_SOURCES.items()}


# --- modelling frame --------------------------------------------------------------


def frame_columns() -> dict[str, str]:
    """Expressions over an order and its lines, valid in both engines.

    ``div`` is written as FLOOR of a quotient; every value is a whole number
    or the mean of whole numbers.
    """
    x = dict(
        zip(
            X_CONTINUOUS,
            (
                "MAX(q)",
                "AVG(q)",
                "AVG(disc)",
                "AVG(tax)",
                "AVG(price)",
                "SUM(CASE WHEN flag = 'R' THEN q END)",
                "MAX(CASE WHEN flag = 'A' THEN disc END)",
                "AVG(line)",
                "MIN(price)",
                "MAX(price)",
                "MAX(CASE WHEN status = 'O' THEN tax END)",
                "MIN(q)",
                "SUM(CASE WHEN flag = 'N' THEN q END)",
                "MIN(line)",
                "COALESCE(SUM(line * 60), 0)",
            ),
            strict=True,
        )
    )
    tests = ("flag = 'R'", "flag = 'A'", "flag = 'N'", "status = 'O'", "q > 45", "disc = 10")
    b = {name: f"COALESCE(MAX(CASE WHEN {t} THEN 1 ELSE 0 END), 0)" for name, t in zip(X_BINARY, tests, strict=True)}
    scores = ("FLOOR(q / 11)", "FLOOR(disc / 3)", "FLOOR(tax / 2)", "FLOOR(line / 2)")
    c = dict(
        zip(
            C_CONTINUOUS,
            (
                *(f"AVG({s})" for s in scores),
                *(f"MAX(CASE WHEN line <= 3 THEN {s} END)" for s in scores),
                *(f"MAX({s})" for s in scores),
            ),
            strict=True,
        )
    )
    return {**x, **b, **c}


def order_columns() -> dict[str, str]:
    """Text concepts and label of the frame, from the order and two line counts."""
    text = dict(
        zip(
            C_TEXT,
            (
                "o_orderpriority = '1-URGENT'",
                "o_orderpriority = '5-LOW'",
                "o_orderstatus = 'P'",
                "o_totalprice > 300000",
                "o_totalprice < 50000",
                "o_totalprice > 200000",
                "o_orderstatus = 'F'",
                "o_orderpriority = '3-MEDIUM'",
            ),
            strict=True,
        )
    )
    label = "o_orderstatus = 'F' OR (o_orderstatus = 'O' AND closed_lines > open_lines)"
    return {**text, LABEL: label}


LINE_COLUMNS = {
    "q": "CAST(l_quantity AS DOUBLE)",
    "disc": "CAST(ROUND(l_discount * 100) AS DOUBLE)",
    "tax": "CAST(ROUND(l_tax * 100) AS DOUBLE)",
    "price": "CAST(FLOOR(l_extendedprice / 100) AS DOUBLE)",
    "line": "CAST(l_linenumber AS DOUBLE)",
    "flag": "l_returnflag",
    "status": "l_linestatus",
}
SEVERITY = {C_BINARY[0]: "kinds >= 5", C_BINARY[1]: "kinds >= 3 AND kinds < 5"}
#: Orders and lines that one task joins: their aggregates (some 400 bytes an order, held up to three times) fit its memory.
ROWS_PER_TASK = 1_500_000


def frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One modelling row per order; columns are null where it has no such line.

    An order has few lines and some forty aggregates. Aggregating before the shuffle would
    hold all of them for every order that a task meets, spill, and send more than the lines.
    Lines are small in the shuffle and their aggregates are not, so the rows, counted in the
    Parquet footers, and not shuffled bytes tell how many tasks share them.
    """
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", KEY)
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias(KEY), *(F.expr(e).alias(n) for n, e in LINE_COLUMNS.items())
    )
    rows = orders.count() + lines.count()
    tasks = max(spark.sparkContext.defaultParallelism, rows // ROWS_PER_TASK + 1)
    per_order = lines.where(F.col(KEY).isNotNull()).repartition(tasks, KEY).groupBy(KEY).agg(
        *(F.expr(e).alias(n) for n, e in frame_columns().items()),
        F.count_if(F.col("status") == "F").alias("closed_lines"),
        F.count_if(F.col("status") == "O").alias("open_lines"),
    )
    zero_if_missing = (X_CONTINUOUS[-1], *X_BINARY, "closed_lines", "open_lines")
    joined = orders.join(per_order, KEY, "left").na.fill(0, list(zero_if_missing))
    kinds = total(F.col(c) for c in X_BINARY)
    joined = joined.withColumn("kinds", kinds)
    return joined.select(
        KEY,
        *(F.col(c).cast("double").alias(c) for c in X_CONTINUOUS),
        *(F.col(c).cast("int").alias(c) for c in X_BINARY),
        *(F.col(c).cast("double").alias(c) for c in C_CONTINUOUS),
        *(F.expr(e).cast("int").alias(c) for c, e in SEVERITY.items()),
        *(F.expr(e).cast("int").alias(c) for c, e in order_columns().items()),
    )


_written: dict[tuple[str, str], DataFrame] = {}


def written_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The modelling frame as a table, written once per session and folder.

    Fitting, scoring and what-if questions all start from it.
    """
    place = (spark.sparkContext.applicationId, sf_dir)
    if place not in _written:
        _written[place] = materialize(frame(spark, sf_dir), "modelling-frame")
    return _written[place]


# --- fixed weights: a rule instead of a table ---------------------------------------


def _weight(i: int, j: int, scale: float) -> float:
    return ((7 * i + 5 * j) % 11 - 5) * scale


def plain_model() -> LabelModel:
    return LabelModel({f: _weight(i, 3, 0.25) for i, f in enumerate(FEATURES)})


def _concept_weights() -> dict[str, dict[str, float]]:
    return {c: {f: _weight(i, j, 0.0625) for i, f in enumerate(FEATURES)} for j, c in enumerate(CONCEPTS)}


def label_model(seed: int, text: bool) -> LabelModel:
    names = (*CONCEPTS, *C_TEXT) if text else CONCEPTS
    return LabelModel({c: _weight(i, seed, 0.25) for i, c in enumerate(names)})


def base_model() -> ConceptModel:
    return ConceptModel(_concept_weights(), label_model(2, text=False))


def context_model() -> ConceptModel:
    return ConceptModel(_concept_weights(), label_model(6, text=True))
