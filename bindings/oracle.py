"""The same results as plain SQL over the test tables, for DuckDB.

Written independently of the operators: windows and joins instead of struct
aggregates, substrings instead of patterns, full model sums instead of shifts.
"""

from __future__ import annotations

from dataclasses import dataclass

from bindings import tables as t
from wardframe.fixed_values import (
    C_BINARY,
    C_CONTINUOUS,
    C_TEXT,
    KEY,
    LABEL,
    PROMPTS,
    RESPIRATORY_CODE_GROUPS,
    X_BINARY,
    X_CONTINUOUS,
)

FEATURES = (*X_CONTINUOUS, *X_BINARY)
CONCEPTS = (*C_CONTINUOUS, *C_BINARY)
ALL_CONCEPTS = (*CONCEPTS, *C_TEXT)
SCALED = (*X_CONTINUOUS, *C_CONTINUOUS)

ORACLE_SQL: dict[str, str] = {}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _number(value: float) -> str:
    return f"({value!r}e0)"


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


# --- cohort features ---------------------------------------------------------

PRIORITIES = ", ".join(_quoted(p) for p in t.COHORT_PRIORITIES)
COHORT = f"""cohort AS (
  SELECT o_orderkey AS hadm_id, o_custkey AS stay_id, o_custkey AS subject_id,
         CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS {LABEL}
  FROM orders WHERE o_orderpriority IN ({PRIORITIES}))"""
UNLABELLED = f"""cohort AS (
  SELECT o_orderkey AS hadm_id, o_custkey AS stay_id, o_custkey AS subject_id
  FROM orders WHERE o_orderpriority NOT IN ({PRIORITIES}))"""
DIAGNOSES = """diagnoses AS (
  SELECT l_orderkey AS hadm_id,
         CASE WHEN (l_linestatus = 'F') <> (l_linenumber = 7)
              THEN CAST(455 + l_partkey % 70 AS VARCHAR) || CAST(l_suppkey % 10 AS VARCHAR)
              ELSE 'J' || lpad(CAST(l_partkey % 100 AS VARCHAR), 2, '0') || CAST(l_suppkey % 10 AS VARCHAR)
         END AS icd_code,
         CASE WHEN l_linestatus = 'F' THEN 9 ELSE 10 END AS icd_version
  FROM lineitem)"""
SPLIT_CODES = """codes AS (
  SELECT hadm_id, CASE WHEN icd_version = 9 THEN icd_code END AS icd9_code,
         CASE WHEN icd_version = 10 THEN icd_code END AS icd10_code
  FROM diagnoses)"""
EVENTS = """ev AS (
  SELECT user_id AS stay_id, ts, event_type, CAST(round(value * 100) AS BIGINT) AS cents,
         ts + to_seconds(CAST(round(value * 100) AS BIGINT)) AS later
  FROM events)"""
VENTILATION = """ventilation AS (
  SELECT stay_id, ts AS starttime, CASE WHEN event_type <> 'view' THEN later END AS endtime,
         CASE WHEN event_type IN ('click', 'view') THEN 'InvasiveVent'
              WHEN event_type = 'purchase' THEN 'NonInvasiveVent'
              ELSE 'SupplementalOxygen' END AS ventilation_status
  FROM ev)"""
VASOPRESSOR = """vasopressor AS (
  SELECT stay_id, ts AS starttime, CASE WHEN event_type = 'signup' THEN ts ELSE later END AS endtime,
         CAST(cents AS DOUBLE) AS dose
  FROM ev)"""
SOFA = f"""sofa AS (
  SELECT stay_id, CAST(date_sub('hour', TIMESTAMP '{t.FIRST_HOUR}', ts) AS INTEGER) AS hr,
    CAST(CASE WHEN event_type <> 'error' THEN cents % 5 END AS INTEGER) AS cns,
    CAST(CASE WHEN event_type <> 'view' THEN (cents // 7) % 5 END AS INTEGER) AS renal,
    CAST(CASE WHEN event_type <> 'purchase' THEN (cents // 11) % 5 END AS INTEGER) AS respiration,
    CAST((cents // 13) % 5 AS INTEGER) AS cardiovascular,
    CAST(CASE WHEN event_type <> 'error' THEN (cents // 3) % 5 END AS INTEGER) AS cns_24hours,
    CAST(CASE WHEN event_type NOT IN ('view', 'click') THEN (cents // 17) % 5 END AS INTEGER) AS renal_24hours,
    CAST((cents // 19) % 5 AS INTEGER) AS respiration_24hours,
    CAST(CASE WHEN event_type <> 'signup' THEN (cents // 23) % 5 END AS INTEGER) AS cardiovascular_24hours,
    CAST(cents % 13 + 3 AS DOUBLE) AS gcs_min,
    CAST(CASE WHEN event_type <> 'click' THEN cents % 97 END AS DOUBLE) AS creatinine_max,
    CAST(cents % 3001 AS DOUBLE) AS uo_24hr,
    CAST(CASE WHEN event_type = 'purchase' THEN cents % 401 END AS DOUBLE) AS pao2fio2ratio_vent,
    CAST(CASE WHEN event_type IN ('click', 'signup', 'purchase') THEN cents % 301 END AS DOUBLE) AS pao2fio2ratio_novent,
    CAST(cents % 80 + 40 AS DOUBLE) AS meanbp_min,
    CAST(CASE WHEN event_type = 'error' THEN cents % 17 END AS DOUBLE) AS rate_norepinephrine
  FROM ev)"""
SOFA_COHORT = "sc AS (SELECT s.* FROM sofa s WHERE s.stay_id IN (SELECT stay_id FROM cohort))"
SOFA_ALL = "sc AS (SELECT * FROM sofa)"

_RATIO = "coalesce(pao2fio2ratio_vent, pao2fio2ratio_novent)"
# score, worst columns, first-day columns: (expression, name) pairs, score last
_ORGANS = (
    ("cns", (("gcs_min", "sofa_cns_worst_gcs", "first24hr_cns_gcs"),)),
    (
        "renal",
        (
            ("creatinine_max", "sofa_renal_worst_creatinine", "first24hr_renal_creatinine"),
            ("uo_24hr", "sofa_renal_worst_urineoutput", "first24hr_renal_urineoutput"),
        ),
    ),
    ("respiration", ((_RATIO, "sofa_respiration_worst_pao2fio2ratio", "first24hr_respiration_pao2fio2ratio"),)),
    (
        "cardiovascular",
        (
            ("meanbp_min", "sofa_cardiovascular_worst_meanbp", "first24hr_cardiovascular_meanbp"),
            (
                "rate_norepinephrine",
                "sofa_cardiovascular_worst_rate_norepinephrine",
                "first24hr_cardiovascular_rate_norepinephrine",
            ),
        ),
    ),
)
_WORST = [n for organ, cs in _ORGANS for n in (*(c[1] for c in cs), f"c_sofa_max_{organ}")]
_FIRST = [n for organ, cs in _ORGANS for n in (*(c[2] for c in cs), f"c_first24hr_sofa_max_{organ}")]
_AVERAGES = {
    "c_sofa_avg_cns": "cns",
    "sofa_cns_avg_gcs": "gcs_min",
    "c_sofa_avg_renal": "renal",
    "sofa_renal_avg_creatinine": "creatinine_max",
    "sofa_renal_avg_urineoutput": "uo_24hr",
    "c_sofa_avg_respiration": "respiration",
    "sofa_respiration_avg_pao2fio2ratio": _RATIO,
    "c_sofa_avg_cardiovascular": "cardiovascular",
    "sofa_cardiovascular_avg_meanbp": "meanbp_min",
    "sofa_cardiovascular_avg_rate_norepinephrine": "rate_norepinephrine",
}


def _ranked(first_day: bool) -> list[str]:
    parts = []
    for organ, companions in _ORGANS:
        score = f"{organ}_24hours" if first_day else organ
        name = f"c_first24hr_sofa_max_{organ}" if first_day else f"c_sofa_max_{organ}"
        columns = ", ".join(f"{c[0]} AS {c[2 if first_day else 1]}" for c in companions)
        order = ", ".join(f"{c[0]} DESC NULLS LAST" for c in companions)
        where = "WHERE hr < 24" if first_day else ""
        parts.append(f"""{organ}_{'f' if first_day else 'w'} AS (
  SELECT stay_id, {score} AS {name}, {columns},
         row_number() OVER (PARTITION BY stay_id ORDER BY {score} DESC NULLS LAST, hr ASC NULLS LAST, {order}) AS rn
  FROM sc {where})""")
    return parts


AVERAGED = "avg_full AS (SELECT stay_id, " + ", ".join(f"avg({e}) AS {n}" for n, e in _AVERAGES.items()) + " FROM sc GROUP BY stay_id)"


def _stay_select(worst: bool = True, first: bool = True, averages: bool = True) -> str:
    columns = ["s.stay_id", *(_WORST if worst else []), *(_FIRST if first else []), *(_AVERAGES if averages else [])]
    sql = f"SELECT {', '.join(columns)} FROM (SELECT DISTINCT stay_id FROM sc) s"
    for flag, wanted in (("w", worst), ("f", first)):
        if wanted:
            for organ, _ in _ORGANS:
                name = f"{organ}_{flag}"
                sql += f"\n  LEFT JOIN {name} ON {name}.stay_id = s.stay_id AND {name}.rn = 1"
    if averages:
        sql += "\n  LEFT JOIN avg_full ON avg_full.stay_id = s.stay_id"
    return sql


STAY_PARTS = [EVENTS, SOFA]


def _group_rule(rule, code: str) -> str:
    if isinstance(rule, frozenset):
        return f"substr({code}, 1, 3) IN ({', '.join(_quoted(r) for r in sorted(rule))})"
    return f"substr({code}, 1, 3) BETWEEN '{rule[0]}' AND '{rule[1]}'"


FLAGS = (
    "flags AS (SELECT hadm_id, "
    + ",\n    ".join(
        f"max(CASE WHEN {_group_rule(r9, 'icd9_code')} OR {_group_rule(r10, 'icd10_code')} THEN 1 ELSE 0 END) AS {name}"
        for name, (r9, r10) in RESPIRATORY_CODE_GROUPS.items()
    )
    + " FROM codes GROUP BY hadm_id)"
)
_SUM = " + ".join(RESPIRATORY_CODE_GROUPS)
_BANDS = f"""CASE WHEN ({_SUM}) IN (1, 2) THEN 1 ELSE 0 END AS c_mod_resp_comorbidity,
  CASE WHEN ({_SUM}) >= 3 THEN 1 ELSE 0 END AS c_svr_resp_comorbidity"""
VENT_AGG = """vent_agg AS (
  SELECT stay_id, CAST(sum(date_diff('minute', starttime, endtime)) AS BIGINT) AS minutes
  FROM ventilation WHERE ventilation_status = 'InvasiveVent' GROUP BY stay_id)"""
DOSE_AGG = """dose_agg AS (
  SELECT stay_id,
         sum(dose * date_sub('minute', starttime, endtime))
           / nullif(sum(date_sub('minute', starttime, endtime)), 0) AS twa,
         max(dose) AS peak
  FROM vasopressor GROUP BY stay_id)"""
_FLAG_LIST = ", ".join(RESPIRATORY_CODE_GROUPS)

ORACLE_SQL["vent_duration"] = _with(COHORT, EVENTS, VENTILATION, VENT_AGG) + """
SELECT c.hadm_id, c.stay_id, coalesce(v.minutes, 0) AS mech_vent_duration_minutes
FROM cohort c LEFT JOIN vent_agg v ON v.stay_id = c.stay_id"""
ORACLE_SQL["vasopressor_twa"] = _with(COHORT, EVENTS, VASOPRESSOR, DOSE_AGG) + """
SELECT c.hadm_id, c.stay_id, coalesce(d.twa, 0) AS avg_norepinephrine_equiv,
       coalesce(d.peak, 0) AS max_norepinephrine_equiv
FROM cohort c LEFT JOIN dose_agg d ON d.stay_id = c.stay_id"""
ORACLE_SQL["code_split"] = _with(DIAGNOSES, SPLIT_CODES) + "SELECT * FROM codes"
ORACLE_SQL["code_classifier"] = _with(DIAGNOSES, SPLIT_CODES, FLAGS) + "SELECT * FROM flags"
_MORE_FLAGS = ", ".join(
    "max(CASE WHEN " + " OR ".join(
        f"substr(icd{system}_code, 1, 3) BETWEEN '{low}' AND '{high}'"
        for group, system, low, high in t.MORE_CODE_RULES if group == name
    ) + f" THEN 1 ELSE 0 END) AS {name}"
    for name in ("any_respiratory", "infections")
)
ORACLE_SQL["code_classifier_rules"] = _with(DIAGNOSES, SPLIT_CODES, FLAGS) + f"""
SELECT * FROM flags JOIN (SELECT hadm_id, {_MORE_FLAGS} FROM codes GROUP BY hadm_id) USING (hadm_id)"""
ORACLE_SQL["comorbidity_bands"] = _with(COHORT, DIAGNOSES, SPLIT_CODES, FLAGS) + f"""
SELECT c.hadm_id, {_FLAG_LIST}, {_BANDS} FROM cohort c LEFT JOIN flags f ON f.hadm_id = c.hadm_id"""
for _name in ("worst_row_struct", "worst_row_window"):
    ORACLE_SQL[_name] = _with(*STAY_PARTS, SOFA_ALL, *_ranked(False)) + _stay_select(first=False, averages=False)
ORACLE_SQL["first24_worst_window"] = _with(*STAY_PARTS, SOFA_ALL, *_ranked(True)) + _stay_select(worst=False, averages=False)
ORACLE_SQL["first24_worst_struct"] = ORACLE_SQL["first24_worst_window"]
ORACLE_SQL["stay_averages"] = _with(*STAY_PARTS, SOFA_ALL, AVERAGED) + _stay_select(worst=False, first=False)
ORACLE_SQL["stay_metrics"] = (
    _with(COHORT, *STAY_PARTS, SOFA_COHORT, *_ranked(False), *_ranked(True), AVERAGED) + _stay_select()
)
ORACLE_SQL["cohort_semi_join"] = _with(COHORT, *STAY_PARTS, SOFA_COHORT) + "SELECT * FROM sc"


def _features(cohort: str, label: str) -> str:
    metrics = ", ".join([*_WORST, *_FIRST, *_AVERAGES])
    return (
        _with(
            cohort,
            DIAGNOSES,
            SPLIT_CODES,
            FLAGS,
            *STAY_PARTS,
            VENTILATION,
            VENT_AGG,
            VASOPRESSOR,
            DOSE_AGG,
            SOFA_COHORT,
            *_ranked(False),
            *_ranked(True),
            AVERAGED,
            f"metrics AS ({_stay_select()})",
        )
        + f"""
SELECT c.hadm_id, c.stay_id, c.subject_id, {label} {_FLAG_LIST}, {_BANDS},
  coalesce(v.minutes, 0) AS mech_vent_duration_minutes, {metrics},
  coalesce(d.twa, 0) AS avg_norepinephrine_equiv, coalesce(d.peak, 0) AS max_norepinephrine_equiv
FROM cohort c
  LEFT JOIN flags f ON f.hadm_id = c.hadm_id
  LEFT JOIN vent_agg v ON v.stay_id = c.stay_id
  LEFT JOIN metrics m ON m.stay_id = c.stay_id
  LEFT JOIN dose_agg d ON d.stay_id = c.stay_id
ORDER BY c.hadm_id"""
    )


ORACLE_SQL["cohort_features"] = _features(COHORT, f"c.{LABEL},")
ORACLE_SQL["cohort_features_unlabelled"] = _features(UNLABELLED, "")

# --- notes ------------------------------------------------------------------------

_PATIENT = f"conv_id // {t.ADMISSIONS_PER_PATIENT}"
NOTE_COHORT = f"cohort AS (SELECT DISTINCT conv_id AS hadm_id, {_PATIENT} AS subject_id FROM conversations)"
_REPORT = " || ' ' || ".join(f"coalesce(string_split(text, chr(10))[{i + 1}], '')" for i in range(18))
REPORTS = f"""reports AS (
  SELECT {_PATIENT} AS subject_id, CAST(conv_id * 1000 + turn AS VARCHAR) AS study_id, {_REPORT} AS report_text
  FROM conversations WHERE role = 'assistant')"""
ECG = """ecg AS (
  SELECT subject_id, string_agg(DISTINCT study_id, ', ' ORDER BY study_id) AS ecd_study_ids,
         string_agg(report_text, ' ||| ' ORDER BY study_id, report_text) AS ecd_combined_reports
  FROM reports GROUP BY subject_id)"""
RADIOLOGY = """rad AS (
  SELECT conv_id AS hadm_id, conv_id || '-RR-' || turn AS note_id, CASE WHEN turn <> 4 THEN text END AS text
  FROM conversations WHERE turn >= 2 AND role = 'user')"""
RADIOLOGY_AGG = """radiology AS (
  SELECT hadm_id, string_agg(note_id, ', ' ORDER BY note_id, text) AS radiology_note_ids,
         string_agg(text, ' ||| ' ORDER BY note_id, text) AS radiology_texts
  FROM rad GROUP BY hadm_id)"""
ORACLE_SQL["wide_report_concat"] = _with(REPORTS) + "SELECT * FROM reports"
ORACLE_SQL["note_string_agg"] = _with(RADIOLOGY, RADIOLOGY_AGG) + "SELECT * FROM radiology"
ORACLE_SQL["note_distinct_agg"] = _with(REPORTS, ECG) + "SELECT * FROM ecg"
ORACLE_SQL["patient_level_notes"] = _with(NOTE_COHORT, REPORTS, ECG) + """
SELECT c.hadm_id, c.subject_id, e.ecd_study_ids, e.ecd_combined_reports
FROM cohort c JOIN ecg e ON e.subject_id = c.subject_id"""
ORACLE_SQL["notes_consolidated"] = _with(NOTE_COHORT, REPORTS, RADIOLOGY, RADIOLOGY_AGG) + """
SELECT c.hadm_id, d.conv_id || '-DS-' || d.turn AS discharge_note_id, d.text AS discharge_text,
       r.radiology_note_ids, r.radiology_texts,
       string_agg(DISTINCT e.study_id, ', ' ORDER BY e.study_id) AS ecd_study_ids,
       string_agg(e.report_text, ' ||| ' ORDER BY e.study_id, e.report_text) AS ecd_combined_reports
FROM cohort c
  LEFT JOIN conversations d ON d.conv_id = c.hadm_id AND (d.turn = 0 OR (d.turn = 1 AND d.role = 'user'))
  LEFT JOIN radiology r ON r.hadm_id = c.hadm_id
  LEFT JOIN reports e ON e.subject_id = c.subject_id
GROUP BY ALL ORDER BY c.hadm_id"""
ORACLE_SQL["first_note_per_admission"] = f"""
SELECT conv_id AS {KEY}, turn, role, text
FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS rn FROM conversations)
WHERE rn = 1"""

# --- text concepts --------------------------------------------------------------------


def _chunks(name: str, source: str, key: str, text: str, size: int = 4096, step: int = 3996) -> str:
    return f"""{name} AS (
  SELECT {key}, CAST(p // {step} AS INTEGER) AS chunk_no, substring({text}, CAST(p + 1 AS BIGINT), {size}) AS chunk
  FROM (SELECT {key}, {text}, unnest(range(0, length({text}), {step})) AS p FROM {source}))"""


NOTES = f"""notes AS (
  SELECT doc_id AS {KEY}, text AS discharge_text, CASE WHEN lang <> 'de' THEN text ELSE '' END AS radiology_texts,
         CASE WHEN lang IN ('en', 'es') THEN text ELSE '' END AS ecd_combined_reports
  FROM documents)"""
CHUNKS = _chunks("chunks", "notes", KEY, "discharge_text")
ORACLE_SQL["chunks"] = _with(NOTES, CHUNKS) + "SELECT * FROM chunks"
ORACLE_SQL["chunk_stats"] = _with(NOTES, CHUNKS) + f"""
SELECT {KEY}, count(*) AS chunks, CAST(sum(length(chunk)) AS BIGINT) AS characters, CAST(max(length(chunk)) AS INTEGER) AS longest
FROM chunks GROUP BY {KEY}"""
ORACLE_SQL["chunks_of_joined_notes"] = (
    _with(
        f"joined AS (SELECT conv_id AS {KEY}, string_agg(text, ' ||| ' ORDER BY turn) AS text FROM conversations GROUP BY conv_id)",
        _chunks("chunks", "joined", KEY, "text", 400, 360),
    )
    + f"SELECT {KEY}, CAST(chunk_no AS BIGINT) AS chunk_no, chunk FROM chunks"
)


def _prompts() -> str:
    selects = []
    for concept, sources in t.TEXT_SOURCES.items():
        before, after = (_quoted(p) for p in PROMPTS[concept].split("{text}"))
        selects.append(
            f"SELECT {KEY}, '{concept}' AS concept, chunk_no, {before} || chunk || {after} AS prompt FROM c_{sources[0]}"
        )
    texts = dict.fromkeys(s[0] for s in t.TEXT_SOURCES.values())
    return _with(NOTES, *(_chunks(f"c_{x}", "notes", KEY, x) for x in texts)) + " UNION ALL ".join(selects)


ORACLE_SQL["prompt_column"] = _prompts()


def _answers(name: str, words, chunks: str) -> str:
    cases = " ".join(f"WHEN contains(chunk, {_quoted(w)}) THEN {_quoted('Yes: ' + w)}" for w in words)
    return f"{name} AS (SELECT {KEY}, chunk_no, CASE {cases} ELSE 'No' END AS answer FROM {chunks})"


def _labels(name: str, answers: str, text: str, null_if_empty: bool = False, source: str = "notes") -> str:
    empty = f"WHEN coalesce(length(n.{text}), 0) = 0 THEN" if null_if_empty else ""
    detected = f"CASE {empty} {'NULL' if null_if_empty else ''} WHEN a.yes > 0 THEN 'Yes' ELSE 'No' END"
    why = "coalesce(a.first_yes, a.first_answer, 'No sufficient data')"
    if null_if_empty:
        why = f"CASE {empty} 'No radiology text available' ELSE {why} END"
    return f"""{name} AS (
  SELECT n.{KEY}, CAST(coalesce(length(n.{text}), 0) AS INTEGER) AS text_length, {detected} AS detected, {why} AS explanation
  FROM {source} n LEFT JOIN (
    SELECT {KEY}, count(*) FILTER (WHERE contains(answer, 'Yes')) AS yes,
           arg_min(answer, chunk_no) FILTER (WHERE contains(answer, 'Yes')) AS first_yes,
           arg_min(answer, chunk_no) AS first_answer
    FROM {answers} GROUP BY {KEY}) a ON a.{KEY} = n.{KEY})"""


def _label_parts(concept: str, text: str, tag: str = "", null_if_empty: bool = False, source: str = "notes") -> list[str]:
    return [
        _chunks(f"chunks{tag}", source, KEY, text),
        _answers(f"answers{tag}", t.KEYWORDS[concept], f"chunks{tag}"),
        _labels(f"labels{tag}", f"answers{tag}", text, null_if_empty, source),
    ]


_ARDS = _with(NOTES, *_label_parts("ards_detected", "discharge_text", "_t"))
ORACLE_SQL["keyword_label"] = _ARDS + f"SELECT {KEY}, text_length, detected FROM labels_t"
ORACLE_SQL["label_explanation"] = _ARDS + f"SELECT {KEY}, explanation FROM labels_t"
ORACLE_SQL["label_callable"] = _ARDS + f"""
SELECT {KEY}, text_length, detected, explanation FROM labels_t"""
ORACLE_SQL["label_null_if_empty"] = (
    _with(NOTES, *_label_parts("bilateral_infiltrates_detected", "radiology_texts", "_t", True))
    + "SELECT * FROM labels_t"
)
ORACLE_SQL["label_cascade"] = (
    _with(
        NOTES,
        *_label_parts("cardiac_failure_detected", "ecd_combined_reports", "_1"),
        *_label_parts("cardiac_failure_detected", "discharge_text", "_2"),
    )
    + f"""
SELECT a.{KEY}, greatest(a.text_length, b.text_length) AS text_length,
  CASE WHEN a.detected = 'Yes' THEN a.detected ELSE b.detected END AS detected,
  CASE WHEN a.detected = 'Yes' THEN a.explanation ELSE b.explanation END AS explanation
FROM labels_1 a JOIN labels_2 b ON a.{KEY} = b.{KEY}"""
)


def _wide_parts() -> list[str]:
    """One chunk-and-reduce per concept, joined side by side."""
    parts = [NOTES]
    for i, concept in enumerate(C_TEXT):
        text = t.TEXT_SOURCES[concept][0]
        parts += _label_parts(concept, text, f"_c{i}", concept == "bilateral_infiltrates_detected")
    parts += _label_parts("cardiac_failure_detected", "discharge_text", "_fb")
    columns = []
    for i, concept in enumerate(C_TEXT):
        detected = f"labels_c{i}.detected"
        if concept == "cardiac_failure_detected":
            detected = f"CASE WHEN {detected} = 'Yes' THEN 'Yes' ELSE labels_fb.detected END"
        columns.append(f"CASE {detected} WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS {concept}")
    joins = " ".join(f"JOIN labels_c{i} USING ({KEY})" for i in range(len(C_TEXT)))
    parts.append(
        f"wide AS (SELECT {KEY}, {', '.join(columns)} FROM notes {joins} JOIN labels_fb USING ({KEY}))"
    )
    return parts


ORACLE_SQL["label_wide"] = _with(*_wide_parts()) + "SELECT * FROM wide"
ORACLE_SQL["label_incremental"] = (
    _with(
        NOTES,
        f"fresh AS (SELECT * FROM notes WHERE {KEY} NOT IN (SELECT doc_id FROM labels))",
        *_label_parts("pneumonia_detected", "discharge_text", "_t", source="fresh"),
    )
    + f"SELECT {KEY}, text_length, detected FROM labels_t"
)
ORACLE_SQL["label_batch"] = f"""
SELECT doc_id AS {KEY}, CAST(length(text) AS INTEGER) AS text_length FROM documents ORDER BY doc_id LIMIT 100 OFFSET 50"""

ORACLE_SQL["label_cascade_callable"] = ORACLE_SQL["label_cascade"]
_LONG = "SELECT {key}, '{concept}' AS concept, text_length, detected, explanation FROM labels_{tag}"


def _long_labels(*asked: tuple[str, str, bool]) -> str:
    parts = [_label_parts(c, text, f"_{i}", null) for i, (c, text, null) in enumerate(asked)]
    return _with(NOTES, *(p for own in parts for p in own)) + " UNION ALL ".join(
        _LONG.format(key=KEY, concept=c, tag=i) for i, (c, _, _) in enumerate(asked)
    )


_TWO = (("ards_detected", "discharge_text", False), ("trali_detected", "discharge_text", False))
ORACLE_SQL["label_callable_all"] = ORACLE_SQL["label_sink_concepts"] = _long_labels(*_TWO)
ORACLE_SQL["label_new"] = _long_labels(*_TWO, ("bilateral_infiltrates_detected", "radiology_texts", True))

ORACLE_SQL["label_table_new"] = ORACLE_SQL["label_new"]
ORACLE_SQL["label_table_batches"] = ORACLE_SQL["label_sink_concepts"]
ORACLE_SQL["label_waves"] = _ARDS.rstrip() + f""",
  waves AS (SELECT {KEY}, answer, length(bin(chunk_no + 1)) AS wave FROM answers_t),
  reached AS (SELECT {KEY}, min(wave) FILTER (WHERE contains(answer, 'Yes')) AS settled FROM waves GROUP BY {KEY}),
  calls AS (
    SELECT {KEY}, count(*) AS n_calls FROM waves JOIN reached USING ({KEY})
    WHERE settled IS NULL OR wave <= settled GROUP BY {KEY})
SELECT {KEY}, text_length, detected, explanation, coalesce(n_calls, 0) AS n_calls FROM labels_t LEFT JOIN calls USING ({KEY})"""
ORACLE_SQL["label_batch_deep"] = f"""
SELECT o_orderkey AS {KEY}, o_orderdate AS written
FROM (SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS place, count(*) OVER () AS n FROM orders)
WHERE place >= n // 4 * 3 AND place < n // 4 * 3 + 100"""

ORACLE_SQL["label_sink"] = (
    _with(NOTES, *_label_parts("trali_detected", "discharge_text", "_t")) + "SELECT * FROM labels_t"
)
_consolidated = ORACLE_SQL["notes_consolidated"]
ORACLE_SQL["notes_csv_source"] = f"""
SELECT hadm_id, {', '.join(f"coalesce({c}, '') AS {c}" for c in ('discharge_note_id', 'discharge_text', 'radiology_note_ids', 'radiology_texts', 'ecd_study_ids', 'ecd_combined_reports'))}
FROM ({_consolidated})"""

# --- modelling frame ----------------------------------------------------------------------

LINES = "lines AS (SELECT l_orderkey, " + ", ".join(f"{e} AS {n}" for n, e in t.LINE_COLUMNS.items()) + " FROM lineitem)"
_ZERO = (X_CONTINUOUS[-1], *X_BINARY)


def _per_order() -> str:
    columns = ", ".join(f"{e} AS {n}" for n, e in t.frame_columns().items())
    return f"""per_order AS (
  SELECT l_orderkey, {columns}, count(*) FILTER (WHERE status = 'F') AS closed_lines,
         count(*) FILTER (WHERE status = 'O') AS open_lines
  FROM lines GROUP BY l_orderkey)"""


def _frame_body() -> str:
    columns = [f"o_orderkey AS {KEY}"]
    for c in X_CONTINUOUS:
        columns.append(f"CAST({f'coalesce({c}, 0)' if c in _ZERO else c} AS DOUBLE) AS {c}")
    columns += [f"CAST(coalesce({c}, 0) AS INTEGER) AS {c}" for c in X_BINARY]
    columns += [f"CAST({c} AS DOUBLE) AS {c}" for c in C_CONTINUOUS]
    columns += [f"CAST(({e}) AS INTEGER) AS {c}" for c, e in t.SEVERITY.items()]
    columns += [f"CAST(({e}) AS INTEGER) AS {c}" for c, e in t.order_columns().items()]
    kinds = " + ".join(f"coalesce({c}, 0)" for c in X_BINARY)
    return f"""SELECT {', '.join(columns)}
  FROM (SELECT o.*, p.* EXCLUDE (l_orderkey, closed_lines, open_lines), {kinds} AS kinds,
               coalesce(closed_lines, 0) AS closed_lines, coalesce(open_lines, 0) AS open_lines
        FROM orders o LEFT JOIN per_order p ON p.l_orderkey = o.o_orderkey)"""


FRAME = [LINES, _per_order(), f"frame AS ({_frame_body()})"]
SPLIT = f"""split_frame AS (
  SELECT *, CASE WHEN bucket < 20 THEN 'test' WHEN bucket < 40 THEN 'validation' ELSE 'train' END AS split
  FROM (SELECT *, CAST('0x' || substr(md5(CAST({KEY} AS VARCHAR)), 1, 8) AS BIGINT) % 100 AS bucket FROM frame))"""
STATS = "st AS (SELECT " + ", ".join(
    f"median({c}) AS md_{c}, min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in SCALED
) + " FROM split_frame WHERE split = 'train')"
IMPUTED = "imputed AS (SELECT " + ", ".join(
    [KEY, "split", *(f"coalesce({c}, md_{c}) AS {c}" for c in SCALED), *X_BINARY, *C_BINARY, *C_TEXT, LABEL]
) + " FROM split_frame, st)"
PREPARED = "prepared AS (SELECT " + ", ".join(
    [
        KEY,
        "split",
        *(f"({c} - lo_{c}) * CASE WHEN hi_{c} = lo_{c} THEN 0 ELSE 1.0::DOUBLE / (hi_{c} - lo_{c}) END AS {c}" for c in SCALED),
        *X_BINARY,
        *C_BINARY,
        *C_TEXT,
        LABEL,
    ]
) + " FROM imputed, st)"
READY = [*FRAME, SPLIT, STATS, IMPUTED, PREPARED]
TEST = "test AS (SELECT * FROM prepared WHERE split = 'test')"

_own = ", ".join(c for c in (KEY, *FEATURES, *CONCEPTS))
ORACLE_SQL["modelling_frame"] = (
    _with(*FRAME, *_wide_parts())
    + f"SELECT {', '.join(f'frame.{c}' for c in (KEY, *FEATURES, *CONCEPTS))}, "
    + ", ".join(f"coalesce(wide.{c}, 0) AS {c}" for c in C_TEXT)
    + f", frame.{LABEL} FROM frame LEFT JOIN wide ON wide.{KEY} = frame.{KEY}"
)
ORACLE_SQL["modelling_csv_source"] = _with(*FRAME) + "SELECT * FROM frame"
ORACLE_SQL["hash_split"] = _with(*FRAME, SPLIT) + f"SELECT {KEY}, split FROM split_frame"
ORACLE_SQL["median_impute"] = _with(*FRAME, SPLIT, STATS, IMPUTED) + f"SELECT {KEY}, split, {', '.join(SCALED)} FROM imputed"
ORACLE_SQL["minmax_scale"] = _with(*READY) + f"SELECT {KEY}, split, {', '.join(SCALED)} FROM prepared"
ORACLE_SQL["describe"] = _with(*FRAME) + " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
  round(min({c}), 4) AS min, round(quantile_cont({c}, 0.25), 4) AS p25, round(median({c}), 4) AS p50,
  round(quantile_cont({c}, 0.75), 4) AS p75, round(max({c}), 4) AS max FROM frame"""
    for c in SCALED
)
ORACLE_SQL["describe_parts"] = ORACLE_SQL["describe"]


def _correlations(source: str) -> str:
    return f"SELECT " + ", ".join(
        f"CASE WHEN stddev_pop({a}) > 0 AND stddev_pop({b}) > 0 THEN corr({a}, {b}) END AS r_{i}_{j}"
        for i, a in enumerate(ALL_CONCEPTS)
        for j, b in enumerate(ALL_CONCEPTS)
        if i < j
    ) + ", " + ", ".join(
        f"CASE WHEN stddev_pop({a}) > 0 THEN 1.0::DOUBLE END AS r_{i}_{i}" for i, a in enumerate(ALL_CONCEPTS)
    ) + f" FROM {source}"


def _r(a: str, b: str) -> str:
    i, j = sorted((ALL_CONCEPTS.index(a), ALL_CONCEPTS.index(b)))
    return f"r_{i}_{j}"


ORACLE_SQL["correlation_long"] = _with(*READY, TEST, f"rr AS ({_correlations('test')})") + " UNION ALL ".join(
    f"SELECT '{a}' AS concept_a, '{b}' AS concept_b, round({_r(a, b)}, 6) AS r FROM rr"
    for a in ALL_CONCEPTS
    for b in ALL_CONCEPTS
)

# --- scoring and evaluation ----------------------------------------------------------------


def _dot(weights, prefix: str = "") -> str:
    return " + ".join(f"{_number(w)} * {c if c in C_TEXT else prefix + c}" for c, w in weights.items())


def _sigmoid(logit: str) -> str:
    return f"(1.0::DOUBLE / (1.0::DOUBLE + exp(-({logit}))))"


def _concepts(model, prefix: str) -> str:
    return ", ".join(
        (_sigmoid(_dot(w)) if c in C_BINARY else f"({_dot(w)})") + f" AS {prefix}{c}" for c, w in model.concepts.items()
    )


def _outcome(probability: str) -> str:
    return (
        f"CASE WHEN {LABEL} = 1 AND {probability} >= 0.5 THEN 'TP' WHEN {LABEL} = 0 AND {probability} < 0.5 THEN 'TN' "
        f"WHEN {LABEL} = 0 AND {probability} >= 0.5 THEN 'FP' WHEN {LABEL} = 1 AND {probability} < 0.5 THEN 'FN' END"
    )


_base, _context = t.base_model(), t.context_model()
SCORED = [
    *READY,
    TEST,
    f"concepts AS (SELECT *, {_concepts(_base, 'base_')}, {_concepts(_context, 'context_')} FROM test)",
    f"probs AS (SELECT *, {_sigmoid(_dot(_base.label.weights, 'base_'))} AS base_prob, "
    f"{_sigmoid(_dot(_context.label.weights, 'context_'))} AS context_prob FROM concepts)",
    f"scored AS (SELECT *, {_outcome('base_prob')} AS base_outcome, {_outcome('context_prob')} AS context_outcome FROM probs)",
]


def _rounds(*names: str) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


ORACLE_SQL["score_logistic"] = _with(*READY, TEST) + f"""
SELECT {KEY}, {LABEL}, round({_sigmoid(_dot(t.plain_model().weights))}, 6) AS y_prob FROM test"""
ORACLE_SQL["score_cbm"] = _with(*SCORED) + f"""
SELECT {KEY}, {LABEL}, {_rounds('base_prob', *('base_' + c for c in CONCEPTS))} FROM scored"""
ORACLE_SQL["score_cbm_context"] = _with(*SCORED) + f"""
SELECT {KEY}, {LABEL}, {_rounds('context_prob', *('context_' + c for c in CONCEPTS))} FROM scored"""
ORACLE_SQL["weights_roundtrip"] = ORACLE_SQL["score_cbm"]
ORACLE_SQL["hard_class"] = """
SELECT l_orderkey, l_linenumber,
  CASE WHEN round(l_discount * 100) / 10 > 0.5 THEN 1 ELSE 0 END AS above,
  CASE WHEN round(l_discount * 100) / 10 >= 0.5 THEN 1 ELSE 0 END AS at_least
FROM lineitem"""
ORACLE_SQL["confusion_counts"] = _with(*SCORED) + f"""
SELECT {LABEL} AS y, CASE WHEN base_prob >= 0.5 THEN 1 ELSE 0 END AS predicted, count(*) AS n FROM scored GROUP BY ALL"""


def _rates_from(truth: str, prediction: str, source: str, group: str | None = None) -> str:
    """Counts of the strict classes; integer division avoided by casting."""
    select = f"{group}, " if group else ""
    grouping = f" GROUP BY {group}" if group else ""

    def count(y: int, test: str) -> str:
        return f"CAST(count(*) FILTER (WHERE {truth} = {y} AND {prediction} {test} 0.5) AS DOUBLE)"

    return (
        f"SELECT {select}{count(1, '>')} AS tp, {count(0, '>')} AS fp, {count(1, '<=')} AS fn, {count(0, '<=')} AS tn "
        f"FROM {source}{grouping}"
    )


_RATE = {
    "precision": "coalesce(tp / nullif(tp + fp, 0), 0)",
    "recall": "coalesce(tp / nullif(tp + fn, 0), 0)",
    "f1": "coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)",
    "auc": "(tp / nullif(tp + fn, 0) + tn / nullif(tn + fp, 0)) / 2",
    "accuracy": "(tp + tn) / (tp + tn + fp + fn)",
}
_RATES = ", ".join(f"{e} AS {n}" for n, e in _RATE.items())
ORACLE_SQL["label_metrics"] = _with(*SCORED, f"k AS ({_rates_from(LABEL, 'base_prob', 'scored')})") + f"SELECT {_RATES} FROM k"
ORACLE_SQL["binary_concept_metrics"] = _with(*SCORED) + " UNION ALL ".join(
    f"SELECT '{c}' AS concept, "
    + ", ".join(f"round({_RATE[m]}, 3) AS {m}" for m in ("precision", "recall", "f1", "accuracy"))
    + f" FROM ({_rates_from(c, 'base_' + c, 'scored')})"
    for c in C_BINARY
)
ORACLE_SQL["continuous_concept_metrics"] = _with(*SCORED) + " UNION ALL ".join(
    f"""SELECT '{c}' AS concept, round(avg(pow({c} - base_{c}, 2)), 3) AS mse, round(avg(abs({c} - base_{c})), 3) AS mae,
  round(sqrt(avg(pow({c} - base_{c}, 2))), 3) AS rmse,
  round(1 - sum(pow({c} - base_{c}, 2)) / sum(pow({c} - m, 2)), 3) AS r2
  FROM scored, (SELECT avg({c}) AS m FROM scored)"""
    for c in C_CONTINUOUS
)


def _information(probability: str) -> str:
    return f"""SELECT round(sum(n / total * ln(n * total / (ny * np))), 6) FROM (
    SELECT CAST(count(*) AS DOUBLE) AS n, CAST(sum(count(*)) OVER () AS DOUBLE) AS total,
           CAST(sum(count(*)) OVER (PARTITION BY {LABEL}) AS DOUBLE) AS ny,
           CAST(sum(count(*)) OVER (PARTITION BY {probability} >= 0.5) AS DOUBLE) AS np
    FROM models GROUP BY {LABEL}, {probability} >= 0.5)"""


ORACLE_SQL["mutual_information"] = _with(*SCORED, "models AS (SELECT * FROM scored)") + (
    f"SELECT ({_information('context_prob')}) AS mutual_information"
)
ORACLE_SQL["outcome_tags"] = _with(*SCORED) + f"SELECT {KEY}, base_outcome, context_outcome FROM scored"
ORACLE_SQL["outcome_diff"] = _with(*SCORED) + " UNION ALL ".join(
    f"(SELECT {KEY}, '{o}' AS outcome FROM scored WHERE context_outcome = '{o}' "
    f"EXCEPT SELECT {KEY}, '{o}' FROM scored WHERE base_outcome = '{o}')"
    for o in ("FN", "FP")
)
_MODELS = {
    "plain": _sigmoid(_dot(t.plain_model().weights)),
    "base": "base_prob",
    "context": "context_prob",
    "true_c": _sigmoid(_dot(t.label_model(4, False).weights)),
    "true_c_text": _sigmoid(_dot(t.label_model(8, True).weights)),
    "pred_c": _sigmoid(_dot(t.label_model(4, False).weights, "base_")),
    "pred_c_text": _sigmoid(_dot(t.label_model(8, True).weights, "context_")),
}
ORACLE_SQL["completeness_table"] = _with(
    *SCORED, "models AS (SELECT *, " + ", ".join(f"{e} AS p_{n}" for n, e in _MODELS.items()) + " FROM scored)"
) + " UNION ALL ".join(
    f"SELECT '{n}' AS model, {_RATES}, ({_information('p_' + n)}) AS mutual_information "
    f"FROM ({_rates_from(LABEL, 'p_' + n, 'models')})"
    for n in _MODELS
)


def _restored(column: str, feature: str) -> str:
    return f"({column} * CASE WHEN hi_{feature} = lo_{feature} THEN 0 ELSE hi_{feature} - lo_{feature} END + lo_{feature})"


_PROFILE = [
    *((c, "feature", _restored(c, c), "NULL") for c in X_CONTINUOUS),
    *((c, "feature", c, "NULL") for c in X_BINARY),
    *((c, "concept", _restored(c, c), _restored("base_" + c, c)) for c in C_CONTINUOUS),
    *((c, "concept", c, "base_" + c) for c in C_BINARY),
    *((c, "text concept", c, "NULL") for c in C_TEXT),
]
ORACLE_SQL["case_profile"] = _with(*SCORED) + " UNION ALL ".join(
    f"SELECT {KEY}, '{n}' AS name, '{k}' AS kind, round(CAST({v} AS DOUBLE), 6) AS value, "
    f"round(CAST({p} AS DOUBLE), 6) AS predicted FROM scored, st"
    for n, k, v, p in _PROFILE
)
ORACLE_SQL["case_compare"] = _with(*SCORED) + f"""
SELECT {KEY}, CASE WHEN base_outcome IN ('FN', 'FP') THEN base_outcome || ' corrected' ELSE context_outcome || ' induced' END AS verdict,
  {_rounds('base_prob', 'context_prob')}
FROM scored WHERE (base_outcome IN ('FN', 'FP')) <> (context_outcome IN ('FN', 'FP'))"""

# --- interventions ------------------------------------------------------------------------------


def _new_values(item, kind: str, start: str) -> dict[str, str]:
    """Every concept's value after the intervention, spelled out."""

    def now(c: str) -> str:
        return c if c in C_TEXT else start + c

    def replaced(c: str) -> str:
        if c in C_TEXT and kind in ("truth", "const"):
            return "1.0::DOUBLE" if item.outcome == "FN" else "0.0::DOUBLE"
        return c if kind == "truth" else f"{'mean' if kind == 'mean' else 'median'}_{c}"

    values = {}
    for c in ALL_CONCEPTS:
        if c in item.concepts:
            values[c] = replaced(c)
        elif c in item.follow:
            moves = " + ".join(f"coalesce({_r(lead, c)}, 0) * ({now(lead)} - {replaced(lead)})" for lead in item.concepts)
            values[c] = f"({now(c)} {'+' if item.sign > 0 else '-'} ({moves}))"
        else:
            values[c] = now(c)
    return values


def _counted(item, kind: str, enhanced: bool, start: str) -> str:
    weights = (_context if enhanced else _base).label.weights
    values = _new_values(item, kind, start)
    probability = _sigmoid(" + ".join(f"{_number(w)} * {values[c]}" for c, w in weights.items()))
    test = ">= 0.5" if item.outcome == "FN" else ("<= 0.5" if item.inclusive else "< 0.5")
    outcome = "context_outcome" if enhanced else "base_outcome"
    return f"""SELECT '{item.name}' AS intervention, '{item.outcome}' AS outcome,
  count(*) FILTER (WHERE {probability} {test}) AS corrected, count(*) AS total,
  CAST(count(*) FILTER (WHERE {probability} {test}) AS DOUBLE) / nullif(count(*), 0) AS ratio
  FROM errors WHERE {outcome} = '{item.outcome}'"""


REPLACEMENTS = "rv AS (SELECT " + ", ".join(
    f"avg({c}) AS mean_{c}, CAST(median({c}) AS DOUBLE) AS median_{c}" for c in ALL_CONCEPTS
) + " FROM test)"

# fixed values: the interventions, stated here apart from the operators so that each guards the other.
# Concepts by number: continuous 0-11, binary 12-13, text 20-27; false negatives first, then false positives.
_SPECS = {
    "intervene_base_binary": ((12, 13), {
        "truth": ((12, 13), (12, 13)), "mean": ((12, 13), (12, 13)), "median": ((12, 13), (12, 13))}),
    "intervene_base_cont": (range(12), {
        "truth": ((2, 3, 5, 10), (1, 2, 11)), "mean": ((3, 5, 6, 10), (8, 11)), "median": ((3, 5, 6, 10), (1, 2, 11))}),
    "intervene_ctx_binary": ((12, 13), {
        "truth": ((12, 13), (12, 13)), "mean": ((12, 13), (12, 13)), "median": ((12, 13), (12, 13))}),
    "intervene_ctx_cont": (range(12), {
        "truth": ((7,), (5, 6, 9)), "mean": ((3, 6), (2, 4, 5, 8)), "median": ((3, 6), (2, 4, 5, 8))}),
    "intervene_text": (range(20, 28), {
        "const": ((20, 21, 25), (20, 22, 26)), "mean": ((20, 26), (20, 21, 26)), "median": ((20, 26), (21, 24))}),
    "intervene_all": ((), {
        "truth": ((12, 7, 20, 21, 25), (12, 5, 6, 9, 20, 22, 26)),
        "mean": ((12, 7, 20, 26), (12, 5, 6, 9, 20, 21, 26)),
        "median": ((12, 7, 20, 26), (12, 5, 6, 9, 21, 24))}),
    "propagate_concept": (range(14), {}),
    "propagate_text": (range(20, 28), {}),
    "propagate_multi": ((), {k: ((1, 12, 25), (12, 13, 26)) for k in ("truth", "mean", "median")}),
    "propagate_base": (range(12), {}),
}
_SET_NAMES = {"intervene_all": "all kinds", "propagate_multi": "several leads"}
_BASE_FAMILIES = ("intervene_base_binary", "intervene_base_cont", "propagate_base")  # judged by the base model
_STRICT = ("intervene_base_binary", "intervene_base_cont")  # a false positive must fall below one half
_EVERYTHING_FOLLOWS = ("propagate_concept", "propagate_text", "propagate_multi")


@dataclass(frozen=True)
class _Item:
    name: str
    outcome: str
    concepts: tuple[str, ...]
    follow: tuple[str, ...]
    sign: int
    inclusive: bool


def _named(number: int) -> str:
    return C_TEXT[number - 20] if number >= 20 else (*C_CONTINUOUS, *C_BINARY)[number]


def _items(family: str, kind: str) -> list[_Item]:
    singles, sets = _SPECS[family]
    follow = ALL_CONCEPTS if family in _EVERYTHING_FOLLOWS else C_CONTINUOUS if family == "propagate_base" else ()
    items = []
    for i, outcome in enumerate(("FN", "FP")):
        sign = -1 if family == "propagate_concept" and outcome == "FP" else 1
        asked = [(_named(n), (n,)) for n in singles]
        if kind in sets:
            asked.append((_SET_NAMES.get(family, "chosen set"), sets[kind][i]))
        items += [
            _Item(name, outcome, tuple(map(_named, numbers)), tuple(follow), sign, family not in _STRICT)
            for name, numbers in asked
        ]
    return items


for _family in _SPECS:
    _correlated = _family.startswith("propagate_")
    _enhanced = _family not in _BASE_FAMILIES
    _start = "context_" if _enhanced and not _correlated else "base_"
    for _kind in ("const" if _family.endswith("_text") else "truth", "mean", "median"):
        _sources = ["scored", *(["rv"] if _kind in ("mean", "median") else []), *(["rr"] if _correlated else [])]
        ORACLE_SQL[f"{_family}_{_kind}"] = _with(
            *SCORED,
            *([REPLACEMENTS] if "rv" in _sources else []),
            *([f"rr AS ({_correlations('test')})"] if _correlated else []),
            f"errors AS MATERIALIZED (SELECT * FROM {', '.join(_sources)})",
        ) + " UNION ALL ".join(_counted(i, _kind, _enhanced, _start) for i in _items(_family, _kind))

ORACLE_SQL["flip_listing"] = _with(
    *SCORED,
    "flipped AS (SELECT *, "
    + _sigmoid(
        " + ".join(
            f"{_number(w)} * {c if c in C_TEXT or c == C_BINARY[0] else 'context_' + c}"
            for c, w in _context.label.weights.items()
        )
    )
    + " AS new_prob FROM scored)",
) + f"""
SELECT {KEY}, context_outcome AS outcome, '{C_BINARY[0]}' AS intervention, round(new_prob, 6) AS new_prob
FROM flipped WHERE (context_outcome = 'FN' AND new_prob >= 0.5) OR (context_outcome = 'FP' AND new_prob <= 0.5)"""

# --- fits: loss and slopes at fixed weights, spelled out per weight -------------------------------

_TRAIN = "train AS MATERIALIZED (SELECT * FROM prepared WHERE split = 'train')"


def _rows(model: str, values: dict[tuple[str, str], str], source: str) -> str:
    """One aggregate of all values, then a row for each."""
    names = {pair: f"v{i}" for i, pair in enumerate(values)}
    return f", a AS MATERIALIZED (SELECT {', '.join(f'{values[p]} AS {n}' for p, n in names.items())} FROM {source}) " + (
        " UNION ALL ".join(
            f"SELECT '{model}' AS model, '{src}' AS src, '{dst}' AS dst, round({n}, 6) AS slope FROM a"
            for (src, dst), n in names.items()
        )
    )


def _cross_entropy(target: str, probability: str) -> str:
    return f"-({target} * ln({probability}) + (1 - {target}) * ln(1 - {probability}))"


_plain = t.plain_model().weights
ORACLE_SQL["logistic_slopes"] = _with(
    *READY, _TRAIN, f"p AS MATERIALIZED (SELECT *, {_sigmoid(_dot(_plain))} AS p FROM train)"
) + _rows(
    "plain",
    {
        ("loss", LABEL): f"avg({_cross_entropy(LABEL, 'p')}) + 0.00005e0 * {_number(sum(w * w for w in _plain.values()))}",
        **{(f, LABEL): f"avg((p - {LABEL}) * {f}) + 0.0001e0 * {_number(w)}" for f, w in _plain.items()},
    },
    "p",
)


def _joint(name: str, model) -> str:
    label = model.label.weights
    losses = [_cross_entropy(LABEL, "p")]
    losses += [f"{0.5 / len(C_BINARY)!r}e0 * ({_cross_entropy(c, 'q_' + c)})" for c in C_BINARY]
    losses += [f"{0.5 / len(C_CONTINUOUS)!r}e0 * pow(q_{c} - {c}, 2)" for c in C_CONTINUOUS]
    into = {
        c: f"((p - {LABEL}) * {_number(label[c])} * q_{c} * (1 - q_{c}) + {0.5 / len(C_BINARY)!r}e0 * (q_{c} - {c}))"
        for c in C_BINARY
    } | {
        c: f"((p - {LABEL}) * {_number(label[c])} + {0.5 * 2 / len(C_CONTINUOUS)!r}e0 * (q_{c} - {c}))" for c in C_CONTINUOUS
    }
    in_train = "FILTER (WHERE split = 'train')"
    values = {
        ("loss", "train"): f"avg({' + '.join(losses)}) {in_train}",
        ("loss", "validation"): f"avg({' + '.join(losses)}) FILTER (WHERE split = 'validation')",
        **{(f, c): f"avg({f} * d_{c}) {in_train}" for f in FEATURES for c in CONCEPTS},
        **{(c, LABEL): f"avg((p - {LABEL}) * {c if c in C_TEXT else 'q_' + c}) {in_train}" for c in label},
    }
    return _with(
        *READY,
        f"q AS (SELECT *, {_concepts(model, 'q_')} FROM prepared WHERE split IN ('train', 'validation'))",
        f"p AS (SELECT *, {_sigmoid(_dot(label, 'q_'))} AS p FROM q)",
        f"d AS MATERIALIZED (SELECT *, {', '.join(f'{e} AS d_{c}' for c, e in into.items())} FROM p)",
    ) + _rows(name, values, "d")


ORACLE_SQL["joint_slopes"] = _joint("base", _base)
ORACLE_SQL["joint_slopes_context"] = _joint("context", _context)
ORACLE_SQL["fits_at_minimum"] = " UNION ALL ".join(
    f"SELECT '{model}' AS model, '{src}' AS src, '{LABEL}' AS dst, 0.0::DOUBLE AS slope"
    for model, names in (("plain", FEATURES), ("c_to_y_plain", CONCEPTS), ("c_to_y_with_text", ALL_CONCEPTS))
    for src in names
)
ORACLE_SQL["sequential_fits_at_minimum"] = " UNION ALL ".join(
    f"SELECT '{model}' AS model, '{src}' AS src, '{dst}' AS dst, 0.0::DOUBLE AS slope"
    for model, names in (("base", CONCEPTS), ("context", ALL_CONCEPTS))
    for src, dst in [*((f, c) for f in FEATURES for c in CONCEPTS), *((n, LABEL) for n in names)]
)
