"""They define the results and must not be changed.

Column groups of the modelling frame, diagnosis-code groups, text-concept
prompts and the intervention sets studied.
"""

from __future__ import annotations

# --- fixed values: columns of the modelling frame -------------------------

KEY = "hadm_id"
LABEL = "ARDS_DIAGNOSIS"

X_CONTINUOUS = (
    "max_norepinephrine_equiv",
    "avg_norepinephrine_equiv",
    "sofa_cardiovascular_avg_meanbp",
    "sofa_cardiovascular_avg_rate_norepinephrine",
    "sofa_respiration_avg_pao2fio2ratio",
    "sofa_renal_avg_urineoutput",
    "sofa_renal_avg_creatinine",
    "sofa_cns_avg_gcs",
    "first24hr_cardiovascular_meanbp",
    "sofa_cardiovascular_worst_meanbp",
    "sofa_cardiovascular_worst_rate_norepinephrine",
    "sofa_respiration_worst_pao2fio2ratio",
    "sofa_renal_worst_urineoutput",
    "sofa_cns_worst_gcs",
    "mech_vent_duration_minutes",
)

X_BINARY = (
    "other_respiratory_diseases",
    "lung_diseases_due_to_external_agents",
    "chronic_lower_respiratory_diseases",
    "acute_lower_respiratory_infections",
    "influenza_pneumonia",
    "upper_respiratory_infections",
)

C_CONTINUOUS = (
    "c_sofa_avg_cardiovascular",
    "c_sofa_avg_respiration",
    "c_sofa_avg_renal",
    "c_sofa_avg_cns",
    "c_first24hr_sofa_max_cardiovascular",
    "c_first24hr_sofa_max_respiration",
    "c_first24hr_sofa_max_renal",
    "c_first24hr_sofa_max_cns",
    "c_sofa_max_cardiovascular",
    "c_sofa_max_respiration",
    "c_sofa_max_renal",
    "c_sofa_max_cns",
)

C_BINARY = ("c_svr_resp_comorbidity", "c_mod_resp_comorbidity")

C_TEXT = (
    "ards_detected",
    "aspiration_detected",
    "bilateral_infiltrates_detected",
    "cardiac_arrest_detected",
    "cardiac_failure_detected",
    "pancreatitis_detected",
    "pneumonia_detected",
    "trali_detected",
)

# --- fixed values: diagnosis-code groups over the first three characters ---
# flag: (ICD-9 rule, ICD-10 rule); a rule is an inclusive range or a set.

RESPIRATORY_CODE_GROUPS = {
    "upper_respiratory_infections": (("460", "466"), ("J00", "J06")),
    "influenza_pneumonia": (
        frozenset({"480", "481", "482", "483", "484", "485", "486", "487"}),
        ("J09", "J18"),
    ),
    "acute_lower_respiratory_infections": (("466", "469"), ("J20", "J22")),
    "chronic_lower_respiratory_diseases": (("490", "496"), ("J40", "J47")),
    "lung_diseases_due_to_external_agents": (("500", "508"), ("J60", "J70")),
    "other_respiratory_diseases": (("510", "519"), ("J80", "J99")),
}

INVASIVE_STATUS = "InvasiveVent"
FIRST_DAY_HOURS = 24
REPORT_COLUMNS = 18
NOTE_SEPARATOR = " ||| "
ID_SEPARATOR = ", "

# --- fixed values: chunking and answers of the text labeller ----------------

CHUNK_SIZE = 4096
CHUNK_OVERLAP = 100
YES = "Yes"
NO = "No"
NO_ANSWER = "No sufficient data"
NO_RADIOLOGY = "No radiology text available"
LABELLER_ERROR = "Error invoking model: "

# --- fixed values: prompts, one per text concept ----------------------------

PROMPTS = {
    "ards_detected": (
        "Context: You are a clinician receiving chunks of clinical text for patients in an ICU.\n"
        "Task: Determine if the patient had ARDS (acute respiratory distress syndrome).\n"
        "Instructions: Answer with 'Yes' or 'No'. If there is not enough information, answer 'No'.\n"
        "Discharge Text:\n{text}\n\n"
        "Query: Does the chunk of text state that the patient has ARDS (acute respiratory distress syndrome) or got treatment for ARDS? Answer strictly in 'Yes' or 'No'."
    ),
    "aspiration_detected": (
        "Context: You are a clinician receiving chunks of clinical text for patients in an ICU. Please do the reviewing as quickly as possible.\n"
        "Task: Determine if the patient suffered from aspiration.\n"
        "Instructions: Answer with 'Yes' or 'No'. If there is not enough information, answer 'No'.\n"
        "Discharge Text:\n{text}\n\n"
        "Query: Does the chunk of text mention that the patient suffered from aspiration? Answer strictly in 'Yes' or 'No'."
    ),
    "bilateral_infiltrates_detected": (
        "Context: You are a clinician receiving chunks of radiology reports for patients in an ICU. Please do the reviewing as quickly as possible.\n"
        "Task: Determine if the patient suffered from bilateral infiltrates.\n"
        "Instructions: Answer with 'Yes' or 'No'. If there is not enough information, answer 'No'.\n"
        "Discharge Text:\n{text}\n\n"
        "Query: Does the chunk of text mention that the patient suffered from bilateral infiltrates? Answer strictly in 'Yes' or 'No'."
    ),
    "cardiac_arrest_detected": (
        "Context: You are a clinician receiving chunks of clinical text for patients in an ICU. Please do the reviewing as quickly as possible.\n"
        "Task: Determine if the patient suffered from cardiac arrest.\n"
        "Instructions: Answer with 'Yes' or 'No'. If there is not enough information, answer 'No'.\n"
        "Discharge Text:\n{text}\n\n"
        "Query: Does the chunk of text mention that the patient suffered from cardiac arrest? Answer strictly in 'Yes' or 'No'."
    ),
    "cardiac_failure_detected": (
        "Context: You are a clinician receiving chunks of clinical text for patients in an ICU. Please do the reviewing as quickly as possible.\n"
        "Task: Determine if the patient suffered from cardiac failure.\n"
        "Instructions: Answer with 'Yes' or 'No'. If there is not enough information, answer 'No'.\n"
        "Text:\n{text}\n\n"
        "Query: Does the chunk of text mention that the patient suffered from cardiac failure? Answer strictly in 'Yes' or 'No'."
    ),
    "pancreatitis_detected": (
        "Context: You are a clinician receiving chunks of clinical text for patients in an ICU. Please do the reviewing as quickly as possible.\n"
        "Task: Determine if the patient suffered from pancreatitis.\n"
        "Instructions: Answer with 'Yes' or 'No'. If there is not enough information, answer 'No'.\n"
        "Discharge Text:\n{text}\n\n"
        "Query: Does the chunk of text mention that the patient suffered from pancreatitis? Answer strictly in 'Yes' or 'No'."
    ),
    "pneumonia_detected": (
        "Context: You are a clinician receiving chunks of clinical text for patients in an ICU. Please do the reviewing as quickly as possible.\n"
        "Task: Determine if the patient had pneumonia.\n"
        "Instructions: Answer with 'Yes' or 'No'. If there is not enough information, answer 'No'.\n"
        "Discharge Text:\n{text}\n\n"
        "Query: Does the chunk of text suggest that the patient has pneumonia? Answer strictly in 'Yes' or 'No'."
    ),
    "trali_detected": (
        "Context: You are a clinician receiving chunks of clinical text for patients in an ICU. Please do the reviewing as quickly as possible.\n"
        "Task: Determine if the patient suffered from transfusion-related acute lung injury (TRALI).\n"
        "Instructions: Answer with 'Yes' or 'No'. If there is not enough information, answer 'No'.\n"
        "Discharge Text:\n{text}\n\n"
        "Query: Does the chunk of text mention that the patient suffered from transfusion-related acute lung injury (TRALI)? Answer strictly in 'Yes' or 'No'."
    ),
}

# text columns read for each concept, in the order they are tried
TEXT_SOURCES = {
    "ards_detected": ("discharge_text",),
    "aspiration_detected": ("discharge_text",),
    "bilateral_infiltrates_detected": ("radiology_texts",),
    "cardiac_arrest_detected": ("discharge_text",),
    "cardiac_failure_detected": ("ecd_combined_reports", "discharge_text"),
    "pancreatitis_detected": ("discharge_text",),
    "pneumonia_detected": ("discharge_text",),
    "trali_detected": ("discharge_text",),
}

# concepts whose label is unknown, not no, where the text is missing
NULL_IF_EMPTY = ("bilateral_infiltrates_detected",)

# --- fixed values: fitting ---------------------------------------------------

CONCEPT_LOSS_WEIGHT = 0.5
LOGISTIC_WEIGHT_DECAY = 1e-4
JOINT_WEIGHT_DECAY = 1e-4
SEQUENTIAL_WEIGHT_DECAY = 1e-3
CONCEPT_LABEL_WEIGHT_DECAY = {"plain": 1e-4, "with_text": 8e-5}
TEST_PERCENT = 20
VALIDATION_PERCENT = 20

# --- fixed values: concept sets replaced together ----------------------------
# numbered as in the frame: continuous concepts 0-11, binary 12-13, text 0-7;
# (set tried on false negatives, set tried on false positives)

BASE_BINARY_SETS = {"truth": ((12, 13), (12, 13)), "mean": ((12, 13), (12, 13)), "median": ((12, 13), (12, 13))}
BASE_CONTINUOUS_SETS = {
    "truth": ((2, 3, 5, 10), (1, 2, 11)),
    "mean": ((3, 5, 6, 10), (8, 11)),
    "median": ((3, 5, 6, 10), (1, 2, 11)),
}
CONTEXT_BINARY_SETS = {"truth": ((12, 13), (12, 13)), "mean": ((12, 13), (12, 13)), "median": ((12, 13), (12, 13))}
CONTEXT_CONTINUOUS_SETS = {
    "truth": ((7,), (5, 6, 9)),
    "mean": ((3, 6), (2, 4, 5, 8)),
    "median": ((3, 6), (2, 4, 5, 8)),
}
TEXT_SETS = {
    "const": ((0, 1, 5), (0, 2, 6)),
    "mean": ((0, 6), (0, 1, 6)),
    "median": ((0, 6), (1, 4)),
}
# (binary, continuous, text) for false negatives, then for false positives
ALL_KINDS_SETS = {
    "truth": (((12,), (7,), (0, 1, 5)), ((12,), (5, 6, 9), (0, 2, 6))),
    "mean": (((12,), (7,), (0, 6)), ((12,), (5, 6, 9), (0, 1, 6))),
    "median": (((12,), (7,), (0, 6)), ((12,), (5, 6, 9), (1, 4))),
}
# leads changed together, their text lead last: false negatives, false positives
MULTI_LEADS = (((1, 12), 5), ((12, 13), 6))
SINGLE_FLIP_CONCEPT = 12
