"""Pinned record schemas and the fixed code tables of the encounter domain.

Everything in this module is data, not logic: column names, column order and
the value -> code maps that must equal the reference application's for the
scores to mean the same thing.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: the 50 encounter columns, in wire order (D1) -------------
ENCOUNTER_COLUMNS: list[str] = [
    "encounter_id", "patient_nbr", "race", "gender", "age", "weight",
    "admission_type_id", "discharge_disposition_id", "admission_source_id",
    "time_in_hospital", "payer_code", "medical_specialty", "num_lab_procedures",
    "num_procedures", "num_medications", "number_outpatient", "number_emergency",
    "number_inpatient", "diag_1", "diag_2", "diag_3", "number_diagnoses",
    "max_glu_serum", "A1Cresult", "metformin", "repaglinide", "nateglinide",
    "chlorpropamide", "glimepiride", "acetohexamide", "glipizide", "glyburide",
    "tolbutamide", "pioglitazone", "rosiglitazone", "acarbose", "miglitol",
    "troglitazone", "tolazamide", "examide", "citoglipton", "insulin",
    "glyburide-metformin", "glipizide-metformin", "glimepiride-pioglitazone",
    "metformin-rosiglitazone", "metformin-pioglitazone", "change",
    "diabetesMed", "readmitted",
]
TARGET_COLUMN = "readmitted"
ID_COLUMNS = ["encounter_id", "patient_nbr"]

# the 49 model features = D1 minus the target, same order.
FEATURE_COLUMNS: list[str] = [c for c in ENCOUNTER_COLUMNS if c != TARGET_COLUMN]

ENCOUNTER_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType(), True) for c in ENCOUNTER_COLUMNS]
)

# Vitals record.
VITALS_SCHEMA = T.StructType([
    T.StructField("patient_id", T.StringType(), True),
    T.StructField("age", T.IntegerType(), True),
    T.StructField("gender", T.StringType(), True),
    T.StructField("blood_pressure", T.DoubleType(), True),
    T.StructField("readmitted", T.StringType(), True),
])

# Narrow prediction record (types pinned here; the reference's CSV
# flip-flopped between int and float text per batch).
PROBABILITY_COLUMN = "readmission_probability_pct"
PROBABILITY_CSV_NAME = "readmission_probability(%)"
PREDICTION_NARROW_SCHEMA = T.StructType([
    T.StructField("encounter_id", T.LongType(), True),
    T.StructField("patient_nbr", T.LongType(), True),
    T.StructField("age", T.IntegerType(), True),
    T.StructField("gender", T.IntegerType(), True),
    T.StructField("race", T.IntegerType(), True),
    T.StructField("time_in_hospital", T.IntegerType(), True),
    T.StructField("readmission_prediction", T.IntegerType(), True),
    T.StructField(PROBABILITY_COLUMN, T.DoubleType(), True),
])

# --- Fixed values: value -> code maps and their defaults (table 2.3.1) -------
# (column, {text: code}, default for unknown or null)
GENDER_MAP = {"Male": 1, "Female": 0, "Unknown/Invalid": -1}
RACE_MAP = {"Caucasian": 0, "AfricanAmerican": 1, "Hispanic": 2, "Asian": 3, "Other": 4}
AGE_MAP = {
    "[0-10)": 5, "[10-20)": 15, "[20-30)": 25, "[30-40)": 35, "[40-50)": 45,
    "[50-60)": 55, "[60-70)": 65, "[70-80)": 75, "[80-90)": 85, "[90-100)": 95,
}
CHANGE_MAP = {"Ch": 1, "No": 0}
DIABETES_MED_MAP = {"Yes": 1, "No": 0}
INSULIN_MAP = {"No": 0, "Steady": 1, "Up": 2, "Down": 3}

VALUE_MAPS: dict[str, tuple[dict[str, int], int]] = {
    "gender": (GENDER_MAP, -1),
    "race": (RACE_MAP, 0),
    "age": (AGE_MAP, 0),
    "change": (CHANGE_MAP, 0),
    "diabetesMed": (DIABETES_MED_MAP, 0),
    "insulin": (INSULIN_MAP, 0),
}

# Text features without a value map: the serving path of the reference turns
# them into 0; `operators.clean.apply_text_codes` gives them training codes.
UNMAPPED_TEXT_COLUMNS: list[str] = [
    c for c in FEATURE_COLUMNS[FEATURE_COLUMNS.index("metformin"):FEATURE_COLUMNS.index("change")]
    if c != "insulin"
] + ["weight", "payer_code", "medical_specialty", "max_glu_serum", "A1Cresult"]

# Null markers: literal '?' from the form and the CSV; text "NaN" is what a
# bare NaN token becomes after JSON parsing into a string field.
NULL_MARKERS = ["?", "NaN", "nan"]

# --- Fixed values: record defaults of the submission form (P22) -------------
RECORD_DEFAULTS: dict[str, str] = {
    "weight": "?", "payer_code": "?", "medical_specialty": "?",
    "max_glu_serum": "None", "A1Cresult": "None",
    "metformin": "No", "repaglinide": "No", "nateglinide": "No",
    "chlorpropamide": "No", "glimepiride": "No", "acetohexamide": "No",
    "glipizide": "No", "glyburide": "No", "tolbutamide": "No",
    "pioglitazone": "No", "rosiglitazone": "No", "acarbose": "No",
    "miglitol": "No", "troglitazone": "No", "tolazamide": "No",
    "examide": "No", "citoglipton": "No",
    "glyburide-metformin": "No", "glipizide-metformin": "No",
    "glimepiride-pioglitazone": "No", "metformin-rosiglitazone": "No",
    "metformin-pioglitazone": "No", "change": "No", "diabetesMed": "Yes",
    "readmitted": "?",
}

# --- Fixed values: domain rules of the input form (P23) ---------------------
RACE_VALUES = ["Caucasian", "AfricanAmerican", "Hispanic", "Asian", "Other", "?"]
GENDER_VALUES = ["Male", "Female", "Unknown/Invalid"]
AGE_VALUES = list(AGE_MAP) + ["?"]
INSULIN_VALUES = ["No", "Steady", "Up", "Down"]
FORM_RANGES: dict[str, tuple[int, int]] = {
    "time_in_hospital": (1, 30),
    "num_lab_procedures": (0, 150),
    "num_procedures": (0, 10),
    "num_medications": (0, 100),
    "number_outpatient": (0, 50),
    "number_emergency": (0, 50),
    "number_inpatient": (0, 50),
    "number_diagnoses": (1, 20),
}
ADMISSION_TYPE_VALUES = ["1", "3", "2", "5", "6", "8", "4", "7", "?"]
DISCHARGE_DISPOSITION_VALUES = ["1", "3", "6", "2", "5", "18", "4", "11", "7", "?"]
ADMISSION_SOURCE_VALUES = ["7", "1", "4", "6", "2", "17", "3", "5", "9", "?"]

# Second rule set: the one-row numeric scoring profile (F7). Ranges differ
# from the intake form on purpose; both are kept as named profiles.
PROFILE_RANGES: dict[str, tuple[int, int]] = {
    "age": (0, 100),
    "time_in_hospital": (1, 14),
    "num_lab_procedures": (0, 150),
    "num_procedures": (0, 20),
    "num_medications": (0, 100),
    "number_outpatient": (0, 20),
    "number_emergency": (0, 10),
    "number_inpatient": (0, 10),
}
PROFILE_COLUMNS = [
    "gender", "age", "admission_type_id", "discharge_disposition_id",
    "time_in_hospital", "num_lab_procedures", "num_procedures",
    "num_medications", "number_outpatient", "number_emergency", "number_inpatient",
]
# Legacy label -> id codes of the scoring profile; they contradict the code
# lookup file and are kept only as the `legacy` profile.
LEGACY_ADMISSION_TYPE = {"Emergency": 1, "Urgent": 2, "Elective": 3, "Newborn": 4, "Trauma": 5}
LEGACY_DISCHARGE = {"Home": 1, "Transferred": 2, "Expired": 3, "Rehab": 4}

# Class code -> display label.
HIGH_RISK_CLASS = 1
READMITTED_LABEL = "Readmitted"
NOT_READMITTED_LABEL = "Not Readmitted"


def quote(name: str) -> str:
    """Backtick a column name for SQL / expr strings (names contain '-' and '(%)')."""
    return "`" + name.replace("`", "``") + "`"
