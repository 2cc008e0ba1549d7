"""The outcome record: field names, raw headers, types, features and class labels."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values: (column, raw CSV header, type) of the 36 numeric inputs, in record order.
NUMERIC_FIELDS = [
    ("marital_status", "Marital status", "int"),
    ("gender", "Gender", "int"),
    ("age_at_enrollment", "Age at enrollment", "int"),
    ("international", "International", "int"),
    ("displaced", "Displaced", "int"),
    ("educational_special_needs", "Educational special needs", "int"),
    ("nacionality", "Nacionality", "int"),
    ("mothers_qualification", "Mother's qualification", "int"),
    ("fathers_qualification", "Father's qualification", "int"),
    ("mothers_occupation", "Mother's occupation", "int"),
    ("fathers_occupation", "Father's occupation", "int"),
    ("scholarship_holder", "Scholarship holder", "int"),
    ("debtor", "Debtor", "int"),
    ("tuition_fees_up_to_date", "Tuition fees up to date", "int"),
    ("application_mode", "Application mode", "int"),
    ("application_order", "Application order", "int"),
    ("course", "Course", "int"),
    ("daytime_evening_attendance", "Daytime/evening attendance", "int"),
    ("previous_qualification", "Previous qualification", "int"),
    ("previous_qualification_grade", "Previous qualification (grade)", "double"),
    ("admission_grade", "Admission grade", "double"),
    ("curricular_units_1st_sem_credited", "Curricular units 1st sem (credited)", "int"),
    ("curricular_units_1st_sem_enrolled", "Curricular units 1st sem (enrolled)", "int"),
    ("curricular_units_1st_sem_evaluations", "Curricular units 1st sem (evaluations)", "int"),
    ("curricular_units_1st_sem_approved", "Curricular units 1st sem (approved)", "int"),
    ("curricular_units_1st_sem_grade", "Curricular units 1st sem (grade)", "double"),
    (
        "curricular_units_1st_sem_without_evaluations",
        "Curricular units 1st sem (without evaluations)",
        "int",
    ),
    ("curricular_units_2nd_sem_credited", "Curricular units 2nd sem (credited)", "int"),
    ("curricular_units_2nd_sem_enrolled", "Curricular units 2nd sem (enrolled)", "int"),
    ("curricular_units_2nd_sem_evaluations", "Curricular units 2nd sem (evaluations)", "int"),
    ("curricular_units_2nd_sem_approved", "Curricular units 2nd sem (approved)", "int"),
    ("curricular_units_2nd_sem_grade", "Curricular units 2nd sem (grade)", "double"),
    (
        "curricular_units_2nd_sem_without_evaluations",
        "Curricular units 2nd sem (without evaluations)",
        "int",
    ),
    ("unemployment_rate", "Unemployment rate", "double"),
    ("inflation_rate", "Inflation rate", "double"),
    ("gdp", "GDP", "double"),
]

# The class column, its names and its codes.
TARGET = "target"
TARGET_HEADER = "Target"
LABELS = {"Dropout": 0, "Enrolled": 1, "Graduate": 2}
UNKNOWN_LABEL = -1
CLASS_COUNT = 3

# Derived columns, and the stored inputs that are not used as features.
DERIVED = [
    "pass_rate_1st_sem",
    "pass_rate_2nd_sem",
    "grade_delta",
    "financial_stability_index",
]
NOT_FEATURES = {
    "curricular_units_1st_sem_without_evaluations",
    "curricular_units_2nd_sem_without_evaluations",
}

# Columns of the dashboard export.
DASHBOARD_COLUMNS = [
    "marital_status",
    "gender",
    "age_at_enrollment",
    "financial_stability_index",
    "grade_delta",
    "target",
    "prediction",
    "label",
]

# The random seed and the rows of one batch of the small replays.
SEED = 42
BATCH_ROWS = 5000

# Rows of one file where nothing else is asked for: some hundred bytes each, so about a block.
FILE_ROWS = 1_000_000

NUMERIC_NAMES = [name for name, _, _ in NUMERIC_FIELDS]
REQUIRED = [*NUMERIC_NAMES, TARGET]
FEATURES = [name for name in NUMERIC_NAMES if name not in NOT_FEATURES] + DERIVED
HEADERS = {header: name for name, header, _ in NUMERIC_FIELDS} | {TARGET_HEADER: TARGET}
PERSISTED = [*NUMERIC_NAMES, *DERIVED, TARGET, "label", "event_ts_ms"]

_TYPES = {"int": T.IntegerType(), "double": T.DoubleType()}

# The record as it travels in a message; the last two fields may be absent.
RECORD = T.StructType(
    [T.StructField(name, _TYPES[kind]) for name, _, kind in NUMERIC_FIELDS]
    + [
        T.StructField(TARGET, T.StringType()),
        T.StructField("event_id", T.StringType()),
        T.StructField("event_ts_ms", T.LongType()),
    ]
)
OPTIONAL_DEFAULTS = {"event_id": "", "event_ts_ms": 0}

# The record as the raw delimited file holds it.
RAW_RECORD = T.StructType(RECORD.fields[: len(REQUIRED)])

MESSAGE = T.StructType(
    [T.StructField("key", T.StringType()), T.StructField("value", T.StringType())]
)

RUN_REPORT = T.StructType(
    [
        T.StructField("impl", T.StringType()),
        T.StructField("target_rate", T.LongType()),
        T.StructField("scale_factor", T.LongType()),
        T.StructField("total_sent", T.LongType()),
        T.StructField("total_errors", T.LongType()),
        T.StructField("total_time_s", T.DoubleType()),
        T.StructField("avg_rate", T.DoubleType()),
        T.StructField(
            "latency_us",
            T.StructType(
                [T.StructField("p50", T.LongType()), T.StructField("p99", T.LongType())]
            ),
        ),
    ]
)

# Columns of the result files.
MODEL_METRICS = ["model", "accuracy", "precision", "recall", "f1_score", "training_time_s"]
GATE_SUMMARY = ["metric", "label", "value", "unit", "operator", "target", "passed"]
