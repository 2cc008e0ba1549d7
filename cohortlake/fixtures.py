"""Deterministic views over the driver's tables that stand in for the raw dataset.

The SQL text uses integer arithmetic only, so Spark and the oracle engine run the same
expressions. ``students`` has one row per order and is a pure projection of the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortlake.schema import NUMERIC_FIELDS

# Fixed values: (column, rule, arguments); ``I`` = (modulus, first), ``D`` = (modulus, divisor,
# first), ``APPROVED`` and ``GRADE`` = (salt of the enrolled count). The salt is the row number.
_RULES = [
    ("marital_status", "I", (6, 1)),
    ("gender", "I", (2, 0)),
    ("age_at_enrollment", "I", (60, 15)),
    ("international", "I", (2, 0)),
    ("displaced", "I", (2, 0)),
    ("educational_special_needs", "I", (2, 0)),
    ("nacionality", "I", (21, 1)),
    ("mothers_qualification", "I", (44, 1)),
    ("fathers_qualification", "I", (44, 1)),
    ("mothers_occupation", "I", (46, 0)),
    ("fathers_occupation", "I", (46, 0)),
    ("scholarship_holder", "I", (2, 0)),
    ("debtor", "I", (2, 0)),
    ("tuition_fees_up_to_date", "I", (2, 0)),
    ("application_mode", "I", (57, 1)),
    ("application_order", "I", (10, 0)),
    ("course", "I", (17, 1)),
    ("daytime_evening_attendance", "I", (2, 0)),
    ("previous_qualification", "I", (43, 1)),
    ("previous_qualification_grade", "D", (950, 10, 95)),
    ("admission_grade", "D", (950, 10, 95)),
    ("curricular_units_1st_sem_credited", "I", (20, 0)),
    ("curricular_units_1st_sem_enrolled", "I", (8, 0)),
    ("curricular_units_1st_sem_evaluations", "I", (20, 0)),
    ("curricular_units_1st_sem_approved", "APPROVED", (23,)),
    ("curricular_units_1st_sem_grade", "GRADE", (23,)),
    ("curricular_units_1st_sem_without_evaluations", "I", (12, 0)),
    ("curricular_units_2nd_sem_credited", "I", (20, 0)),
    ("curricular_units_2nd_sem_enrolled", "I", (8, 0)),
    ("curricular_units_2nd_sem_evaluations", "I", (20, 0)),
    ("curricular_units_2nd_sem_approved", "APPROVED", (29,)),
    ("curricular_units_2nd_sem_grade", "GRADE", (29,)),
    ("curricular_units_2nd_sem_without_evaluations", "I", (12, 0)),
    ("unemployment_rate", "D", (90, 10, 7)),
    ("inflation_rate", "D", (45, 10, -1)),
    ("gdp", "D", (800, 100, -4)),
]

_K = "o_orderkey"
_Y = "(case o_orderstatus when 'F' then 0 when 'O' then 1 else 2 end)"


def _hash(salt: int) -> str:
    return f"(((({_K} * {1000003 + 2 * salt}) % 2147483647) * 48271) % 2147483647)"


def _formula(salt: int, rule: str, args: tuple) -> str:
    if rule == "I":
        modulus, first = args
        return f"cast({first} + {_hash(salt)} % {modulus} as int)"
    if rule == "D":
        modulus, divisor, first = args
        return (
            f"({first} + cast({_hash(salt)} % {modulus} as double) / cast({divisor} as double))"
        )
    enrolled = f"({_hash(args[0])} % 8)"
    if rule == "APPROVED":
        return (
            f"cast(floor(cast({enrolled} * ({_Y} + 1) as double) / cast(3 as double)) as int)"
        )
    drawn = f"(10 + cast({_hash(salt)} % 600 as double) / cast(100 as double))"
    return f"(case when {enrolled} = 0 then cast(0 as double) else {drawn} + {_Y} end)"


def student_columns() -> dict[str, str]:
    """Column name to portable SQL expression over ``orders``."""
    columns = {
        name: _formula(position, rule, args)
        for position, (name, rule, args) in enumerate(_RULES, start=1)
    }
    columns["event_seq"] = _K
    columns["target"] = (
        f"case when {_K} % 97 = 0 then 'Unknown' when {_Y} = 0 then 'Dropout' "
        f"when {_Y} = 1 then 'Enrolled' else 'Graduate' end"
    )
    columns["event_ts_ms"] = (
        f"case when {_K} % 11 = 0 then cast(0 as bigint) else 1670000000000 + {_K} end"
    )
    return columns


def students(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """The 39-column record view over ``orders``.

    ``partitions`` deals a scan of few splits, two narrow columns, into so many tasks before the
    costly per-row work of encoding, parsing or writing whole records.
    """
    assert [rule[0] for rule in _RULES] == [field[0] for field in NUMERIC_FIELDS]
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_orderstatus")
    rows = orders.repartition(partitions) if partitions else orders
    return rows.selectExpr(*(f"{sql} as {name}" for name, sql in student_columns().items()))


# Portable expressions over ``events`` for one simulated send per event. The queue wait is what a
# send spends before it leaves, the send time follows from the event's value.
SEND_US = "cast(floor(value * 1000) as bigint)"
QUEUE_US = "(event_id % 977)"
SEND_OK = "(event_type <> 'error')"
TARGET_RATE = "(case user_id % 4 when 0 then 0 when 1 then 100 when 2 then 500 else 1000 end)"
SCALE_FACTOR = "(case user_id % 3 when 0 then 1 when 1 then 5 else 10 end)"


def epoch_us(ts: str) -> str:
    """Microseconds of a zone-free time since 1970, whatever the session's time zone is."""
    age = f"({ts} - timestamp_ntz'1970-01-01 00:00:00')"
    return (
        f"(extract(day from {age}) * 86400000000L + extract(hour from {age}) * 3600000000L"
        f" + extract(minute from {age}) * 60000000L"
        f" + cast(extract(second from {age}) * 1000000 as bigint))"
    )


def sends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per simulated send: run key, outcome, time in microseconds and durations."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.selectExpr(
        "event_id",
        f"cast({TARGET_RATE} as bigint) as target_rate",
        f"cast({SCALE_FACTOR} as bigint) as scale_factor",
        f"{SEND_OK} as ok",
        f"{epoch_us('ts')} as ts_us",
        f"{SEND_US} as send_us",
        f"{QUEUE_US} as queue_us",
    )
