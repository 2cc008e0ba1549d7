"""Spoiled inputs derived from the record view: cells and messages that a reader must cope with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlake import schema
from cohortlake.operators import replay
from cohortlake.sources import messages

START_MS = 1_670_000_000_000
CASES = 290

# Case number (key modulo CASES) of messages a strict reader must keep although they look odd.
EXTRA_FIELD, NO_OPTIONALS = 16, 17


def _set(name: str, text: str) -> Callable[[Column], Column]:
    return lambda json: F.regexp_replace(json, rf'"{name}":[^,}}]+', f'"{name}":{text}')


# Case number to what is done to the message's text; each of these must be rejected.
REJECTED = {
    1: lambda json: F.regexp_replace(json, r'"gdp":[^,}]+,', ""),
    2: _set("marital_status", "1.5"),
    3: _set("marital_status", '"1"'),
    4: _set("marital_status", "99999999999"),
    5: _set("marital_status", "null"),
    6: _set("gdp", "NaN"),
    7: _set("gdp", '"NaN"'),
    8: lambda json: F.lit("not json"),
    9: lambda json: F.lit(""),
    10: lambda json: F.concat(F.lit("["), json, F.lit("]")),
    11: lambda json: F.concat(json, F.lit(" tail")),
    12: lambda json: F.concat(json, F.lit("] }")),
    13: lambda json: F.concat(json, F.lit("}")),
    14: lambda json: F.concat(json, F.lit(","), json),
    15: lambda json: F.regexp_replace(json, r"\}$", ""),
    18: _set("target", "5"),
    19: lambda json: F.regexp_replace(json, r"^\{", '{"gender":0,'),
    20: _set("event_id", "null"),
    21: _set("event_ts_ms", '"soon"'),
    22: _set("event_ts_ms", "-1"),
    23: lambda json: F.translate(json, '"', "'"),
    24: _set("marital_status", "1.0"),
    25: _set("gdp", "1e400"),
}
KEPT_ODD = {
    EXTRA_FIELD: lambda json: F.regexp_replace(json, r"^\{", '{"note":[1,{"x":"]"}],'),
    NO_OPTIONALS: lambda json: F.regexp_replace(json, r',"event_id":.*$', "}"),
}


def sent_records(students: DataFrame) -> DataFrame:
    """The records of one replay with their stamps."""
    numbered = replay.replicate(students.withColumnRenamed("event_seq", "seq"), 1)
    return replay.stamp_event(numbered.drop("event_ts_ms"), start_ms=START_MS, offset_ms=F.col("seq"))


def clean_messages(students: DataFrame) -> DataFrame:
    return messages.encode_messages(sent_records(students), replay.message_key(F.col("seq")))


def spoiled_messages(students: DataFrame) -> DataFrame:
    """The replay's messages, most of them damaged in the way of their case number."""
    clean = clean_messages(students)
    case = F.col("key").cast("bigint") % CASES
    text: Column = F.col("value")
    for number, damage in (REJECTED | KEPT_ODD).items():
        text = F.when(case == number, damage(F.col("value"))).otherwise(text)
    return clean.select("key", text.alias("value"))


def spoiled_cells(students: DataFrame) -> DataFrame:
    """The raw file's columns as text: padded headers, cells of the wrong kind, one column gone."""
    k = F.col("event_seq")
    changes = {
        "admission_grade": F.when(k % 13 == 0, F.lit("x")),
        "age_at_enrollment": F.when(k % 17 == 0, F.lit("")).when(
            k % 19 == 0, F.concat(F.col("age_at_enrollment").cast("string"), F.lit(".7"))
        ),
        "curricular_units_1st_sem_grade": F.when(k % 23 == 0, F.lit("  1.25e1 ")),
        "marital_status": F.when(k % 29 == 0, F.lit("99999999999")),
        "gdp": F.when(k % 37 == 0, F.lit("10d")),
        "target": F.when(k % 31 == 0, F.lit(None).cast("string")),
    }
    columns = []
    for header, name in schema.HEADERS.items():
        if name == "inflation_rate":
            continue
        cell = F.col(name).cast("string")
        if name == "target":
            cell = F.when(k % 31 != 0, cell)
        elif name in changes:
            cell = F.coalesce(changes[name], cell)
        columns.append(cell.alias(f" {header}\t" if name in ("gender", "gdp") else header))
    return students.select(*columns)


def with_note(students: DataFrame) -> DataFrame:
    """The records with a text cell that a delimited file must quote or keep the blanks of."""
    k = F.col("event_seq") % 5
    note = (
        F.when(k == 0, "  padded ")
        .when(k == 1, "two\nlines")
        .when(k == 2, "p;q,r")
        .when(k == 3, 'say "so"')
        .otherwise("plain")
    )
    return students.withColumn("note", note)
