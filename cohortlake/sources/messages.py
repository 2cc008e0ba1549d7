"""Messages: keyed JSON records on a topic, encoded simply and decoded strictly.

``source`` and ``sink`` are ``"kafka"``, or a directory of files that needs no broker:
``"parquet"`` (key and value columns) or ``"text"`` (one value per line, no key).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlake import schema

# Leader acknowledgement, compression and the time a send may take.
KAFKA_SINK = {
    "kafka.acks": "1",
    "kafka.compression.type": "snappy",
    "kafka.request.timeout.ms": "10000",
    "kafka.delivery.timeout.ms": "10000",
}


def encode_json(columns: Sequence[str]) -> Column:
    return F.to_json(F.struct(*columns))


def encode_messages(df: DataFrame, key: Column, columns: Sequence[str] = schema.RECORD.names) -> DataFrame:
    return df.select(key.cast("string").alias("key"), encode_json(columns).alias("value"))


def write_messages(
    messages: DataFrame, sink: str = "kafka", path: str | None = None, mode: str = "overwrite", **options
) -> None:
    """Send ``key, value`` rows to a topic (``topic=``, ``**{"kafka.bootstrap.servers": …}``) or a path."""
    if sink == "kafka":
        messages.write.format("kafka").options(**(KAFKA_SINK | options)).save()
    elif sink == "text":
        messages.select("value").write.mode(mode).options(**options).text(path)
    else:
        messages.select("key", "value").write.mode(mode).options(**options).format(sink).save(path)


def read_messages(
    spark: SparkSession,
    source: str = "kafka",
    path: str | None = None,
    streaming: bool = True,
    **options,
) -> DataFrame:
    """Rows ``key, value`` of a topic from its earliest offset, or of a directory.

    As a stream, how far a topic was read is kept in the query's checkpoint.
    """
    reader = spark.readStream if streaming else spark.read
    if source == "kafka":
        loaded = reader.format("kafka").options(**({"startingOffsets": "earliest"} | options)).load()
        return loaded.select(
            F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value")
        )
    if source == "text":
        lines = reader.format("text").options(**options).load(path)
        return lines.select(F.lit(None).cast("string").alias("key"), "value")
    return reader.format(source).schema(schema.MESSAGE).options(**options).load(path)


# Numbers must be numbers and quotes must be double: nothing beyond the JSON standard.
_STRICT = {"allowNonNumericNumbers": "false", "allowSingleQuotes": "false"}


def decode_json(
    df: DataFrame,
    record: T.StructType = schema.RECORD,
    optional: Mapping[str, object] = schema.OPTIONAL_DEFAULTS,
    value: str = "value",
) -> DataFrame:
    """Add ``record``, the parsed fields, and ``valid``: the text is exactly one good record.

    A good record is one JSON object and nothing after it, each known field at most once, every
    required field present, whole numbers in integer fields, finite numbers in doubles, text in
    strings. Unknown fields are ignored and absent optional ones take their default.

    The text is parsed once, as the only element of an array, so anything behind the object
    breaks the array. String fields are parsed as variants, which remember whether the JSON value
    was a string. The parse sits in a generator, so the optimizer cannot copy it into filters.
    """
    wire = T.StructType([T.StructField(f.name, _wire_type(f.dataType)) for f in record.fields])
    text = F.col(value)
    in_array = F.concat(F.lit("["), text, F.lit("]"))
    parsed = F.from_json(in_array, T.ArrayType(wire), _STRICT)
    # One row per message: an array of several objects keeps its first, and is rejected below.
    rows = df.select("*", F.posexplode_outer(parsed).alias("_pos", "_only"))
    rows = rows.filter(F.coalesce("_pos", F.lit(0)) == 0)

    good, fields = [], []
    present = F.lit(len(record.fields) - len(optional))
    for column in record.fields:
        cell = F.col("_only")[column.name]
        content, fits = _checked(cell, column.dataType)
        if column.name in optional:
            absent = ~F.array_contains(F.json_object_keys(text), column.name)
            fits = F.when(cell.isNull(), absent).otherwise(fits)
            content = F.coalesce(content, F.lit(optional[column.name]).cast(column.dataType))
            present = present + cell.isNotNull().cast("int")
        good.append(fits)
        fields.append(content.alias(column.name))
    good.append(_one_plain_object(text, in_array, record, present))
    valid = F.coalesce(reduce(lambda left, right: left & right, good), F.lit(False))
    # Fields stay in a struct: as columns beside a condition on all of them they would multiply
    # the optimizer's inferred constraints with every field.
    return rows.select(*df.columns, valid.alias("valid"), F.struct(*fields).alias("record"))


def _one_plain_object(text: Column, in_array: Column, record: T.StructType, present: Column) -> Column:
    """No repeated known field, no second object, nothing that closes the array early.

    Every field has a colon. Where the colons are as many as the different known fields found, and
    no bracket occurs, there is room for none of these; only other texts are looked at closely.
    A text that ends the array itself has a bracket where a member of an object cannot have one.
    """
    colons = F.length(text) - F.length(F.translate(text, ":", ""))
    plain = (colons == present) & ~F.contains(text, F.lit("]"))
    known = F.filter(F.json_object_keys(text), lambda key: key.isin(record.names))
    as_member = F.json_object_keys(F.concat(F.lit('{"r":'), text, F.lit("}")))
    closely = (
        (F.size(known) == F.size(F.array_distinct(known)))
        & (F.json_array_length(in_array) == 1)
        & (F.size(as_member) == 1)
    )
    return F.when(plain, F.lit(True)).otherwise(closely)


def _wire_type(kind: T.DataType) -> T.DataType:
    return T.VariantType() if isinstance(kind, T.StringType) else kind


def _checked(cell: Column, kind: T.DataType) -> tuple[Column, Column]:
    """A parsed cell's value and whether it is one of its type; longs are unsigned on the wire."""
    if isinstance(kind, T.StringType):
        return F.try_variant_get(cell, "$", "string"), F.schema_of_variant(cell) == "STRING"
    if isinstance(kind, T.DoubleType):
        return cell, cell.isNotNull() & (F.abs(cell) < F.lit(float("inf")))
    if isinstance(kind, T.LongType):
        return cell, cell.isNotNull() & (cell >= 0)
    return cell, cell.isNotNull()


def decode_strict(
    df: DataFrame,
    record: T.StructType = schema.RECORD,
    optional: Mapping[str, object] = schema.OPTIONAL_DEFAULTS,
    value: str = "value",
) -> tuple[DataFrame, DataFrame]:
    """The decoded records, and the messages that hold none."""
    decoded = decode_json(df, record, optional, value)
    good = decoded.filter("valid").select("record.*")
    return good, decoded.filter("not valid").select(*df.columns)
