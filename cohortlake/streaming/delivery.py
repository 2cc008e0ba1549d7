"""Deliveries that count once: commit records beside the data, and a folder that shows committed rows only.

A micro-batch that fails is run again under its number. What it delivered before must not be delivered
or read a second time, whether the failure came before, between or after its writes.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlake.session import file_system, path_exists


class CommitLog:
    """One small file per delivered unit, in a folder that every driver of the stream sees.

    A record appears whole or not at all: it is written under another name and renamed. One query at a
    time works with a log, which Spark's checkpoint already demands.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _file(self, unit: str) -> str:
        if not unit or "/" in unit or unit.startswith((".", "_")):
            raise ValueError(f"not the name of a unit: {unit!r}")
        return f"{self.path}/{unit}"

    def has(self, unit: str) -> bool:
        return path_exists(self.spark, self._file(unit))

    def record(self, unit: str, note: str = "") -> bool:
        """Note that a unit is delivered; false, and nothing changed, if it was before."""
        fs, final = file_system(self.spark, self._file(unit))
        if fs.exists(final):
            return False
        fs, draft = file_system(self.spark, f"{self.path}/.{unit}-{uuid.uuid4().hex}")
        stream = fs.create(draft, False)
        try:
            stream.write(bytearray(json.dumps({"note": note}).encode()))  # never an empty file: scans skip these
        finally:
            stream.close()
        if not fs.rename(draft, final):
            fs.delete(draft, False)
            return False
        return True

    def records(self) -> DataFrame:
        """``unit, note`` of all units, read by tasks and not by the driver."""
        spark = self.spark
        if not path_exists(spark, self.path):
            return spark.createDataFrame([], "unit string, note string")
        lines = spark.read.option("wholetext", True).option("pathGlobFilter", "[!._]*").text(self.path)
        return lines.select(F.col("_metadata.file_name").alias("unit"), F.get_json_object("value", "$.note").alias("note"))


class CommittedFolder:
    """A Parquet table whose rows count unit by unit, from the moment a unit's record is there.

    Every attempt at a unit writes into a folder of its own; the record names the one that counts.
    An attempt that died, or that a later one overtook, is never read, and ``sweep`` removes it.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.log = CommitLog(spark, f"{self.path}/commits")

    def stage(self, unit: str, rows: DataFrame, **options) -> str:
        """Write an attempt at a unit; returns its name for ``commit``."""
        attempt = f"{unit}~{uuid.uuid4().hex}"
        rows.write.mode("error").options(**options).parquet(f"{self.path}/data/attempt={attempt}")
        return attempt

    def commit(self, unit: str, attempt: str) -> bool:
        """Make an attempt the unit's rows; false if the unit has some already."""
        return self.log.record(unit, attempt)

    def write(self, unit: str, rows: DataFrame, **options) -> bool:
        """Stage and commit a unit; nothing is computed for one that is committed."""
        return not self.log.has(unit) and self.commit(unit, self.stage(unit, rows, **options))

    def _data(self, schema: T.StructType | None) -> DataFrame | None:
        if not path_exists(self.spark, f"{self.path}/data"):
            return None
        reader = self.spark.read.option("recursiveFileLookup", False)
        if schema is not None:
            reader = reader.schema(T.StructType([*schema.fields, T.StructField("attempt", T.StringType())]))
        return reader.parquet(f"{self.path}/data")

    def read(self, schema: T.StructType | None = None) -> DataFrame:
        """The committed rows with their ``unit``; a folder without data needs the ``schema`` to be read.

        The attempt is a partition column, so folders that do not count are not opened.
        """
        data = self._data(schema)
        if data is None:
            if schema is None:
                raise FileNotFoundError(f"nothing delivered below {self.path}")
            return self.spark.createDataFrame([], schema).withColumn("unit", F.lit(None).cast("string"))
        counted = self.log.records().select("unit", F.col("note").alias("attempt"))
        return data.join(counted, "attempt").drop("attempt")

    def read_unit(self, unit: str) -> DataFrame:
        """The rows of one committed unit."""
        note = self.log.records().where(F.col("unit") == unit).first()
        if note is None:
            raise FileNotFoundError(f"not committed: {unit}")
        return self.spark.read.parquet(f"{self.path}/data/attempt={note['note']}")

    def sweep(self) -> int:
        """Delete the attempts that do not count and return their number. Not while a query writes."""
        if not path_exists(self.spark, f"{self.path}/data"):
            return 0
        fs, folder = file_system(self.spark, f"{self.path}/data")
        counted = {row["note"] for row in self.log.records().select("note").toLocalIterator()}
        lost = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("attempt=")]
        lost = [p for p in lost if p.getName().removeprefix("attempt=") not in counted]
        return sum(bool(fs.delete(p, True)) for p in lost)
