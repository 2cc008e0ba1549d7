"""Small files merged into block-sized ones, with a list of the files that the new ones replace.

An ingest that flushes often leaves very many small files. ``compact`` writes their rows again below
``_compacted`` in the table's folder, which plain readers and running streams do not look into, and
``batches.scan_parquet`` reads the merged files instead of those they replace. A merge counts from the
moment its commit record is there, so a reader sees every row once before, during and after it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.session import file_system, path_exists
from cohortlake.streaming.delivery import CommittedFolder

BLOCK_BYTES = 128 << 20
#: Files that one merge takes; the next merge of the same call takes the following ones.
FILES_AT_ONCE = 10_000


def _folder(spark: SparkSession, path: str) -> CommittedFolder:
    return CommittedFolder(spark, f"{path.rstrip('/')}/_compacted")


def signed_times(table: DataFrame) -> DataFrame:
    """An unsigned time stamp column, which Spark reads as a decimal, as a bigint."""
    if dict(table.dtypes).get("event_ts_ms", "bigint") == "bigint":
        return table
    return table.withColumn("event_ts_ms", F.col("event_ts_ms").cast("bigint"))


def _listed(spark: SparkSession, path: str) -> list[str]:
    """The Parquet files below a folder, none of which is opened.

    Where a stream writes the folder, its log decides which files count, as in any scan.
    """
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return sorted(map(unquote, found.inputFiles()))


def _merges(spark: SparkSession, folder: CommittedFolder) -> tuple[list[str], set[str]]:
    """The merged files of all merges that count, and the names of all files they replace."""
    attempts = [row["note"] for row in folder.log.records().select("note").collect()]  # one per merge
    if not attempts:
        return [], set()
    counted = {f"attempt={attempt}" for attempt in attempts}
    merged = [file for file in _listed(spark, f"{folder.path}/data") if file.split("/")[-2] in counted]
    names = spark.read.schema("name string").parquet(*(f"{folder.path}/replaced/{a}" for a in attempts))
    return merged, {row["name"] for row in names.collect()}


def _name(file: str) -> str:
    return file.rpartition("/")[2]


def live_files(spark: SparkSession, path: str) -> dict[str, bool]:
    """The table's files that no merge replaces, and the merged ones, which are marked.

    The driver holds the list of files, as it does for any scan.
    """
    merged, replaced = _merges(spark, _folder(spark, path))
    files = dict.fromkeys(_listed(spark, path), False) | dict.fromkeys(merged, True)
    return {file: is_merged for file, is_merged in files.items() if _name(file) not in replaced}


def _scan(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """Just these files; columns that only some of them have are null in the others."""
    return signed_times(spark.read.option("mergeSchema", True).parquet(*files))


def _scans(spark: SparkSession, files: dict[str, bool]) -> list[DataFrame]:
    """One scan of the files that were not merged and one of the merged."""
    kinds = ([file for file, merged in files.items() if merged is kind] for kind in (False, True))
    return [_scan(spark, kind) for kind in kinds if kind]


def scans(spark: SparkSession, path: str) -> list[DataFrame] | None:
    """The scans that make up a table with merged files; none if it has no such file."""
    if not path_exists(spark, f"{path.rstrip('/')}/_compacted/commits"):
        return None
    return _scans(spark, live_files(spark, path)) or None


def union(tables: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def compact(
    spark: SparkSession, path: str, target_bytes: int = BLOCK_BYTES, files_at_once: int = FILES_AT_ONCE
) -> int:
    """Merge the files smaller than half of ``target_bytes``; returns how many were replaced.

    Rows are read and written once, without a shuffle, into about ``bytes / target_bytes`` files. Merged
    files that are still small take part again, so repeated calls leave a bounded number of them. Files
    that arrive meanwhile stay as they are until the next call. If a merge dies its files go on counting;
    of two runs at the same time one commits and the other's work is left for ``sweep``. The table
    must not have partition folders.
    """
    if target_bytes < 1 or files_at_once < 2:
        raise ValueError("a target of a byte or more and two files or more at once are needed")
    folder, replaced = _folder(spark, path), 0
    while True:
        unit = f"{folder.log.records().count():08d}"
        live = live_files(spark, path)
        if not live:
            return replaced
        sizes = spark.read.format("binaryFile").load(list(live)).select("path", "length")
        small = {_name(row["path"]): row["length"] for row in sizes.where(F.col("length") * 2 < target_bytes).collect()}
        chosen = [(merged, file, small[_name(file)]) for file, merged in live.items() if _name(file) in small]
        chosen = sorted(chosen)[:files_at_once]
        wanted = max(1, math.ceil(sum(length for _, _, length in chosen) / target_bytes))
        if len(chosen) <= wanted:
            return replaced
        rows = union(_scans(spark, {file: merged for merged, file, _ in chosen}))
        attempt = folder.stage(unit, rows.coalesce(wanted), compression="snappy")
        names = spark.createDataFrame([(_name(file),) for _, file, _ in chosen], "name string")
        names.coalesce(1).write.mode("error").parquet(f"{folder.path}/replaced/{attempt}")
        if not folder.commit(unit, attempt):
            raise RuntimeError(f"another run merges {path}")
        replaced += len(chosen)


def sweep(spark: SparkSession, path: str) -> int:
    """Delete what is not read any more, replaced files and merges that died; returns the number of files.

    Call it when no reader from before the last merge is left. From then on the table is read through
    ``batches.scan_parquet`` only, which needs none of the files that are gone.
    """
    folder = _folder(spark, path)
    if not path_exists(spark, folder.log.path):
        return 0
    folder.sweep()
    merged, replaced = _merges(spark, folder)
    deleted = 0
    for file in (file for file in (*_listed(spark, path), *merged) if _name(file) in replaced):
        fs, target = file_system(spark, file)
        deleted += bool(fs.delete(target, False))
    return deleted
