"""Session construction and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def build_session(
    app: str = "cohortlake",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with adaptive execution on and wide plans printed whole.

    Partition counts are left to the cluster's settings and to AQE unless given, so the same
    code runs on ``local[8]`` and on a cluster.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.debug.maxToStringFields", "200")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables: ``spark.checkpoint.dir``, shared by all executors.

    Only a local-mode session may fall back to a temporary folder of this machine; on a cluster
    a lost executor would take such a folder with it, so an unset folder is an error there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="cohortlake-")
    return _local_roots[context.applicationId]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the scratch folder that no other call has used."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The written table cuts the lineage: losing an executor afterwards costs a re-read, never a
    second evaluation that could order or number the rows differently.
    """
    return stored(df, name)[0]


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Like ``materialize``, with the path, for callers that ``discard`` the table in the end."""
    path = fresh_path(df.sparkSession, name)
    df.write.mode("error").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


#: Bytes of a method beyond which the JVM only interprets it (HotSpot's ``HugeMethodLimit``).
INTERPRETED_BYTES = 8000


def compiled_methods(spark: SparkSession) -> None:
    """Plans of this session fall back to split methods where one would be too long to be compiled.

    A record has some forty derived columns; generated as one method they run interpreted, at a
    fraction of the speed. A lower limit that the session sets already stays.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(name)) > INTERPRETED_BYTES:
        spark.conf.set(name, str(INTERPRETED_BYTES))


SCAN_PARTITIONS = "spark.cohortlake.scanPartitions"


def scan_partitions(spark: SparkSession) -> int | None:
    """Partitions that a scan before costly work per row is dealt into, if the session sets a number.

    Left unset where tables come in enough splits: nothing is decided from a table's size.
    """
    number = spark.conf.get(SCAN_PARTITIONS, None)
    return int(number) if number else None


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and the path itself, as JVM objects."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = file_system(spark, path)
    return fs.exists(hadoop_path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table once nothing reads it any more."""
    if not path.startswith(scratch_root(spark) + "/"):
        raise ValueError(f"not below the scratch folder: {path}")
    fs, hadoop_path = file_system(spark, path)
    fs.delete(hadoop_path, True)
