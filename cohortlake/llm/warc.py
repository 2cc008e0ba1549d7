"""Merkle fixity audit of replicated WARC files."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortlake.session import materialize

#: Bytes of the offset ranges at the bottom of a tree, and children of a node above.
RANGE_BYTES, FAN_OUT = 1 << 16, 16
#: Pages per file of an archive made by ``archive_pages``, and files for pages without an id.
PAGES_PER_FILE, UNNUMBERED_FILES = 500, 1024

_LENGTH = re.compile(rb"\r\ncontent-length:[ \t]*(\d+)", re.IGNORECASE)


def warc_record(record_id: Column, uri: Column, payload: Column) -> Column:
    """A WARC/1.0 resource record as text; nulls count as empty."""
    body = F.coalesce(payload.cast("string"), F.lit(""))
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(record_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce(uri.cast("string"), F.lit("")),
        F.lit("\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
    )
    return F.concat(head, F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def archive_pages(pages: DataFrame) -> DataFrame:
    """``file, offset, record_id, record`` (bytes) of ``pages(page_id, url, html)`` as WARC files.

    A file holds the pages of ``PAGES_PER_FILE`` ids one after the other; pages without an id are
    scattered over files of their own. Ties are ordered by url and content; repeated rows stay.
    """
    number = F.coalesce(
        F.expr(f"cast(floor(cast(page_id as bigint) / {PAGES_PER_FILE}) as bigint)"),
        -1 - F.pmod(F.xxhash64("url", "html"), F.lit(UNNUMBERED_FILES)),
    )
    numbered = F.col("page_id").isNotNull()
    file = F.concat(F.when(numbered, "pages-").otherwise("unnumbered-"), F.abs(number).cast("string"), F.lit(".warc"))
    record = warc_record(F.col("page_id"), F.col("url"), F.col("html")).cast("binary")
    rows = pages.select(file.alias("file"), F.col("page_id").cast("long").alias("record_id"), record.alias("record"))
    before = Window.partitionBy("file").orderBy("record_id", "record").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum(F.octet_length("record")).over(before), F.lit(0)).cast("long")
    return rows.select("file", offset.alias("offset"), "record_id", "record")


#: How a compressed member begins, and bytes of one that are inflated at once.
_MEMBER, _PIECE = b"\x1f\x8b\x08", 1 << 16


def _inflated(content: bytes, at: int) -> tuple[bytes, int]:
    """The record of a compressed member and where the member ends.

    A member that is damaged or cut off gives its bytes as they are, up to the next beginning of one: a
    record whose digest differs from that of every sound copy.
    """
    inflate, parts, end = zlib.decompressobj(wbits=31), [], at
    try:
        while not inflate.eof and end < len(content):
            parts.append(inflate.decompress(content[end : end + _PIECE]))
            end += _PIECE
    except zlib.error:
        pass
    else:
        if inflate.eof:
            return b"".join(parts), min(end, len(content)) - len(inflate.unused_data)
    end = content.find(_MEMBER, at + len(_MEMBER))
    end = len(content) if end < 0 else end
    return content[at:end], end


def split_records(content: bytes) -> Iterator[tuple[int, bytes]]:
    """Offset and bytes of each record of a WARC file; of compressed ones the offset of the member."""
    at = 0
    while at < len(content):
        if content[at : at + 2] == b"\x1f\x8b":
            record, end = _inflated(content, at)
            yield at, record
            at = end
            continue
        head = content.find(b"\r\n\r\n", at)
        length = _LENGTH.search(content, at, head + 2) if head >= 0 else None
        end = head + 4 + int(length[1]) + 4 if length else len(content)
        yield at, content[at : min(end, len(content))]
        at = end


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """``file, offset, record`` of the WARC files below ``path``, plain or compressed by record."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for name, content in zip(part.column(0).to_pylist(), part.column(1)):
                for offset, record in split_records(content.as_py()):
                    columns = [pa.array([name]), pa.array([offset], pa.int64()), pa.array([record], pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["file", "offset", "record"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(name, "content").mapInArrow(batches, "file string, offset long, record binary")


def leaves(records: DataFrame) -> DataFrame:
    """``replica, file, offset, length, digest`` of records, whose bytes are read once."""
    return records.select(
        "replica",
        "file",
        "offset",
        F.octet_length("record").cast("long").alias("length"),
        F.sha2("record", 256).alias("digest"),
    )


def _node(children: DataFrame, key: Column, order: list[str]) -> DataFrame:
    """Nodes over ``children``: the hash of their hashes in order."""
    said = F.sort_array(F.collect_list(F.struct(*order, "digest")))
    joined = F.array_join(F.transform(said, lambda c: F.concat_ws(":", *(c[o].cast("string") for o in order), c["digest"])), "\n")
    rows = children.withColumn("node", key)
    return rows.groupBy("replica", "file", "node").agg(F.sha2(joined, 256).alias("digest"))


def build_trees(found: DataFrame) -> list[DataFrame]:
    """Levels of the trees of all replicas and files, the ranges first and the roots last.

    A range holds the records that start in it, a node ``FAN_OUT`` ranges or nodes, so no group grows
    with the file; every level is written to the shared folder.
    """
    last = found.agg(F.max("offset")).first()[0] or 0
    level = materialize(_node(found, F.expr(f"offset div {RANGE_BYTES}"), ["offset", "length"]), "ranges")
    levels, reach = [level], RANGE_BYTES
    while reach <= last:
        below = level.withColumnRenamed("node", "below")
        level = materialize(_node(below, F.expr(f"below div {FAN_OUT}"), ["below"]), "nodes")
        levels.append(level)
        reach *= FAN_OUT
    return levels


def _differing(nodes: DataFrame, replicas: int) -> DataFrame:
    """Nodes that a replica lacks or of which two replicas differ."""
    compared = nodes.groupBy("file", "node").agg(
        F.count("*").alias("n"), F.min("digest").alias("low"), F.max("digest").alias("high")
    )
    return compared.where((F.col("n") != replicas) | (F.col("low") != F.col("high"))).select("file", "node")


def audit(found: DataFrame, replicas: list[str]) -> DataFrame:
    """``replica, file, offset, length, state`` of every record of ``leaves`` that is not what it should be.

    Roots are compared first; below, only children of nodes that differ are read, and at last the
    records of ranges that differ. What most replicas hold at an offset (length and digest, or no
    record) is right; of equally many the holder first in ``replicas`` is. A replica's record is
    ``changed``, ``missing`` (length is the right one's) or ``extra``. Records that repeat at an
    offset count as ``extra`` beyond the first by digest. Rows with a null replica, file or offset and
    those of replicas not listed are left out; a null record has a null digest and is ``changed``
    against any other. Intact replicas and empty tables give an empty result.
    """
    known = found.where(F.col("replica").isin(replicas) & F.col("file").isNotNull() & F.col("offset").isNotNull())
    known = materialize(known.withColumn("digest", F.coalesce("digest", F.lit(""))), "leaves")
    levels = build_trees(known)
    wrong = _differing(levels[-1], len(replicas))
    for level in reversed(levels[:-1]):
        parent = F.expr(f"node div {FAN_OUT}")
        above = wrong.select("file", F.col("node").alias("parent"))
        children = level.withColumn("parent", parent).join(above, ["file", "parent"], "left_semi")
        wrong = materialize(_differing(children, len(replicas)), "differing")
    ranges = wrong.select("file", F.col("node").alias("range"))
    inside = known.withColumn("range", F.expr(f"offset div {RANGE_BYTES}")).join(ranges, ["file", "range"], "left_semi")
    return _verdicts(inside, replicas)


def _verdicts(records: DataFrame, replicas: list[str]) -> DataFrame:
    rank = F.array_position(F.lit(replicas), F.col("replica"))
    firsts = Window.partitionBy("file", "offset", "replica").orderBy("digest", "length")
    numbered = records.select("*", F.row_number().over(firsts).alias("copy"), rank.alias("rank"))
    again = numbered.where("copy > 1").select("replica", "file", "offset", "length", F.lit("extra").alias("state"))
    # One row for each offset and replica, also where the replica has no record there.
    held = numbered.where("copy = 1").groupBy("file", "offset").agg(
        F.collect_list(F.struct("rank", "length", "digest")).alias("held")
    )
    everyone = F.sequence(F.lit(1).cast("long"), F.lit(len(replicas)).cast("long"))
    seen = F.transform(
        everyone,
        lambda r: F.element_at(F.concat(F.filter("held", lambda h: h["rank"] == r), F.array(
            F.struct(r.alias("rank"), F.lit(None).cast("long").alias("length"), F.lit(None).cast("string").alias("digest"))
        )), 1),
    )
    votes = F.transform(
        F.col("seen"),
        lambda a: F.struct(
            F.size(F.filter("seen", lambda b: b["digest"].eqNullSafe(a["digest"]) & b["length"].eqNullSafe(a["length"]))).alias("n"),
            (-a["rank"]).alias("before"),
            a["length"].alias("length"),
            a["digest"].alias("digest"),
        ),
    )
    judged = held.select("file", "offset", seen.alias("seen")).withColumn("right", F.array_max(votes))
    each = judged.select("file", "offset", "right", F.explode("seen").alias("own"))
    same = F.col("own.digest").eqNullSafe(F.col("right.digest")) & F.col("own.length").eqNullSafe(F.col("right.length"))
    state = F.when(F.col("own.digest").isNull(), "missing").when(F.col("right.digest").isNull(), "extra").otherwise("changed")
    wrong = each.where(~same).select(
        F.element_at(F.lit(replicas), F.col("own.rank").cast("int")).alias("replica"),
        "file",
        "offset",
        F.coalesce("own.length", "right.length").alias("length"),
        state.alias("state"),
    )
    return wrong.unionByName(again)
