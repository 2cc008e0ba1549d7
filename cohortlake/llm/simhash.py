"""SimHash near-duplicates: fingerprints, a pigeonhole join on blocks of bits, and components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlake.llm.components import connected_components
from cohortlake.session import materialize

SEED = 42
SHINGLE_WORDS = 3
MAX_DISTANCE = 3
BLOCKS = 6
#: Distinct fingerprints of one block value that a task compares with each other at once.
CHUNK = 2048
_HASHES_AT_ONCE = 1 << 16


def fingerprint(text: str | None) -> int:
    """The 64-bit SimHash of a whole text as a signed integer; zero for a text without words."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z, only ASCII white space
    if not words:
        return 0
    if len(words) < SHINGLE_WORDS:
        shingles, n = iter([b" ".join(words)]), 1
    else:
        n = len(words) - SHINGLE_WORDS + 1
        shingles = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE_WORDS))))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), "<u8", n)
    ones = np.zeros(64, np.int64)
    for start in range(0, n, _HASHES_AT_ONCE):
        part = hashes[start : start + _HASHES_AT_ONCE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fp`` for every row of ``docs``; other columns are not read. A null text has no words."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = pa.array(map(fingerprint, part.column(1).to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([part.column(0), found], ["doc_id", "fp"])

    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return source.mapInArrow(batches, "doc_id long, fp long")


def block_masks(blocks: int = BLOCKS, distance: int = MAX_DISTANCE) -> list[int]:
    """One mask for each choice of ``blocks - distance`` of the blocks.

    ``distance`` changed bits touch at most as many blocks, so two fingerprints within it are equal
    under at least one of the masks.
    """
    bounds = [64 * i // blocks for i in range(blocks + 1)]
    parts = [((1 << b) - (1 << a)) for a, b in zip(bounds, bounds[1:])]
    masks = (sum(chosen) for chosen in combinations(parts, blocks - distance))
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _block_rows(ids: DataFrame) -> DataFrame:
    """A row for each fingerprint and mask under which another fingerprint is equal.

    Values held by more than ``CHUNK`` fingerprints are dealt into chunks, and a row goes to every
    pair of chunks that holds its own, so that each pair of rows still meets in some task.
    """
    masks = F.array(*(
        F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("block"))
        for i, m in enumerate(block_masks())
    ))
    keyed = ids.select("fp", "id", F.inline(masks))
    # The written counts are broadcast while they are small; beyond that AQE splits a full value's rows.
    shared = materialize(keyed.groupBy("t", "block").agg(F.count("*").alias("n")).where("n > 1"), "blocks")
    counted = keyed.join(shared, ["t", "block"])
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    own = F.pmod(F.xxhash64("fp"), chunks).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), chunks - 1), lambda j: F.struct(F.least(own, j).alias("i"), F.greatest(own, j).alias("j"))
    )
    return counted.select("t", "block", "fp", "id", F.inline(pairs))


def _forest(fps: np.ndarray, ids: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links within one group; every pair is compared unless already joined."""
    edges, left = [], np.arange(len(fps))
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = np.bitwise_count(fps[left] ^ fps[at]) <= MAX_DISTANCE
            edges += [(ids[at], ids[k]) for k in left[near]]
            queue += list(left[near])
            left = left[~near]
    return edges


def _link_groups(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within each run of equal ``t, block, i, j`` of a sorted partition."""

    def linked(keys, fps, ids, last: bool):
        cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        bounds = [0, *cuts, len(fps)] if last else [0, *cuts]
        edges = []
        for a, b in zip(bounds, bounds[1:]):
            if b - a == 2:
                if int(fps[a] ^ fps[a + 1]).bit_count() <= MAX_DISTANCE:
                    edges.append((ids[a], ids[a + 1]))
            elif b - a > 2:
                edges += _forest(fps[a:b], ids[a:b])
        columns = zip(*edges) if edges else ([], [])
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], ["a", "b"]), bounds[-1]

    keys, fps, ids = np.empty((4, 0), np.int64), np.empty(0, np.uint64), np.empty(0, np.int64)
    for part in parts:
        now = [part.column(k).to_numpy(zero_copy_only=False) for k in range(6)]
        keys = np.hstack([keys, np.vstack(now[:4]).astype(np.int64)])
        fps, ids = np.concatenate([fps, now[4].view(np.uint64)]), np.concatenate([ids, now[5]])
        found, done = linked(keys, fps, ids, last=False)
        keys, fps, ids = keys[:, done:], fps[done:], ids[done:]
        yield found
    if len(fps):
        yield linked(keys, fps, ids, last=True)[0]


def links(ids: DataFrame) -> DataFrame:
    """Links ``a, b`` that join the same components as all pairs within the distance do.

    ``ids`` has a distinct ``fp`` and its ``id`` per row.
    """
    rows = _block_rows(ids).select("t", "block", "i", "j", "fp", "id")
    sorted_rows = rows.repartition("t", "block", "i", "j").sortWithinPartitions("t", "block", "i", "j")
    return sorted_rows.mapInArrow(_link_groups, "a long, b long").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, fp, component_id`` for every row of ``docs``, whose other columns are not read.

    Texts are taken whole; a null text counts as empty, and a text without words has fingerprint 0
    and is linked like any other. Fingerprints link at 3 or fewer differing bits; ``component_id``
    is the smallest ``doc_id`` reachable. Equal fingerprints, ties and repeated rows share a
    component. A row with a null ``doc_id`` keeps its place; it takes the component of its
    fingerprint if a row with an id has the same one, else null, and makes no link of its own. An
    empty table gives an empty result.

    One row per distinct fingerprint enters the pigeonhole join: 64 bits in six blocks, of which two
    linked fingerprints share at least three, so each of 20 tables matches about 32 bits. Blocks are
    compared inside tasks, which emit a spanning forest and not the pairs.
    """
    marked = materialize(fingerprints(docs), "fingerprints")
    ids = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("id")).where("id is not null"), "distinct")
    found = connected_components(links(ids))
    named = ids.join(found, "id", "left").select("fp", F.coalesce("component", "id").alias("component_id"))
    return marked.join(named, "fp", "left").select("doc_id", "fp", "component_id")


def fingerprint_hex(fp: Column) -> Column:
    """16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
