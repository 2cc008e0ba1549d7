"""Near-duplicate embeddings by a subspace pigeonhole join."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from cohortlake.llm.components import connected_components
from cohortlake.session import materialize

MIN_COSINE = 0.93
#: Blocks into which the rotated vectors are split, and coordinates of a block that make its grid.
BLOCKS, GRID = 4, 2
#: Vectors of a cell that a task compares with as many others at once.
CHUNK = 4096
#: Over-full cells (40 bytes each) that are broadcast; more of them are joined without a hint.
BROADCAST_CELLS = 200_000
SEED = 11
#: Keeps rounding from losing a pair; the cosine itself is compared without it.
_ROOM = 1 + 1e-9
_PAIRS_AT_ONCE = 1 << 16

_KEYS = ["label", "size", "block", "x", "y", "i", "j"]
_CELL = ["label", "size", "block", "x", "y"]


def rotation(size: int) -> np.ndarray:
    """A seeded random orthogonal matrix, which spreads any vector over all blocks."""
    q, r = np.linalg.qr(np.random.default_rng(SEED + size).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def block_bounds(size: int) -> list[tuple[int, int]]:
    blocks = min(BLOCKS, size)
    return [(size * b // blocks, size * (b + 1) // blocks) for b in range(blocks)]


def budgets(size: int) -> np.ndarray:
    """Squared distance allowed in each block, in proportion to its width.

    Unit vectors link at a squared distance of ``2 - 2 * MIN_COSINE`` or less; if every block were
    over its part, the sum would be over the whole.
    """
    return np.array([(2 - 2 * MIN_COSINE) * (b - a) / size for a, b in block_bounds(size)]) * _ROOM


def _plain(parts: Iterator[pa.RecordBatch], kind: str) -> Iterator[pa.RecordBatch]:
    """``vec_id, label, vec``: the vector as bytes of ``kind``, null if it cannot link with anything."""
    for part in parts:
        vec_id, vectors, label = part.columns
        kept = []
        for i, vector in enumerate(vectors):
            v = None
            if vector.is_valid and vec_id[i].is_valid and label[i].is_valid and not vector.values.null_count:
                v = vector.values.to_numpy(zero_copy_only=False).astype(kind) + 0
                v = v.tobytes() if np.isfinite(v).all() and v.any() else None
            kept.append(v)
        yield pa.RecordBatch.from_arrays([vec_id, label, pa.array(kept, pa.binary())], ["vec_id", "label", "vec"])


def _unit(vectors: list[bytes], kind: str) -> np.ndarray:
    v = np.frombuffer(b"".join(vectors), kind).reshape(len(vectors), -1).astype("<f8")
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _cells(parts: Iterator[pa.RecordBatch], kind: str, with_vectors: bool) -> Iterator[pa.RecordBatch]:
    """Every vector in its cell of each block, and as a guest in half of the cells around it."""
    around = [step for step in product((-1, 0, 1), repeat=GRID) if step <= (0,) * GRID]
    for part in parts:
        for at in range(0, part.num_rows, 1024):
            rows = part.slice(at, 1024)
            ids, label, copies, vectors = (c.to_pylist() for c in rows.columns)
            sizes = [len(v) // np.dtype(kind).itemsize for v in vectors]
            for size in sorted(set(sizes)):
                mine = [k for k, s in enumerate(sizes) if s == size]
                turned = _unit([vectors[k] for k in mine], kind) @ rotation(size)
                for block, ((a, b), budget) in enumerate(zip(block_bounds(size), budgets(size))):
                    cell = np.zeros((len(mine), GRID), np.int64)
                    width = min(GRID, b - a)
                    cell[:, :width] = np.floor(turned[:, a : a + width] / math.sqrt(budget * _ROOM))
                    for step in around:
                        n = len(mine)
                        place = cell + step
                        columns = [
                            pa.array([label[k] for k in mine], pa.int64()),
                            pa.array(np.full(n, size)),
                            pa.array(np.full(n, block)),
                            *(pa.array(place[:, g]) for g in range(GRID)),
                            pa.array([ids[k] for k in mine], pa.int64()),
                        ]
                        if with_vectors:
                            columns += [
                                pa.array([copies[k] for k in mine], pa.int64()),
                                pa.array(np.full(n, not any(step))),
                                pa.array([vectors[k] for k in mine], pa.binary()),
                            ]
                        names = [*_CELL, "id", "copies", "home", "vec"][: len(columns)]
                        yield pa.RecordBatch.from_arrays(columns, names)


def _key_runs(parts: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Rows of sorted batches, one table for each run of equal leading ``keys`` integer columns."""
    held: pa.Table | None = None
    for part in parts:
        now = pa.Table.from_batches([part])
        held = now if held is None else pa.concat_tables([held, now])
        values = np.vstack([held.column(k).to_numpy() for k in range(keys)])
        cuts = np.flatnonzero((values[:, 1:] != values[:, :-1]).any(axis=0)) + 1
        for a, b in zip([0, *cuts], cuts):
            yield held.slice(a, b - a)
        if len(cuts):
            held = held.slice(cuts[-1])
    if held is not None and held.num_rows:
        yield held


def _compare(parts: Iterator[pa.RecordBatch], kind: str) -> Iterator[pa.RecordBatch]:
    """Links of each run: ``a, null, n`` for a vector's linked copies, ``a, b, 0`` for a component's edges."""
    for run in _key_runs(parts, len(_KEYS)):
        if run.num_rows < 2:
            continue
        size, block = run.column("size")[0].as_py(), run.column("block")[0].as_py()
        i, j = run.column("i")[0].as_py(), run.column("j")[0].as_py()
        ids, copies, own = (run.column(c).to_numpy() for c in ("id", "copies", "own"))
        home = np.array(run.column("home").to_pylist(), bool)
        unit = _unit(run.column("vec").to_pylist(), kind)
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        a, b = _links(unit, left, right, home, block, size)
        if not len(a):
            continue
        linked = np.bincount(a, copies[b], len(ids)) + np.bincount(b, copies[a], len(ids))
        root = _roots(a, b, len(ids))
        some, moved = np.flatnonzero(linked), np.flatnonzero(root != np.arange(len(ids)))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([ids[some], ids[moved]])),
                pa.array([None] * len(some) + ids[root[moved]].tolist(), pa.int64()),
                pa.array(np.concatenate([linked[some], np.zeros(len(moved))]).astype(np.int64)),
            ],
            ["a", "b", "n"],
        )


def _links(unit, left, right, home, block: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Verified links between two chunks (or inside one) for which ``block`` is the first within its budget."""
    turned, bounds, allowed = unit @ rotation(size), block_bounds(size), budgets(size)
    start, stop = bounds[block]
    near = turned[:, start:stop]
    square = (near * near).sum(axis=1)
    same = left is right or np.array_equal(left, right)
    found_a, found_b = [], []
    rows = max(1, (1 << 22) // max(1, len(right)))
    for at in range(0, len(left), rows):
        some = left[at : at + rows]
        distance = square[some][:, None] + square[right] - 2 * near[some] @ near[right].T
        p, q = np.nonzero(distance <= allowed[block] + 1e-12)
        a, b = some[p], right[q]
        ok = home[a] | home[b]  # guests meet in a cell of their own
        if same:
            ok &= a < b
        a, b = a[ok], b[ok]
        for k in range(0, len(a), _PAIRS_AT_ONCE):
            x, y = a[k : k + _PAIRS_AT_ONCE], b[k : k + _PAIRS_AT_ONCE]
            take = (unit[x] * unit[y]).sum(axis=1) >= MIN_COSINE
            for earlier, (c, d) in enumerate(bounds[:block]):
                part = ((turned[x, c:d] - turned[y, c:d]) ** 2).sum(axis=1)
                take &= part > allowed[earlier]
            found_a.append(x[take])
            found_b.append(y[take])
    nothing = np.empty(0, np.int64)
    return np.concatenate([nothing, *found_a]), np.concatenate([nothing, *found_b])


def _roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest row that each row reaches."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        after = root.copy()
        np.minimum.at(after, a, low)
        np.minimum.at(after, b, low)
        after = after[after]
        if np.array_equal(after, root):
            return root
        root = after


def _dealt(vectors: DataFrame, kind: str) -> DataFrame:
    """Rows of all cells; those of over-full cells are dealt into chunks, of which every two meet."""
    plain = "label long, size long, block long, x long, y long, id long"
    keys = vectors.mapInArrow(lambda parts: _cells(parts, kind, False), plain)
    full = materialize(keys.groupBy(*_CELL).agg(F.count("*").alias("n")).where(F.col("n") > CHUNK), "full-cells")
    if full.count() <= BROADCAST_CELLS:  # at most 8 MB
        full = F.broadcast(full)
    rows = vectors.mapInArrow(lambda parts: _cells(parts, kind, True), f"{plain}, copies long, home boolean, vec binary")
    chunks = F.ceil(F.coalesce("n", F.lit(1)) / CHUNK)
    own = F.pmod(F.xxhash64("id"), chunks)
    pairs = F.transform(
        F.sequence(F.lit(0).cast("long"), chunks - 1),
        lambda k: F.struct(F.least(own, k).alias("i"), F.greatest(own, k).alias("j")),
    )
    placed = rows.join(full, _CELL, "left").select(*_CELL, "id", "copies", "home", "vec", own.alias("own"), F.inline(pairs))
    return placed.select(*_KEYS, "own", "id", "copies", "home", "vec")


def near_duplicates(embeddings: DataFrame) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``embeddings(vec_id, embedding, label)``.

    Vectors of equal, non-null integer labels and equal length link at a cosine (double precision) of
    ``MIN_COSINE`` or more. ``n_links`` counts the other rows linked directly, ``component_id`` is the
    smallest ``vec_id`` reachable and ``kept`` marks the row that has it. A vector that is null,
    empty, zero, or has null or non-finite components, and one with a null id or label, links with
    nothing and is its own component (``kept`` is false for a null id). Equal vectors of a label are
    compared once and count as often as they occur. Other columns are not read; an empty table gives
    an empty result.

    The unit vectors are rotated and split into blocks; a linked pair is within its share of the
    squared distance in at least one of them. A grid over the first coordinates of a block, with
    cells as wide as that share allows, is the range join: a vector meets those of its cell and of
    the cells around. Tasks filter by the block's distance, count a pair in the first block that has
    it, verify the cosine, and emit counts and a star per component, never the pairs.
    """
    single = embeddings.schema["embedding"].dataType.elementType == FloatType()
    kind, held = ("<f4", "array<float>") if single else ("<f8", "array<double>")
    plain = embeddings.select(
        F.col("vec_id").cast("long"), F.col("embedding").cast(held), F.col("label").cast("long")
    ).mapInArrow(lambda parts: _plain(parts, kind), "vec_id long, label long, vec binary")
    plain = materialize(plain, "vectors")
    usable = plain.where("vec is not null")
    distinct = materialize(
        usable.groupBy("label", "vec").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")), "distinct"
    )
    rows = _dealt(distinct.select("id", "label", "copies", "vec"), kind).repartition(*_KEYS).sortWithinPartitions(*_KEYS)
    found = materialize(rows.mapInArrow(lambda parts: _compare(parts, kind), "a long, b long, n long"), "links")
    linked = found.where("b is null").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("n"))
    components = connected_components(found.where("b is not null").select("a", "b"))
    named = (
        distinct.join(linked, "id", "left")
        .join(components, "id", "left")
        .select(
            "label",
            "vec",
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "id").alias("component"),
        )
    )
    return plain.join(named, ["label", "vec"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component", "vec_id"), F.lit(False)).alias("kept"),
    )
