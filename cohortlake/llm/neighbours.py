"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from cohortlake.session import materialize

#: Results of a query.
NEAREST = 10
#: Links of a node in the upper layers; the lowest has twice as many. One node in so many is in the next layer.
LINKS = 16
#: Candidates that are kept while a node is linked, and while a query is answered.
BUILD_BEAM, SEARCH_BEAM = 64, 192
#: Candidates of a query that are expanded at once.
EXPANDED = 4
#: Vector components of a shard in expectation, 16,384 vectors of 64; larger shards mean fewer searches of a query.
SHARD_VALUES = 1 << 20
#: Distinct queries that a task answers from one shard; more go to further tasks.
QUERY_BLOCK = 1 << 16
SEED = 3
#: Nodes linked at once, and places of the table of those seen by them.
_AT_ONCE, _SEEN_PLACES = 512, 1 << 25

_INDEX = "size int, shard int, vectors binary, layers array<int>, links binary, starts binary, ids binary"


@dataclass
class Graph:
    """Nodes in falling order of their top layer: layer ``l`` holds the first ``len(links[l])`` of them."""

    vectors: np.ndarray  # scaled, single precision
    links: list[np.ndarray]  # by layer: one row of neighbours per node, -1 where there are fewer


def _layer_sizes(n: int) -> list[int]:
    """Nodes of each layer from the lowest on, the expected numbers of a geometric draw."""
    sizes = [n]
    while sizes[-1] > 2 * LINKS:
        sizes.append(math.ceil(sizes[-1] / LINKS))
    return sizes


def _distances(vectors: np.ndarray, nodes: np.ndarray, queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    apart = vectors[nodes] - queries[rows]
    return np.einsum("ij,ij->i", apart, apart)


def _beam_search(
    vectors: np.ndarray, links: np.ndarray, queries: np.ndarray, entry: np.ndarray, beam: int
) -> tuple[np.ndarray, np.ndarray]:
    """The ``beam`` nearest nodes that each query reaches in one layer, nearest first, and their distances.

    All queries take a step at the same time: the nearest nodes that are not expanded yet are, and
    their unseen neighbours compete for a place in the beam. It ends when every place is expanded.
    """
    n, count = len(links), len(queries)
    nodes = np.full((count, beam), -1, np.int64)
    far = np.full((count, beam), np.inf, np.float32)
    done = np.ones((count, beam), bool)
    seen = np.zeros(count * n, bool)
    every = np.arange(count)
    nodes[:, 0], far[:, 0], done[:, 0] = entry, _distances(vectors, entry, queries, every), False
    seen[every * n + entry] = True
    while True:
        open_far = np.where(done, np.inf, far)
        width = min(EXPANDED, beam)
        best = np.argpartition(open_far, width - 1, axis=1)[:, :width] if width < beam else np.tile(np.arange(beam), (count, 1))
        row, column = np.nonzero(np.isfinite(np.take_along_axis(open_far, best, axis=1)))
        if not len(row):
            order = np.argsort(far, axis=1, kind="stable")
            return np.take_along_axis(nodes, order, axis=1), np.take_along_axis(far, order, axis=1)
        place = best[row, column]
        done[row, place] = True
        met = links[nodes[row, place]]
        flat = (row[:, None] * n + met)[met >= 0]
        flat = np.sort(flat[~seen[flat]])
        if not len(flat):
            continue
        flat = flat[np.append(True, flat[1:] != flat[:-1])]
        seen[flat] = True
        row, node = np.divmod(flat, n)
        new_far = _distances(vectors, node, queries, row)
        near = new_far < far.max(axis=1)[row]
        row, node, new_far = row[near], node[near], new_far[near]
        if not len(row):
            continue
        per_row = np.bincount(row, minlength=count)
        at = np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
        wide = per_row.max()
        more_nodes = np.full((count, wide), -1, np.int64)
        more_far = np.full((count, wide), np.inf, np.float32)
        more_nodes[row, at], more_far[row, at] = node, new_far
        all_far = np.concatenate([far, more_far], axis=1)
        taken = np.argpartition(all_far, beam - 1, axis=1)[:, :beam]
        far = np.take_along_axis(all_far, taken, axis=1)
        nodes = np.take_along_axis(np.concatenate([nodes, more_nodes], axis=1), taken, axis=1)
        done = np.take_along_axis(np.concatenate([done, more_far == np.inf], axis=1), taken, axis=1)


def _diverse(vectors: np.ndarray, near: np.ndarray, far: np.ndarray, most: int) -> np.ndarray:
    """At most ``most`` of each row's candidates (nearest first, -1 for none).

    One that is nearer to a chosen candidate than to the node itself comes after all that are not.
    """
    count, width = near.shape
    if width <= most:
        return np.pad(near, ((0, 0), (0, most - width)), constant_values=-1)
    chosen = np.zeros((count, width), bool)
    at_once = max(1, (1 << 23) // (width * max(width, vectors.shape[1])))
    for start in range(0, count, at_once):
        stop = min(count, start + at_once)
        own = vectors[near[start:stop]]
        square = np.einsum("ijk,ijk->ij", own, own)
        between = square[:, :, None] + square[:, None, :] - 2 * own @ own.transpose(0, 2, 1)
        held = np.zeros((stop - start, width), bool)
        for j in range(width):
            nearest = np.where(held, between[:, :, j], np.inf).min(axis=1)
            held[:, j] = (near[start:stop, j] >= 0) & (nearest > far[start:stop, j]) & (held.sum(axis=1) < most)
        chosen[start:stop] = held
    # the chosen ones first, then the nearest of the others, up to the number of links
    order = np.argsort(np.where(near < 0, 2, ~chosen), axis=1, kind="stable")[:, :most]
    return np.take_along_axis(near, order, axis=1)


def _nearest_first(vectors: np.ndarray, nodes: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node's list by distance from the node, and the distances."""
    apart = np.full(lists.shape, np.inf, np.float32)
    row, column = np.nonzero(lists >= 0)
    apart[row, column] = _distances(vectors, lists[row, column], vectors, nodes[row])
    order = np.argsort(apart, axis=1, kind="stable")
    return np.take_along_axis(lists, order, axis=1), np.take_along_axis(apart, order, axis=1)


def _link(vectors: np.ndarray, links: np.ndarray, new: np.ndarray, near: np.ndarray, far: np.ndarray) -> None:
    """Put the nodes ``new`` with their candidates into a layer, and links back to them.

    While a layer is built its lists have twice the places; one that runs over is cut to half.
    """
    room, most = links.shape[1], links.shape[1] // 2
    out = _diverse(vectors, near, far, max(1, most // 2))
    links[new, : out.shape[1]] = out
    source, target = np.repeat(new, out.shape[1]), out.ravel()
    order = np.argsort(target, kind="stable")
    order = order[target[order] >= 0]
    source, target = source[order], target[order]
    nodes, number = np.unique(target, return_counts=True)
    row = np.repeat(np.arange(len(nodes)), number)
    place = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)
    held = (links[nodes] >= 0).sum(axis=1)
    fits = (held + number <= room)[row]
    links[target[fits], (held[row] + place)[fits]] = source[fits]
    over = np.flatnonzero(held + number > room)
    for k in range(0, len(over), 1024):
        some = over[k : k + 1024]
        wide = int((held + number)[some].max())
        both = np.full((len(some), wide), -1, np.int64)
        both[:, :room] = links[nodes[some]]
        slot = np.full(len(nodes), -1)
        slot[some] = np.arange(len(some))
        mine = slot[row] >= 0
        both[slot[row[mine]], (held[row] + place)[mine]] = source[mine]
        both, apart = _nearest_first(vectors, nodes[some], both)
        links[nodes[some]] = -1
        links[nodes[some], :most] = _diverse(vectors, both[:, : 2 * room], apart[:, : 2 * room], most)


def _cut(vectors: np.ndarray, links: np.ndarray) -> np.ndarray:
    """The lists of a finished layer at their length."""
    most = links.shape[1] // 2
    long = np.flatnonzero(links[:, most] >= 0)
    for k in range(0, len(long), 4096):
        some = long[k : k + 4096]
        both, apart = _nearest_first(vectors, some, links[some])
        links[some, :most] = _diverse(vectors, both, apart, most)
    return np.ascontiguousarray(links[:, :most])


def _descend(graph: Graph, queries: np.ndarray, layers: list[np.ndarray]) -> np.ndarray:
    """The node nearest to each query, layer by layer from the top."""
    entry = np.zeros(len(queries), np.int64)
    for links in reversed(layers):
        entry = _beam_search(graph.vectors, links, queries, entry, 4)[0][:, 0]
    return entry


def _batch(n: int) -> int:
    return max(16, min(_AT_ONCE, _SEEN_PLACES // max(1, n)))


def build_graph(vectors: np.ndarray) -> Graph:
    """The graph of distinct vectors in random order.

    Layers are built from the top. In each the nodes come in groups that at most double it; the
    nodes of a group search the ones before them at the same time and are then linked both ways.
    """
    graph = Graph(vectors, [])
    for n in reversed(_layer_sizes(len(vectors))):
        lowest = n == len(vectors)
        links = np.full((n, 4 * LINKS if lowest else 2 * LINKS), -1, np.int64)
        first = min(n, 2 * LINKS)
        near = np.tile(np.arange(first), (first, 1))
        far = _distances(vectors, near.ravel(), vectors, np.repeat(np.arange(first), first)).reshape(first, first)
        far[np.arange(first), np.arange(first)] = np.inf
        order = np.argsort(far, axis=1, kind="stable")[:, : max(1, first - 1)]
        near, far = np.take_along_axis(near, order, axis=1), np.take_along_axis(far, order, axis=1)
        if first > 1:
            _link(vectors, links, np.arange(first), near, far)
        at = first
        while at < n:
            stop = min(n, 2 * at, at + _batch(n))
            queries = vectors[at:stop]
            above = len(graph.links[0]) if graph.links else n
            # a node of the layer above may not be linked here yet as long as its turn has not come
            entry = _descend(graph, queries, graph.links) if at >= above else np.zeros(stop - at, np.int64)
            near, far = _beam_search(vectors, links, queries, entry, BUILD_BEAM)
            _link(vectors, links, np.arange(at, stop), near, far)
            at = stop
        graph.links.insert(0, _cut(vectors, links))
    return graph


def search_graph(graph: Graph, queries: np.ndarray, beam: int = SEARCH_BEAM) -> np.ndarray:
    """Up to ``beam`` nodes near each query, -1 for none."""
    beam = min(beam, max(1, len(graph.vectors)))
    step = _batch(len(graph.vectors))
    found = []
    for at in range(0, len(queries), step):
        some = queries[at : at + step]
        entry = _descend(graph, some, graph.links[1:])
        found.append(_beam_search(graph.vectors, graph.links[0], some, entry, beam)[0])
    return np.concatenate(found) if found else np.empty((0, beam), np.int64)


def _scaled(vectors: np.ndarray, scale: float) -> np.ndarray:
    return (vectors.astype(np.float64) / scale).astype(np.float32)


def _build(kind: str):
    def build(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        size = key[0].as_py()
        order = np.random.default_rng(SEED).permutation(rows.num_rows)
        rows = rows.sort_by("vec").take(order)
        vectors = np.frombuffer(b"".join(rows.column("vec").to_pylist()), kind).reshape(-1, size)
        graph = build_graph(_scaled(vectors, float(np.abs(vectors).max())))
        ids = rows.column("ids").to_pylist()
        starts = np.cumsum([0, *map(len, ids)])
        row = {
            "size": size,
            "shard": key[1].as_py(),
            "vectors": vectors.tobytes(),
            "layers": [len(links) for links in graph.links],
            "links": b"".join(links.astype("<i4").tobytes() for links in graph.links),
            "starts": starts.astype("<i8").tobytes(),
            "ids": np.array([i for some in ids for i in some], "<i8").tobytes(),
        }
        schema = pa.schema(
            [("size", pa.int32()), ("shard", pa.int32()), ("vectors", pa.binary()), ("layers", pa.list_(pa.int32()))]
            + [(name, pa.binary()) for name in ("links", "starts", "ids")]
        )
        return pa.Table.from_pylist([row], schema)

    return build


class Shard:
    """One shard's index, read from its flat arrays."""

    def __init__(self, row: dict, kind: str):
        self.vectors = np.frombuffer(row["vectors"], kind).reshape(-1, row["size"])
        self.scale = float(np.abs(self.vectors).max())
        flat, links, at = np.frombuffer(row["links"], "<i4"), [], 0
        for layer, n in enumerate(row["layers"]):
            width = LINKS if layer else 2 * LINKS
            links.append(flat[at : at + n * width].reshape(n, width).astype(np.int64))
            at += n * width
        self.graph = Graph(_scaled(self.vectors, self.scale), links)
        self.starts, self.ids = np.frombuffer(row["starts"], "<i8"), np.frombuffer(row["ids"], "<i8")

    def nearest(self, queries: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query row, id and distance of the ``most`` nearest found: by distance, then by id."""
        nodes = search_graph(self.graph, _scaled(queries, self.scale))
        row, column = np.nonzero(nodes >= 0)
        node = nodes[row, column]
        apart = self.vectors[node].astype(np.float64) - queries[row].astype(np.float64)
        score = np.sqrt(np.einsum("ij,ij->i", apart, apart))
        copies = self.starts[node + 1] - self.starts[node]
        place = np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)
        ids = self.ids[np.repeat(self.starts[node], copies) + place]
        row, score = np.repeat(row, copies), np.repeat(score, copies)
        order = np.lexsort((ids, score, row))
        row, ids, score = row[order], ids[order], score[order]
        per_row = np.bincount(row, minlength=len(queries))
        rank = np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
        return row[rank < most], ids[rank < most], score[rank < most]


def _answer(kind: str, most: int):
    """Rows come by shard and block, the index first; queries stream past the index that is held."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, shard = None, None
        for part in parts:
            keys = list(zip(*(part.column(c).to_pylist() for c in ("size", "shard", "block"))))
            cuts = [0, *(k for k in range(1, len(keys)) if keys[k] != keys[k - 1]), len(keys)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                run = part.slice(a, b - a)
                if run.column("vectors")[0].is_valid:
                    held, shard = keys[a], Shard(run.slice(0, 1).to_pylist()[0], kind)
                    run = run.slice(1)
                if not run.num_rows:
                    continue
                if held != keys[a]:
                    raise RuntimeError(f"queries without an index: {keys[a]}")
                queries = np.frombuffer(b"".join(run.column("vec").to_pylist()), kind).reshape(run.num_rows, -1)
                row, ids, score = shard.nearest(queries, most)
                rep = run.column("rep").to_numpy()[row]
                yield pa.RecordBatch.from_arrays([pa.array(rep), pa.array(ids), pa.array(score)], ["rep", "id", "score"])

    return batches


def _usable(parts: Iterator[pa.RecordBatch], kind: str) -> Iterator[pa.RecordBatch]:
    """``vec_id, size, vec`` of the rows that take part; equal vectors have equal bytes."""
    for part in parts:
        ids, sizes, kept = [], [], []
        for vec_id, vector in zip(part.column(0).to_pylist(), part.column(1)):
            if vec_id is None or not vector.is_valid or vector.values.null_count:
                continue
            v = vector.values.to_numpy(zero_copy_only=False).astype(kind) + 0
            if np.isfinite(v).all() and v.any():
                ids.append(vec_id)
                sizes.append(len(v))
                kept.append(v.tobytes())
        columns = [pa.array(ids, pa.int64()), pa.array(sizes, pa.int32()), pa.array(kept, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["vec_id", "size", "vec"])


def vectors_of(embeddings: DataFrame) -> tuple[DataFrame, str]:
    """Usable rows of ``embeddings(vec_id, embedding)`` as ``vec_id, size, vec`` and the kind of the bytes."""
    single = embeddings.schema["embedding"].dataType.elementType == FloatType()
    kind, held = ("<f4", "array<float>") if single else ("<f8", "array<double>")
    plain = embeddings.select(F.col("vec_id").cast("long"), F.col("embedding").cast(held))
    rows = plain.mapInArrow(lambda parts: _usable(parts, kind), "vec_id long, size int, vec binary")
    return materialize(rows.distinct(), "vectors"), kind


def _distinct(vectors: DataFrame, copies: int) -> DataFrame:
    """One row per distinct vector with its ``copies`` smallest ids, dealt into shards of its length.

    ``rep`` is a number of the vector, fixed by writing it. The ids are cut to the smallest before and after the shuffle, so a vector that many rows share
    is no large group.
    """
    by_vector = Window.partitionBy("vec").orderBy("vec_id")
    few = vectors.withColumn("copy", F.row_number().over(by_vector)).where(F.col("copy") <= copies)
    nodes = few.groupBy("size", "vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    nodes = materialize(nodes.withColumn("rep", F.monotonically_increasing_id()), "nodes")
    sizes = nodes.groupBy("size").agg(
        F.ceil(F.count("*") * F.col("size") / SHARD_VALUES).cast("int").alias("shards")
    )
    shard = F.pmod(F.xxhash64("vec"), F.col("shards")).cast("int")
    return nodes.join(sizes, "size").withColumn("shard", shard)


def build_index(nodes: DataFrame, kind: str) -> DataFrame:
    """The shards' graphs as flat arrays, one row each; written to the shared folder."""
    rows = nodes.select("size", "shard", "vec", "ids")
    return materialize(rows.groupBy("size", "shard").applyInArrow(_build(kind), _INDEX), "index")


def search(index: DataFrame, queries: DataFrame, kind: str, most: int) -> DataFrame:
    """``rep, found``: the ``most`` nearest as structs of score and id, from all shards of the query's length.

    ``queries(rep, size, vec)`` are distinct. Each goes to every shard, in blocks of ``QUERY_BLOCK``
    which different tasks answer; a task holds one index and streams its queries.
    """
    blocks = queries.groupBy("size").agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("blocks"))
    shards = index.groupBy("size").agg(F.count("*").cast("int").alias("shards"))
    each = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    asked = queries.join(shards, "size").join(blocks, "size").select(
        "size", F.explode(each("shards")).alias("shard"), own.alias("block"), "rep", "vec"
    )
    held = index.join(blocks, "size").select("*", F.explode(each("blocks")).alias("block")).drop("blocks")
    rows = held.unionByName(asked, allowMissingColumns=True)
    key = ["size", "shard", "block"]
    rows = rows.repartition(*key).sortWithinPartitions(*key, F.col("rep").asc_nulls_first())
    found = rows.mapInArrow(_answer(kind, most), "rep long, id long, score double")
    best = Window.partitionBy("rep").orderBy("score", "id")
    merged = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= most)
    return merged.groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("score", "id"))).alias("found"))


def nearest(embeddings: DataFrame, is_query, k: int = NEAREST) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of the rows for which ``is_query`` holds.

    ``is_query`` is a condition on ``vec_id``; candidates are all rows of ``embeddings(vec_id,
    embedding)`` of the query's length with another ``vec_id``. ``score`` is the Euclidean distance of
    the original vectors in double precision, ranks go by it and then by ``vec_id``. Rows with a null
    id, and vectors that are null, empty, zero, or have null or non-finite components, take no part.
    Rows that repeat id and vector count once; an id with several vectors is a candidate with each,
    and asks with each. Other columns are not read; an empty table gives an empty result.

    Distinct vectors are dealt by a hash into shards of ``SHARD_VALUES`` components. A task builds the
    graph of a shard, and each query is answered from all shards' graphs; found nodes are compared
    exactly before the shards' results are merged. A node stands for all rows with its vector: of
    these the ``k + 1`` smallest ids can be results.
    """
    vectors, kind = vectors_of(embeddings)
    nodes = materialize(_distinct(vectors, k + 1), "dealt")
    index = build_index(nodes, kind)
    asking = vectors.where(is_query).join(nodes.select("vec", "rep"), "vec").select("vec_id", "rep", "size", "vec")
    found = search(index, asking.select("rep", "size", "vec").distinct(), kind, k + 1)
    others = F.slice(F.filter("found", lambda x: x.id != F.col("query_id")), 1, k)
    named = asking.select(F.col("vec_id").alias("query_id"), "rep").join(found, "rep")
    listed = named.select("query_id", F.posexplode(others).alias("place", "hit"))
    return listed.select(
        "query_id", (F.col("place") + 1).alias("rank"), F.col("hit.id").alias("vec_id"), F.col("hit.score").alias("score")
    )
