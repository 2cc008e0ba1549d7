"""Ranked lexical search: item bundles pass the owners of the terms one after the other."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlake.llm.texts import ROWS_AT_ONCE
from cohortlake.session import materialize

#: Documents returned for an item.
BEST = 10
#: Owners among which the terms are parted, and so stages that a bundle passes.
OWNERS = 4
#: Items of a bundle.
BUNDLE_ITEMS = 256
#: Documents, and postings, after which a block is closed; an accumulator is as wide as a block.
BLOCK_DOCS, BLOCK_POSTINGS = 2048, 1 << 20
#: Terms of the items that are searched for in one pass over the documents, in expectation; more take further passes.
TERMS_AT_ONCE = 500_000

#: Lower-cases A-Z; all other ASCII characters but letters and digits part terms.
_TERM_BYTES = bytes(c if c >= 128 else ord(chr(c).lower()) if chr(c).isalnum() else 32 for c in range(256))

_BLOCK = "docs array<long>, counted long, spoken long, lengths binary, terms binary, sizes binary, places binary, tfs binary"
_OWNED = "bundle int, block long, terms binary, sizes binary, places binary, shares binary"
_STATE = "bundle int, block long, docs array<long>, rest binary, sizes binary, places binary, scores binary"
_HITS = "item long, doc_id long, score long"


def terms_of(text: bytes | None) -> list[bytes]:
    """Maximal runs of ASCII letters and digits and characters beyond ASCII, A-Z lower-cased."""
    return (text or b"").translate(_TERM_BYTES).split()


@dataclass
class Plan:
    """What the stages of one pass need to know of its items."""

    items: list[int]  # numbers of the items
    wanted: list[np.ndarray]  # term numbers of each
    weight: np.ndarray  # of each term
    owner: np.ndarray  # of each term
    documents: int  # with at least one term
    spoken: int  # their terms with repeats
    best: int

    @property
    def bundles(self) -> int:
        return math.ceil(len(self.items) / BUNDLE_ITEMS)

    def bundle(self, k: int) -> range:
        return range(k * BUNDLE_ITEMS, min(len(self.items), (k + 1) * BUNDLE_ITEMS))


def _numbered_items(benchmark: DataFrame) -> DataFrame:
    """``item, item_id, terms``: the distinct terms of each item, under a number of its own."""

    def split(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for at in range(0, part.num_rows, ROWS_AT_ONCE):
                rows = part.slice(at, ROWS_AT_ONCE)
                said = [sorted(set(terms_of(text))) for text in rows.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(said, pa.list_(pa.binary()))], ["item_id", "terms"])

    rows = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string").cast("binary"))
    said = rows.mapInArrow(split, "item_id long, terms array<binary>")
    items = said.groupBy("item_id").agg(F.array_distinct(F.flatten(F.collect_set("terms"))).alias("terms"))
    return materialize(items.select(F.monotonically_increasing_id().alias("item"), "item_id", "terms"), "items")


def _post(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Blocks of documents with the postings of the vocabulary, by term; written to the shared folder.

    Every document with a term is counted with its length; ``places`` of a term are rows of ``docs``.
    """

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([
            ("docs", pa.list_(pa.int64())), ("counted", pa.int64()), ("spoken", pa.int64()),
            *((name, pa.binary()) for name in ("lengths", "terms", "sizes", "places", "tfs")),
        ])
        size, get = len(vocabulary), vocabulary.get
        held: list[tuple] = []  # (id, length, terms, times) of the documents of the block
        postings = counted = spoken = 0

        def block() -> pa.RecordBatch:
            term = np.concatenate([np.empty(0, np.int64), *(h[2] for h in held)])
            times = np.concatenate([np.empty(0, np.int64), *(h[3] for h in held)])
            place = np.repeat(np.arange(len(held)), [len(h[2]) for h in held])
            order = np.argsort(term, kind="stable")
            terms, sizes = np.unique(term, return_counts=True)
            row = {
                "docs": [h[0] for h in held],
                "counted": counted,
                "spoken": spoken,
                "lengths": np.array([h[1] for h in held], "<i8").tobytes(),
                "terms": terms.astype("<i4").tobytes(),
                "sizes": sizes.astype("<i4").tobytes(),
                "places": place[order].astype("<u2").tobytes(),
                "tfs": times[order].astype("<i8" if times.max(initial=0) >= 1 << 31 else "<i4").tobytes(),
            }
            return pa.RecordBatch.from_pylist([row], kind)

        for part in parts:
            for at in range(0, part.num_rows, ROWS_AT_ONCE):
                rows = part.slice(at, ROWS_AT_ONCE)
                for doc_id, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                    said = terms_of(text)
                    if not said:
                        continue
                    counted, spoken = counted + 1, spoken + len(said)
                    number = np.fromiter(map(get, said, repeat(size)), np.int64, len(said))
                    term, times = np.unique(number, return_counts=True)
                    if term[-1] == size:
                        term, times = term[:-1], times[:-1]
                    if not len(term):
                        continue
                    held.append((doc_id, len(said), term, times))
                    postings += len(term)
                    if len(held) == BLOCK_DOCS or postings >= BLOCK_POSTINGS:
                        yield block()
                        held, postings, counted, spoken = [], 0, 0, 0
        if counted:
            yield block()

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary"))
    blocks = rows.mapInArrow(batches, _BLOCK)
    return materialize(blocks.select(F.monotonically_increasing_id().alias("block"), "*"), "postings")


def _frequencies(blocks: DataFrame, terms: int) -> np.ndarray:
    """Documents that hold each term; a row per term and task is shuffled."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(terms, np.int64)
        for part in parts:
            for term, size in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                held[np.frombuffer(term, "<i4")] += np.frombuffer(size, "<i4")
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(held[some])], ["term", "n"])

    found = np.zeros(terms, np.int64)
    for row in blocks.select("terms", "sizes").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n")).collect():
        found[row[0]] = row[1]
    return found


def _weights(frequency: np.ndarray, documents: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1))) for df in frequency], np.int64)


def _owners(wanted: list[np.ndarray], weight: np.ndarray) -> np.ndarray:
    """The owner of each term: the heaviest terms first, each owner with an even part of the items' weight.

    What the owners still to come can add falls fastest that way, and with it the accumulators.
    """
    mass = np.bincount(np.concatenate([np.empty(0, np.int64), *wanted]), minlength=len(weight)) * weight
    order = np.lexsort((np.arange(len(weight)), -weight))
    before = np.cumsum(mass[order]) - mass[order]
    owner = np.zeros(len(weight), np.int64)
    owner[order] = np.minimum(OWNERS - 1, before * OWNERS // max(1, int(mass.sum())))
    return owner


def _shares(row: dict, plan: Plan) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of a block, their numbers of postings, places, and the postings' shares before the weight."""
    lengths = np.frombuffer(row["lengths"], "<i8").tolist()
    m = np.array([100 - 90 + 90 * n * plan.documents // plan.spoken for n in lengths], np.int64)
    places = np.frombuffer(row["places"], "<u2")
    wide = len(row["tfs"]) == 8 * len(places)
    tf = np.frombuffer(row["tfs"], "<i8" if wide else "<i4").astype(np.int64)
    share = 1_000_000_000 * tf // (1000 * tf + 8 * m[places])
    return np.frombuffer(row["terms"], "<i4"), np.frombuffer(row["sizes"], "<i4"), places, share


def _asked(plan: Plan, bundle: int) -> np.ndarray:
    asked = np.zeros(len(plan.weight), bool)
    for k in plan.bundle(bundle):
        asked[plan.wanted[k]] = True
    return asked


def _owned(blocks: DataFrame, plan: Plan, owner: int) -> DataFrame:
    """The owner's postings of each block, for every bundle that asks for some of its terms."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = [_asked(plan, b) & (plan.owner == owner) for b in range(plan.bundles)]
        for part in parts:
            for k in range(part.num_rows):
                row = part.slice(k, 1).to_pylist()[0]
                terms, sizes, places, share = _shares(row, plan)
                for bundle in range(plan.bundles):
                    mine = asked[bundle][terms]
                    if not mine.any():
                        continue
                    each = np.repeat(mine, sizes)
                    found = (terms[mine], sizes[mine], places[each], share[each].astype("<i4"))
                    columns = [pa.array([bundle], pa.int32()), pa.array([row["block"]], pa.int64())]
                    columns += [pa.array([part.tobytes()], pa.binary()) for part in found]
                    yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in _OWNED.split(", ")])

    return blocks.mapInArrow(batches, _OWNED)


def _bundles(blocks: DataFrame, plan: Plan) -> DataFrame:
    """Every bundle at every block, with empty accumulators and what each owner can add at most."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for k in range(part.num_rows):
                row = part.slice(k, 1).to_pylist()[0]
                terms, sizes, _, share = _shares(row, plan)
                most = np.zeros(len(plan.weight), np.int64)
                if len(terms):
                    most[terms] = np.maximum.reduceat(share, np.cumsum(sizes) - sizes) * plan.weight[terms]
                for bundle in range(plan.bundles):
                    rest = np.zeros((len(plan.bundle(bundle)), OWNERS + 1), np.int64)
                    for i, item in enumerate(plan.bundle(bundle)):
                        wanted = plan.wanted[item]
                        np.add.at(rest[i], plan.owner[wanted], most[wanted])
                    # from each owner on: itself and all after it
                    rest = np.ascontiguousarray(rest[:, ::-1].cumsum(axis=1)[:, ::-1])
                    if rest[:, 0].any():
                        empty = np.zeros(len(rest), "<i4").tobytes()
                        yield _state(bundle, row["block"], row["docs"], rest.tobytes(), empty, b"", b"")

    return blocks.mapInArrow(batches, _STATE)


def _state(bundle, block, docs, rest, sizes, places, scores) -> pa.RecordBatch:
    columns = [pa.array([bundle], pa.int32()), pa.array([block], pa.int64()), pa.array([docs], pa.list_(pa.int64()))]
    columns += [pa.array([part], pa.binary()) for part in (rest, sizes, places, scores)]
    return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in _STATE.split(", ")])


def _accumulators(row: dict) -> np.ndarray:
    """Items by documents of the block, from their sparse form."""
    sizes = np.frombuffer(row["sizes"], "<i4")
    total = np.zeros((len(sizes), len(row["docs"])), np.int64)
    total[np.repeat(np.arange(len(sizes)), sizes), np.frombuffer(row["places"], "<u2")] = np.frombuffer(row["scores"], "<i8")
    return total


def _pass_owner(plan: Plan, owner: int):
    """What an owner does to a bundle at a block: add its contributions, drop what cannot be among the best.

    The ``best``-th highest score so far bounds an item's result in the block from below, what the
    owners to come can add bounds each document from above; so nothing of the result is lost.
    """

    def add(bundles: pa.Table, owned: pa.Table) -> pa.Table:
        found = [_state(b, 0, [], b"", b"", b"", b"").slice(0, 0) for b in (0,)]
        for row in bundles.to_pylist():
            total = _accumulators(row)
            for held in owned.to_pylist():
                terms, sizes = np.frombuffer(held["terms"], "<i4"), np.frombuffer(held["sizes"], "<i4")
                places, shares = np.frombuffer(held["places"], "<u2"), np.frombuffer(held["shares"], "<i4")
                stop = np.cumsum(sizes)
                at = np.full(len(plan.weight), -1)
                at[terms] = np.arange(len(terms))
                gain = shares * np.repeat(plan.weight[terms], sizes)
                for i, item in enumerate(plan.bundle(row["bundle"])):
                    for t in at[plan.wanted[item]]:
                        if t >= 0:
                            a, b = stop[t] - sizes[t], stop[t]
                            total[i, places[a:b]] += gain[a:b]
            rest = np.frombuffer(row["rest"], "<i8").reshape(len(total), -1)[:, owner + 1]
            if total.shape[1] > plan.best:
                least = np.partition(total, -plan.best, axis=1)[:, -plan.best]
            else:
                least = np.zeros(len(total), np.int64)
            item, place = np.nonzero((total > 0) & (total + rest[:, None] >= least[:, None]))
            sizes = np.bincount(item, minlength=len(total)).astype("<i4")
            found.append(_state(
                row["bundle"], row["block"], row["docs"], row["rest"], sizes.tobytes(),
                place.astype("<u2").tobytes(), total[item, place].astype("<i8").tobytes(),
            ))
        return pa.Table.from_batches(found)

    return add


def _block_best(plan: Plan):
    """The best documents of each item in each block."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for k in range(part.num_rows):
                row = part.slice(k, 1).to_pylist()[0]
                sizes, places = np.frombuffer(row["sizes"], "<i4"), np.frombuffer(row["places"], "<u2")
                scores, stop = np.frombuffer(row["scores"], "<i8"), np.cumsum(sizes)
                hits = []
                for i, item in enumerate(plan.bundle(row["bundle"])):
                    some = range(stop[i] - sizes[i], stop[i])
                    near = [(-int(scores[j]), row["docs"][places[j]] is None, row["docs"][places[j]] or 0, j) for j in some]
                    hits += [(plan.items[item], row["docs"][places[j]], int(scores[j])) for *_, j in sorted(near)[: plan.best]]
                columns = [pa.array([h[c] for h in hits], pa.int64()) for c in range(3)]
                yield pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "score"])

    return batches


def _search(docs: DataFrame, rows: list, best: int) -> DataFrame | None:
    """``item, doc_id, score``: the best documents of each block for the items of one pass."""
    vocabulary = {term: k for k, term in enumerate(sorted({bytes(t) for row in rows for t in row.terms}))}
    if not vocabulary:
        return None
    blocks = _post(docs, vocabulary)
    documents, spoken = blocks.agg(F.sum("counted"), F.sum("spoken")).first()
    if not documents:
        return None
    wanted = [np.array(sorted(vocabulary[bytes(t)] for t in row.terms), np.int64) for row in rows]
    weight = _weights(_frequencies(blocks, len(vocabulary)), documents)
    plan = Plan([row.item for row in rows], wanted, weight, _owners(wanted, weight), documents, spoken, best)
    bundles, key = _bundles(blocks, plan), ("bundle", "block")
    for owner in range(OWNERS):
        owned = _owned(blocks, plan, owner)
        bundles = bundles.groupBy(*key).cogroup(owned.groupBy(*key)).applyInArrow(_pass_owner(plan, owner), _STATE)
    return bundles.mapInArrow(_block_best(plan), _HITS)


def rank(docs: DataFrame, benchmark: DataFrame, best: int = BEST) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``best`` documents with a score above 0 for each item.

    ``docs(doc_id, text)`` and ``benchmark(item_id, text)``; scores are sums over the item's distinct
    terms of an integer weight times an integer share that saturates with the term's number in the
    document and falls with the document's length. Equal scores go by ascending ``doc_id``, nulls
    last. Every row of ``docs`` is a document, also repeated ones; null texts and texts without terms
    count for nothing. Rows that share an ``item_id`` (or have none) are one item with the terms of
    all. Other columns are not read; empty tables give an empty result.

    The items come to the driver in passes of about ``TERMS_AT_ONCE`` terms, for each of which the
    documents are read once. Postings are written in blocks of documents, so a term that all
    documents hold is spread like any other. A bundle of items visits the owners of the terms, one
    cogroup by bundle and block after the other, and carries a sparse accumulator per item.
    """
    items = _numbered_items(benchmark)
    passes = max(1, math.ceil((items.agg(F.sum(F.size("terms"))).first()[0] or 0) / TERMS_AT_ONCE))
    own = F.pmod(F.xxhash64("item"), F.lit(passes))
    found = [_search(docs, items.where(own == k).orderBy("item").collect(), best) for k in range(passes)]
    none = docs.sparkSession.createDataFrame([], _HITS)
    hits = reduce(DataFrame.unionByName, [f for f in found if f is not None], none)
    by_item = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    placed = hits.withColumn("rank", F.row_number().over(by_item)).where(F.col("rank") <= best)
    return placed.join(items.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
