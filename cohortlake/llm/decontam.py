"""Benchmark decontamination by latent semantic retrieval."""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.llm.texts import ROWS_AT_ONCE, release

#: Words of a block; a passage of a document is two blocks, and starts at each of them.
BLOCK = 32
#: Words of a benchmark passage at most: every run of as many words lies whole in some passage.
PART = BLOCK
#: Benchmark items with fewer words are found only where a text holds all of them in a row.
LEAST_WORDS = 5
#: Benchmark passages that span a latent space, so its rank at most; more passages make more spaces.
RANK = 256
#: Benchmark items that are searched for in one pass over the documents; more take further passes.
ITEMS_AT_ONCE = 1000
#: Share of a benchmark passage's weight that a candidate passage holds.
CANDIDATE = 0.5
#: Weighted share of an item's words in order from which on it is found, and that from which on it
#: is found if its answer is there as well.
COPY, PARAPHRASE, ANSWER = 0.8, 0.6, 0.8
SEED = 5
_PASSAGES_AT_ONCE = 512

#: Scripts written without spaces between words: each of their characters is one.
_UNSPACED = r"\p{Han}\p{Hiragana}\p{Katakana}\p{Bopomofo}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}\p{Tibetan}"
_WORD = regex.compile(rf"[{_UNSPACED}]|(?:(?![{_UNSPACED}])[\p{{L}}\p{{N}}\p{{M}}])+")
#: Beyond these, ASCII and the accented letters of the Latin blocks, a text has to be looked at by character.
_BEYOND_LATIN = re.compile("[^\x00-\x7fÀ-ÖØ-öø-ɏ]")
#: ASCII characters that part words: all but letters and digits.
_PARTS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_SENTENCE = re.compile(r"[.!?。！？]+\s+|\n+")

FIELDS = "item_id long, cosine double, lcs double, answer double, first_word long, words long"


def words(text: str | None) -> list[bytes]:
    """Lower-cased runs of letters, marks and digits; single characters of scripts without spaces."""
    text = (text or "").lower()
    if text.isascii() or not _BEYOND_LATIN.search(text):
        return text.encode().translate(_PARTS).split()
    return [word.encode() for word in _WORD.findall(text)]


def answer_words(text: str | None, answer: str | None) -> list[bytes]:
    """Words of the item's answer: the given one, else the last sentence of the text."""
    if words(answer):
        return words(answer)
    sentences = [s for s in map(words, _SENTENCE.split(text or "")) if s]
    return sentences[-1] if sentences else []


@dataclass
class Item:
    item_id: int
    words: np.ndarray  # term numbers
    answer: np.ndarray


@dataclass
class Space:
    """A latent space and the benchmark passages that span it."""

    local: np.ndarray  # row of each term in ``latent``
    latent: np.ndarray  # weighted latent vectors; the last, of all other terms, is zero
    owner: np.ndarray  # item of each passage
    offset: np.ndarray  # its first word in the item
    queries: np.ndarray  # latent passages over their weight
    length: np.ndarray  # weight of the passages over their length
    least: float  # weight of a document's passage below which it can be no candidate


@dataclass
class Index:
    """Terms of the benchmark, their weights, the items and the latent spaces of their passages."""

    terms: dict[bytes, int]
    weight: np.ndarray  # one more than terms: that of words which are none of them
    items: list[Item]
    spaces: list[Space]
    short: dict[int, tuple[np.ndarray, dict[int, list[Item]]]]  # by number of words: keys, and the items of each


def _parts(n: int) -> list[tuple[int, int]]:
    """Even parts of ``n`` words of at most ``PART`` words."""
    count = math.ceil(n / PART)
    return [(n * k // count, n * (k + 1) // count) for k in range(count)]


def _benchmark(items: DataFrame) -> list[tuple[int, list[bytes], list[bytes]]]:
    """Usable items with their words and answers, ordered by id; at most ``ITEMS_AT_ONCE`` in expectation."""
    rows = sorted((r.item_id, r.text or "", r.answer or "") for r in items.collect())
    found = ((i, words(text), answer_words(text, answer)) for i, text, answer in dict.fromkeys(rows))
    return [item for item in found if item[1]]


def _frequencies(docs: DataFrame, terms: dict[bytes, int]) -> tuple[np.ndarray, int]:
    """Documents that hold each term, and the number of documents; over whole texts of all rows."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        held, known = np.zeros(len(terms) + 1, np.int64), terms.keys()
        for part in parts:
            for at in range(0, part.num_rows, ROWS_AT_ONCE):
                for text in part.column(0).slice(at, ROWS_AT_ONCE).to_pylist():
                    held[[terms[w] for w in known & set(words(text))]] += 1
            held[-1] += part.num_rows
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(held[some])], ["term", "n"])

    counted = docs.select(F.col("text").cast("string")).mapInArrow(count, "term long, n long")
    found = np.zeros(len(terms) + 1, np.int64)
    for row in counted.groupBy("term").agg(F.sum("n").alias("n")).collect():
        found[row.term] = row.n
    return found[:-1], int(found[-1])


def _sparse(parts: list[np.ndarray], weight: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Terms of each passage and the roots of their weights.

    Times a document's passage, which has its roots as often as it has the term, they give the weight
    of all words that both hold: no less than that of any common subsequence.
    """
    return [(terms, np.sqrt(weight[terms])) for terms in map(np.unique, parts)]


def _times(rows: list[tuple[np.ndarray, np.ndarray]], right: np.ndarray) -> np.ndarray:
    return np.array([w @ right[t] for t, w in rows]).reshape(len(rows), right.shape[1])


def latent_space(spark, rows: list[tuple[np.ndarray, np.ndarray]], terms: int) -> np.ndarray:
    """Right singular vectors of the TF-IDF passages ``rows`` by a randomised range finder.

    The passages are dealt over tasks. Each multiplies its own with the random matrix and back, the
    tasks' products are added per term, and matrices as wide as the rank come to the driver.
    """
    width = min(len(rows), terms)
    frame = spark.createDataFrame(
        [(t.tolist(), w.tolist()) for t, w in rows], "terms array<int>, weights array<double>"
    ).repartition(math.ceil(len(rows) / 64))

    def product(right: np.ndarray | None) -> np.ndarray:
        def back(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            basis = np.random.default_rng(SEED).standard_normal((terms, width)) if right is None else right
            total: dict[int, np.ndarray] = {}
            for part in parts:
                for t, w in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    forth = np.array(w) @ basis[t]
                    for term, value in zip(t, w):
                        total[term] = total.get(term, 0) + value * forth
            yield _vectors(total)

        def add(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[int, np.ndarray] = {}
            for part in parts:
                for term, vector in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    total[term] = total.get(term, 0) + np.frombuffer(vector)
            yield _vectors(total)

        summed = frame.mapInArrow(back, _VECTORS).repartition("term").mapInArrow(add, _VECTORS)
        found = np.zeros((terms, width))
        for row in summed.collect():
            found[row.term] = np.frombuffer(row.vector)
        return found

    basis = np.linalg.qr(product(None))[0]
    basis = np.linalg.qr(product(basis))[0]  # one power iteration
    small = basis.T @ product(basis)  # the passages' Gram matrix within the range
    return basis @ np.linalg.eigh((small + small.T) / 2)[1][:, ::-1]


_VECTORS = "term long, vector binary"


def _vectors(total: dict[int, np.ndarray]) -> pa.RecordBatch:
    columns = [pa.array(list(total), pa.int64()), pa.array([v.tobytes() for v in total.values()], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["term", "vector"])


def build_index(docs: DataFrame, items: DataFrame) -> Index | None:
    """The index of one block of items, weighted by the documents' frequencies. None without usable items."""
    usable = _benchmark(items)
    if not usable:
        return None
    terms = {w: k for k, w in enumerate(sorted({w for _, said, answer in usable for w in [*said, *answer]}))}
    frequency, total = _frequencies(docs, terms)
    weight = np.log((1 + total) / (1 + frequency)) + 0.1
    numbered = [Item(i, *(np.array([terms[w] for w in part], np.int64) for part in (said, answer))) for i, said, answer in usable]
    cuts = [
        (k, a, b) for k, item in enumerate(numbered) if len(item.words) >= LEAST_WORDS for a, b in _parts(len(item.words))
    ]
    spaces = [_space(docs.sparkSession, numbered, group, weight) for group in _alike(numbered, cuts, weight)]
    return Index(terms, np.append(weight, np.log(1 + total) + 0.1), numbered, spaces, _short(numbered))


def _run_keys(ids: np.ndarray, n: int) -> np.ndarray:
    """A number for each run of ``n`` terms."""
    key = np.zeros(max(0, len(ids) - n + 1), np.uint64)
    for k in range(n):
        key = key * np.uint64(0x9E3779B97F4A7C15) + ids[k : k + len(key)].astype(np.uint64)
    return key


def _short(items: list[Item]) -> dict[int, tuple[np.ndarray, dict[int, list[Item]]]]:
    found: dict[int, dict[int, list[Item]]] = defaultdict(lambda: defaultdict(list))
    for item in items:
        if len(item.words) < LEAST_WORDS:
            found[len(item.words)][int(_run_keys(item.words, len(item.words))[0])].append(item)
    return {n: (np.array(sorted(by_key), np.uint64), dict(by_key)) for n, by_key in found.items()}


def _whole_runs(index: Index, numbers: list[np.ndarray]) -> Iterator[tuple[int, dict]]:
    """Texts that hold a short item word for word, with the place of its first run."""
    flat = np.concatenate([np.empty(0, np.int64), *numbers])
    stops = np.cumsum([len(ids) for ids in numbers])
    for n, (keys, items) in sorted(index.short.items()):
        run = _run_keys(flat, n)
        at = np.flatnonzero(np.isin(run, keys))
        text = np.searchsorted(stops, at, side="right")
        at = at[at + n <= stops[text]]  # a run ends in the text that it starts in
        seen = set()
        for place, key in zip(at.tolist(), run[at].tolist()):
            owner = int(np.searchsorted(stops, place, side="right"))
            if (owner, key) in seen:
                continue
            same = [item for item in items[key] if np.array_equal(item.words, flat[place : place + n])]
            if same:
                seen.add((owner, key))
            for item in same:
                first = place - int(stops[owner]) + len(numbers[owner])
                yield owner, {"item_id": item.item_id, "cosine": 1.0, "lcs": 1.0, "answer": 1.0, "first_word": first, "words": n}


def _needed(item: Item, start: int, stop: int, weight: np.ndarray) -> float:
    """Weight of a document's passage below which it cannot hold ``CANDIDATE`` of this benchmark passage."""
    return CANDIDATE * float(weight[item.words[start:stop]].sum())


def _alike(items: list[Item], cuts: list[tuple[int, int, int]], weight: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """The passages in groups of at most ``RANK`` whose needed weights are within a factor of two.

    A space skips documents' passages that are too light for all of its own, so it should hold none
    that is much lighter than the others.
    """
    needed = [_needed(items[k], a, b, weight) for k, a, b in cuts]
    groups: list[list[tuple[int, int, int]]] = []
    top = 0.0
    for at in sorted(range(len(cuts)), key=lambda at: (-needed[at], cuts[at])):
        if not groups or len(groups[-1]) == RANK or needed[at] < top / 2:
            groups.append([])
            top = needed[at]
        groups[-1].append(cuts[at])
    return groups


def _space(spark, items: list[Item], cuts: list[tuple[int, int, int]], weight: np.ndarray) -> Space:
    own = np.unique(np.concatenate([items[k].words[a:b] for k, a, b in cuts]))
    local = np.full(len(weight) + 1, len(own), np.int64)
    local[own] = np.arange(len(own))
    rows = _sparse([local[items[k].words[a:b]] for k, a, b in cuts], weight[own])
    basis = latent_space(spark, rows, len(own))
    passages = _times(rows, basis)
    whole = np.array([weight[items[k].words[a:b]].sum() for k, a, b in cuts])
    latent = np.vstack([basis * np.sqrt(weight[own])[:, None], np.zeros((1, basis.shape[1]))])
    least = min(_needed(items[k], a, b, weight) for k, a, b in cuts)
    return Space(
        local, latent.astype(np.float32), np.array([k for k, _, _ in cuts]), np.array([a for _, a, _ in cuts]),
        (passages / whole[:, None]).T.astype(np.float32), whole / np.sqrt((passages**2).sum(axis=1)), 0.999 * least,
    )


def common_share(item: np.ndarray, region: np.ndarray, weight: np.ndarray) -> float:
    """Weight of the longest common subsequence of two runs of terms, over the weight of ``item``."""
    if not len(item):
        return 0.0
    best = np.zeros(len(item) + 1)
    gain = weight[item]
    for term in region[np.isin(region, item)]:
        best[1:] = np.maximum(best[1:], best[:-1] + np.where(item == term, gain, 0.0))
        np.maximum.accumulate(best, out=best)
    return float(best[-1] / gain.sum())


def search(index: Index, texts: list[str | None]) -> list[list[dict]]:
    """Items found in each whole text."""
    other = len(index.terms)
    numbers, blocks, first = [], [np.empty((0, BLOCK), np.int64)], [0]
    for text in texts:
        said = words(text)
        ids = np.fromiter(map(index.terms.get, said, repeat(other)), np.int64, len(said))
        numbers.append(ids)
        count = math.ceil(len(ids) / BLOCK)
        blocks.append(np.pad(ids, (0, count * BLOCK - len(ids)), constant_values=other).reshape(count, BLOCK))
        first.append(first[-1] + count)
    flat, starts = np.concatenate(blocks), np.array(first)
    follows = np.ones(len(flat), np.int64)  # a document's last block is a passage by itself
    follows[starts[1:][np.diff(starts) > 0] - 1] = 0
    hits: dict[tuple[int, int], list[tuple]] = defaultdict(list)
    for space in index.spaces:
        for row, query, share in _candidates(space, index.weight, flat, follows):
            text = int(np.searchsorted(starts, row, side="right")) - 1
            near = (share, int(row - first[text]), int(space.offset[query]), float(space.length[query]))
            hits[text, int(space.owner[query])].append(near)
    found: list[list[dict]] = [[] for _ in texts]
    present = np.zeros(len(index.weight), bool)
    for (text, owner), near in sorted(hits.items()):
        said = _verify(index, index.items[owner], numbers[text], sorted(near, reverse=True), present)
        if said:
            found[text].append(said)
    for text, said in _whole_runs(index, numbers):
        found[text].append(said)
    return found


def _candidates(space: Space, weight: np.ndarray, flat: np.ndarray, follows: np.ndarray) -> Iterator[tuple]:
    """Passages (by their first block), benchmark passages, and the share of these that they hold."""
    own = np.append(weight[:-1], 0.0)
    own[space.local == len(space.latent) - 1] = 0.0
    mass = np.append(own[flat].sum(axis=1), 0.0)
    able = np.flatnonzero(mass[:-1] + mass[1:] * follows >= space.least)
    for at in range(0, len(able), _PASSAGES_AT_ONCE):
        rows = able[at : at + _PASSAGES_AT_ONCE]
        paired = follows[rows] == 1
        needed = np.union1d(rows, rows[paired] + 1)  # a block is summed once, as first and as second half
        sums = space.latent[space.local[flat[needed]]].sum(axis=1)
        summed = sums[np.searchsorted(needed, rows)]
        summed[paired] += sums[np.searchsorted(needed, rows[paired] + 1)]
        share = summed @ space.queries
        for row, query in np.argwhere(share >= CANDIDATE):
            yield int(rows[row]), int(query), float(share[row, query])


def _verify(index: Index, item: Item, ids: np.ndarray, near: list[tuple], present: np.ndarray) -> dict | None:
    """The best candidate passage whose words, in order, give the item or a paraphrase with its answer.

    ``present`` marks terms of a region; it is clear before and after.
    """
    n, slack = len(item.words), len(item.words) // 4 + 8
    weight = index.weight[item.words]
    least = PARAPHRASE * weight.sum()
    best = None
    for share, block, offset, length in near:
        start = block * BLOCK - offset
        low, high = max(0, start - slack), start + 2 * BLOCK + n + slack
        region = ids[low:high]
        present[region] = True
        held = weight[present[item.words]].sum()
        present[region] = False
        if held < least:
            continue  # not even in any order
        common = common_share(item.words, region, index.weight)
        if common < PARAPHRASE or best and common <= best["lcs"]:
            continue
        answer = common_share(item.answer, region, index.weight)
        if common < COPY and answer < ANSWER:
            continue
        passage = ids[block * BLOCK : (block + 2) * BLOCK]
        terms, times = np.unique(passage, return_counts=True)
        norm = math.sqrt(float((times**2 * index.weight[terms]).sum()))
        best = {
            "item_id": item.item_id, "cosine": min(1.0, share * length / norm), "lcs": common,
            "answer": answer, "first_word": low, "words": len(region),
        }
        if common > 0.999:
            break
    return best


def _blocks(benchmark: DataFrame) -> list[DataFrame]:
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"), answer.alias("answer"))
    items = items.where("item_id is not null and text is not null")
    count = max(1, math.ceil(items.count() / ITEMS_AT_ONCE))
    block = F.pmod(F.xxhash64("item_id"), F.lit(count))
    return [items.where(block == k) for k in range(count)]


def annotate_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """All columns of ``docs`` in a struct ``doc``, and ``leaks``: the items found in the whole text.

    The documents are read once for the term frequencies and once for the search for each block of
    ``ITEMS_AT_ONCE`` items; they are never shuffled, and no pair of passages leaves its task.
    """
    kind = "array<struct<" + ", ".join(f.replace(" ", ": ") for f in FIELDS.split(", ")) + ">>"
    columns = [docs[c].cast("string").alias(c) if c == "text" else docs[c] for c in docs.columns]
    found = docs.select(F.struct(*columns).alias("doc"), F.array().cast(kind).alias("leaks"))
    schema = found.schema
    for items in _blocks(benchmark):
        index = build_index(docs, items)
        if index:
            found = found.mapInArrow(_searcher(index), schema)
    return found


def _searcher(index: Index):
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for part in parts:
            for at in range(0, part.num_rows, ROWS_AT_ONCE):
                rows = part.slice(at, ROWS_AT_ONCE)
                more = search(index, rows.column(0).field("text").to_pylist())
                leaks = [a + b for a, b in zip(rows.column(1).to_pylist(), more)]
                columns = [rows.column(0), pa.array(leaks, rows.schema.field(1).type)]
                yield pa.RecordBatch.from_arrays(columns, rows.schema.names)

    return batches


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id`` and the fields of ``FIELDS`` for every item of ``benchmark`` that a row of ``docs`` holds.

    ``benchmark(item_id, text)`` may have an ``answer``; else an item's answer is its last sentence. An
    item is found where the weighted longest common subsequence with a region of the document has
    ``COPY`` of its weight, or ``PARAPHRASE`` of it and ``ANSWER`` of the answer's; an item under
    ``LEAST_WORDS`` words where the document has all its words in a row. Items with a null id, or
    without a word, are not searched; null and empty documents hold nothing.
    Equal items are each found; repeated documents give repeated rows, a null ``doc_id`` a row with
    null. Other columns are not read; empty tables give an empty result.

    Weights are inverse document frequencies over all rows. The passages of the benchmark span the
    latent space, all passages of all documents are projected into it, and those that hold
    ``CANDIDATE`` of a benchmark passage's weight are verified.
    """
    found = annotate_leaks(docs.select("doc_id", "text"), benchmark)
    return found.select(F.col("doc.doc_id").cast("long").alias("doc_id"), F.inline("leaks"))
