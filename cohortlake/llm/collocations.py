"""Phrases that occur together: multikey quicksort of suffixes, routed by their leading words."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlake.llm.texts import BATCH_BYTES, ROWS_AT_ONCE, bounded_batches
from cohortlake.session import materialize

#: Occurrences of a phrase at least, and words of one at most.
LEAST, LONGEST = 30, 4
#: Phrases returned for a language.
BEST = 2000
#: Percent of a phrase's occurrences that lie inside one longer phrase, from which on the longer one stands for it.
COVERED = 80
#: Words after which a task closes its chunks (a piece of text is never cut).
CHUNK_WORDS = 1 << 21
#: Suffixes of a bucket in expectation, and occurrences from which on a word does not end a suffix's route:
#: only what would fill half a bucket by itself is spread, because its phrases are then counted in parts.
BUCKET_SUFFIXES = 1 << 21
HOT = BUCKET_SUFFIXES // 2
#: Bytes of a chunk's text or of routed suffixes in a row, so that the JVM holds and sends them in small pieces.
ROW_BYTES = 1 << 18
#: Words of a chunk sent back at once.
WORDS_AT_ONCE = 1 << 16
#: Suffixes of a bucket in expectation that are sorted at the same time, and phrases sent back at once.
SORTED_AT_ONCE, PHRASES_AT_ONCE = 1 << 18, 1 << 16
#: What a language is called that is not given.
UNKNOWN = "und"

#: Lower-cases A-Z, turns tabs into spaces, and what parts pieces into a byte that no text has.
_PIECE_END = 0xFF
_BYTES = bytes(
    _PIECE_END if chr(c) in ".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256)
)
_MARK = bytes([_PIECE_END])
_CODES = [f"w{k + 1}" for k in range(LONGEST)]

_CHUNK = "chunk long, lang string, n long, part long, said binary, place long, word binary"
_CHUNK_SCHEMA = pa.schema([
    ("chunk", pa.int64()), ("lang", pa.string()), ("n", pa.int64()),
    ("part", pa.int64()), ("said", pa.binary()), ("place", pa.int64()), ("word", pa.binary()),
])
_ROUTED = "bucket int, words binary, counts binary"
_ROUTED_SCHEMA = pa.schema([("bucket", pa.int32()), ("words", pa.binary()), ("counts", pa.binary())])


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a text, with ``_MARK`` where a piece ends."""
    return (text or b"").translate(_BYTES).replace(_MARK, b" " + _MARK + b" ").split()


class _Numbers(dict):
    """Numbers words in the order they are first asked for."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _chunk_rows(chunk: int, lang: str, every: np.ndarray, names: list[bytes], mark: int) -> Iterator[pa.RecordBatch]:
    """Rows of one chunk: its text in parts of ``ROW_BYTES``, then its words; in batches of bounded size."""

    def batch(rows: int, **columns) -> pa.RecordBatch:
        columns |= {"chunk": pa.repeat(pa.scalar(chunk, pa.int64()), rows), "lang": pa.repeat(lang, rows)}
        made = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(rows, f.type) for f in _CHUNK_SCHEMA]
        return pa.RecordBatch.from_arrays(made, schema=_CHUNK_SCHEMA)

    counts, ends = np.bincount(every, minlength=len(names)), every == mark
    every[ends] = -1
    at_once = max(1, ROW_BYTES // every.itemsize)
    starts, together = range(0, len(every), at_once), max(1, BATCH_BYTES // ROW_BYTES)
    for first in range(0, len(starts), together):
        own = [slice(a, a + at_once) for a in starts[first : first + together]]
        n = [int(np.count_nonzero(~ends[k])) for k in own]
        yield batch(len(own), n=n, part=range(first, first + len(own)), said=[every[k].tobytes() for k in own])
    for a in range(0, len(names), WORDS_AT_ONCE):
        place = np.arange(a, min(a + WORDS_AT_ONCE, len(names)))
        place = place[place != mark]
        yield batch(len(place), n=counts[place], place=place, word=[names[k] for k in place])


def _chunks(docs: DataFrame) -> DataFrame:
    """Chunks of texts of one task and language, as numbers of words, -1 at the end of a piece, with their words.

    A chunk has rows of two kinds, none of which is large: ``said`` is the ``part``-th part of the
    numbers and holds ``n`` words; ``word`` has the number ``place`` and occurs ``n`` times.
    """

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: dict[str, _Numbers] = defaultdict(_Numbers)
        said: dict[str, list[np.ndarray]] = defaultdict(list)
        held, chunk = 0, TaskContext.get().partitionId() << 33

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal chunk
            for lang in list(said):
                # the mark has a number like a word
                names = numbers.pop(lang)
                yield from _chunk_rows(chunk, lang, np.concatenate(said.pop(lang)), list(names), names[_MARK])
                chunk += 1

        for part in parts:
            for at in range(0, part.num_rows, ROWS_AT_ONCE):
                rows = part.slice(at, ROWS_AT_ONCE)
                for lang, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                    words = words_of(text)
                    words.append(_MARK)
                    said[lang].append(np.fromiter(map(numbers[lang].__getitem__, words), "<i4", len(words)))
                    held += len(words)
                    if held >= CHUNK_WORDS:
                        yield from flush()
                        held = 0
        yield from flush()

    lang = F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN))
    rows = docs.select(lang, F.col("text").cast("string").cast("binary"))
    return materialize(rows.mapInArrow(batches, _CHUNK), "chunks")


def _frequent_words(entries: DataFrame) -> DataFrame:
    """``lang, word, n, code``: words that occur often enough, under even codes, odd for hot words.

    The codes have no gaps, so that four bytes hold them as long as there are under a billion: a
    word's place in its partition of the written table, behind the words of the partitions before
    (one broadcast row per partition).
    """
    often = entries.groupBy("lang", "word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST)
    often = materialize(often.withColumn("id", F.monotonically_increasing_id()), "words")
    part = F.shiftright("id", 33).alias("part")
    before, starts = 0, []
    for row in often.groupBy(part).count().orderBy("part").collect():
        starts.append((row["part"], before))
        before += row["count"]
    starts = often.sparkSession.createDataFrame(starts, "part long, start long")
    number = F.col("start") + F.col("id").bitwiseAND((1 << 33) - 1)
    placed = often.withColumn("part", part).join(F.broadcast(starts), "part")
    code = 2 * number + (F.col("n") >= HOT).cast("long")
    return materialize(placed.select("lang", "word", "n", code.alias("code")), "codes")


def _mix(key: np.ndarray, word: np.ndarray) -> np.ndarray:
    key = (key ^ word.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    return key ^ (key >> np.uint64(32))


def _hot(words: np.ndarray) -> np.ndarray:
    return (words >= 0) & (words & 1 == 1)


def suffixes(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct suffixes of at least two coded words (columns of ``LONGEST``, -1 past the end) and their counts.

    ``codes`` has -1 for what no phrase can hold; a suffix ends before it.
    """
    padded = np.append(codes, np.full(LONGEST, -1, codes.dtype))
    at = np.flatnonzero((padded[:-1] >= 0) & (padded[1:] >= 0))
    columns = [padded[at], padded[at + 1]]
    for k in range(2, LONGEST):
        columns.append(np.where(columns[-1] >= 0, padded[at + k], -1))
    order = np.lexsort(columns[::-1])
    found = np.array([c[order] for c in columns])
    first = np.flatnonzero(np.append(True, (found[:, 1:] != found[:, :-1]).any(axis=0))) if len(at) else np.empty(0, int)
    return found[:, first], np.diff(np.append(first, len(at)))


def routes(found: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each suffix: a hash of its words up to and with the first that is not hot.

    All suffixes that share those words meet there, and no more than the occurrences of that word.
    """
    key = _mix(np.zeros(found.shape[1], np.uint64), found[0])
    on = _hot(found[0])
    for words in found[1:]:
        key = np.where(on, _mix(key, words), key)
        on &= _hot(words)
    return (key % np.uint64(buckets)).astype(np.int64)


def _route(kind: str, buckets: int):
    at_once = max(1, ROW_BYTES // (LONGEST * np.dtype(kind).itemsize + 4))

    def route(chunks: pa.Table, words: pa.Table) -> pa.Table:
        pieces = chunks.column("said").to_pylist()
        if len(pieces) > 1:
            pieces = [pieces[k] for k in np.argsort(chunks.column("part").to_numpy())]
        said, place = np.frombuffer(b"".join(pieces), "<i4"), words.column("place").to_numpy()
        del pieces
        code = np.full(max(said.max(initial=-1), place.max(initial=-1)) + 2, -1, kind)  # the last one is the mark's
        code[place] = words.column("code").to_numpy()
        found, counts = suffixes(code[said])
        bucket = routes(found, buckets)
        order = np.argsort(bucket, kind="stable")
        found, counts, bucket = found[:, order].astype(kind), counts[order].astype("<i4"), bucket[order]
        batches, rows, size = [], [], 0

        def close() -> None:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), _ROUTED_SCHEMA)]
            batches.append(pa.RecordBatch.from_arrays(columns, schema=_ROUTED_SCHEMA))
            rows.clear()

        first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else []
        for a, end in zip(first, [*first[1:], len(bucket)]):
            for b in range(a, end, at_once):
                own = slice(b, min(b + at_once, end))
                rows.append((int(bucket[a]), found[:, own].tobytes(), counts[own].tobytes()))
                size += len(rows[-1][1]) + len(rows[-1][2])
                if size >= BATCH_BYTES:
                    close()
                    size = 0
        if rows:
            close()
        return pa.Table.from_batches(batches, _ROUTED_SCHEMA)

    return route


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, first, dtype=np.int64) if len(first) else np.empty(0, np.int64)


def _starts(part: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.empty(0, np.int64)


def sort_suffixes(
    words: np.ndarray, counts: np.ndarray, at_once: int = SORTED_AT_ONCE
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Phrases (columns of ``LONGEST`` words, -1 past the end) with their counts in one bucket.

    Suffixes with the same first word are sorted together, about ``at_once`` at a time, so that the
    sort needs little memory beside the bucket itself.
    """
    shares = np.uint64(max(1, math.ceil(words.shape[1] / at_once)))
    # the upper half of the mixed key, because all words of a bucket have the lower one in common
    share = (_mix(np.zeros(words.shape[1], np.uint64), words[0]) >> np.uint64(32)) % shares
    pointers = np.argsort(share.astype(np.uint16 if shares < 1 << 16 else np.int64), kind="stable")
    ends = np.cumsum(np.bincount(share.astype(np.int64), minlength=int(shares)))
    del share
    for a, b in zip([0, *ends[:-1]], ends):
        yield from _quicksort(words, counts, pointers[a:b])


def _quicksort(
    words: np.ndarray, counts: np.ndarray, pointer: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Phrases of the suffixes pointed to, with their counts.

    Multikey three-way quicksort of pointers to the suffixes. Every round parts all open partitions
    at once by a pivot for the word at their depth; equal partitions go one word deeper, and their
    sizes are the counts. Partitions under ``LEAST`` are given up. Where all leading words are hot,
    other buckets hold more of the phrase: its count here is a part of the sum and reported as such,
    and of a small partition only the suffixes go on whose next word is hot as well.
    """
    depths, part = len(words), np.zeros(len(pointer), np.int64)
    depth, hot = np.zeros(1, np.int64), np.ones(1, bool)  # of each partition; are all words so far hot
    while len(pointer):
        first = _starts(part)
        last = np.append(first[1:], len(part)) - 1
        depth, hot = depth[part[first]], hot[part[first]]
        part = np.repeat(np.arange(len(first)), last - first + 1)
        word = words[depth[part], pointer]
        pivot = np.sort([word[first], word[(first + last) // 2], word[last]], axis=0)[1]
        own = pivot[part]
        kept = []
        for side in (word < own, word > own):
            some = np.flatnonzero(side)
            p, s = pointer[some], part[some]
            begin = _starts(s)
            ids = s[begin]
            enough = _sums(counts[p], begin) >= LEAST
            index = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(s))))
            stay = enough[index] | (hot[ids] & (depth[ids] < depths - 1))[index] & _hot(word[some])
            kept.append((p[stay], index[stay], depth[ids], hot[ids]))
        some = np.flatnonzero((word == own) & (own >= 0))
        p, s = pointer[some], part[some]
        begin = _starts(s)
        ids = s[begin]
        total, deeper = _sums(counts[p], begin), depth[ids] + 1
        warm = hot[ids] & _hot(pivot[ids])
        enough = total >= LEAST
        shown = (deeper >= 2) & (enough | warm & (deeper < depths))
        if shown.any():
            phrase = words[:, p[begin[shown]]].copy()
            phrase[np.arange(depths)[:, None] >= deeper[shown]] = -1
            yield phrase, total[shown]
        index = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(s))))
        stay = ((deeper < depths) & (enough | warm))[index]
        at = np.minimum(deeper, depths - 1)[index]
        stay &= words[at, p] >= 0
        kept.append((p[stay], index[stay], deeper, warm))
        # every partition keeps its pointers together
        pointer = np.concatenate([k[0] for k in kept])
        offset = np.cumsum([0, *(len(k[2]) for k in kept)])
        part = np.concatenate([k[1] + o for k, o in zip(kept, offset)])
        depth, hot = np.concatenate([k[2] for k in kept]), np.concatenate([k[3] for k in kept])


def _count(kind: str):
    schema = pa.schema([*((name, pa.int64()) for name in _CODES), ("a", pa.int64())])

    def count(key: tuple[pa.Scalar, ...], rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts = [np.empty((LONGEST, 0), kind)], [np.empty(0, "<i4")]
        for part in rows:
            words += [np.frombuffer(w, kind).reshape(LONGEST, -1) for w in part.column("words").to_pylist()]
            counts += [np.frombuffer(c, "<i4") for c in part.column("counts").to_pylist()]
        counts = np.concatenate(counts)
        words = np.concatenate(words, axis=1)
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def made() -> pa.RecordBatch:
            columns = [*np.concatenate([p for p, _ in held], axis=1), np.concatenate([a for _, a in held])]
            return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], schema=schema)

        for found in sort_suffixes(words, counts, SORTED_AT_ONCE):
            held.append(found)
            if sum(len(a) for _, a in held) >= PHRASES_AT_ONCE:
                yield made()
                held.clear()
        if held:
            yield made()

    return count


def frequent(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Frequent phrases ``p, a`` (coded words), the words behind the codes, and ``lang, n``."""
    bounded_batches(docs.sparkSession)
    chunks = _chunks(docs)
    said, entries = chunks.where("part is not null"), chunks.where("place is not null")
    sizes = said.groupBy("lang").agg(F.sum("n").alias("n")).where("n > 0")
    words = _frequent_words(entries.select("lang", "word", "n"))
    row = words.agg(F.max("code")).first()
    kind = "<i4" if (row[0] or 0) < 1 << 31 else "<i8"
    total = sizes.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, math.ceil(total / BUCKET_SUFFIXES))
    known = entries.join(words.select("lang", "word", "code"), ["lang", "word"]).select(
        F.col("chunk").alias("own"), "place", "code"
    )
    routed = said.select("chunk", "part", "said").groupBy("chunk").cogroup(known.groupBy("own")).applyInArrow(_route(kind, buckets), _ROUTED)
    found = routed.groupBy("bucket").applyInArrow(_count(kind), ", ".join(f"{c} long" for c in _CODES) + ", a long")
    summed = found.groupBy(*_CODES).agg(F.sum("a").alias("a")).where(F.col("a") >= LEAST)
    phrase = F.filter(F.array(*_CODES), lambda w: w >= 0)
    return materialize(summed.select(phrase.alias("p"), "a"), "phrases"), words, sizes


def _scored(phrases: DataFrame, words: DataFrame) -> DataFrame:
    """``p, a, l, r, score`` of the lowest-scoring cut of each phrase.

    A part of a phrase is at least as frequent, so the counts of all parts are at hand.
    """
    counts = phrases.unionByName(words.select(F.array("code").alias("p"), F.col("n").alias("a")))
    cuts = phrases.select("p", "a", F.explode(F.sequence(F.lit(1), F.size("p") - 1)).alias("k"))
    cuts = cuts.select("*", F.slice("p", 1, F.col("k")).alias("left"), F.expr("slice(p, k + 1, size(p) - k)").alias("right"))
    of = lambda side, n: counts.select(F.col("p").alias(side), F.col("a").alias(n))
    both = cuts.join(of("left", "l"), "left").join(of("right", "r"), "right")
    score = F.expr("2000000 * cast(a AS decimal(20, 0)) div (cast(l AS decimal(20, 0)) + r)").cast("long")
    lowest = both.groupBy("p", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    return lowest.select("p", "a", "cut.l", "cut.r", "cut.score")


def _uncovered(scored: DataFrame, phrases: DataFrame) -> DataFrame:
    """Phrases that no longer phrase stands for."""
    inner = F.expr(
        "flatten(transform(sequence(2, size(p) - 1), m -> transform(sequence(1, size(p) - m + 1), s -> slice(p, s, m))))"
    )
    longer = phrases.where(F.size("p") > 2).select(F.explode(inner).alias("p"), F.col("a").alias("longer"))
    most = longer.groupBy("p").agg(F.max("longer").alias("longer"))
    kept = scored.join(most, "p", "left").where(F.expr(f"longer IS NULL OR 100 * longer < {COVERED} * a"))
    return kept.drop("longer")


def phrases(docs: DataFrame, best: int = BEST) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``best`` phrases of each language.

    ``docs(text, lang)``; a null ``lang`` is ``und``, a null text holds no word, a repeated row counts
    again. A phrase has 2 to ``LONGEST`` words of one piece of a text and occurs ``LEAST`` times or
    more (``a``); ``l`` and ``r`` are the counts of its parts at the cut with the lowest score. Phrases
    ``COVERED`` percent of which lie inside one longer phrase are left out. Ranks go by score, count
    and phrase (byte order), so no two are equal. Other columns are not read; an empty table gives an
    empty result.

    Tasks number the words of chunks of text; the counts of words are summed, and words under
    ``LEAST`` end a suffix. Equal suffixes of a chunk are counted once before the shuffle. Suffixes are
    routed by their leading words up to the first that is not hot, so a common word or pair of words
    is spread over all buckets, and each bucket is sorted in a task.
    """
    found, words, sizes = frequent(docs)
    kept = _uncovered(_scored(found, words), found)
    lead = words.select(F.col("code").alias("lead"), "lang")
    told = kept.withColumn("lead", F.col("p")[0]).join(lead, "lead").drop("lead")
    order = [F.desc("score"), F.desc("a")]
    # equal scores and counts are told apart by the words, which only these need
    near = told.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("place") <= best)
    spelt = (
        near.select("*", F.posexplode("p").alias("at", "code"))
        .join(words.select("code", F.col("word").cast("string").alias("word")), "code")
        .groupBy("lang", "p", "a", "l", "r", "score")
        .agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("spelt"))
        .withColumn("phrase", F.array_join("spelt.word", " "))
    )
    ranked = spelt.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase")))
    ranked = ranked.where(F.col("rank") <= best).join(sizes, "lang")
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
