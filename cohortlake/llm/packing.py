"""Bounded-space online packing of token sequences."""

from __future__ import annotations

import bisect
import os
import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cohortlake.llm.texts import per_worker
from cohortlake.session import materialize

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
WINDOW = 4096
OPEN_WINDOWS = 64
#: A text is cut at the end of a full window only if the part left there has as many ids.
LEAST_PIECE = 32
#: Tasks whose leftovers one group merges.
FAN_IN = 32
#: Words whose ids a Python worker remembers, in about 50 MB; it makes room for the first of them, then for
#: those that it holds. New words are tokenised so many together.
REMEMBERED = 1_000_000
_FIRST_WORDS = 1 << 14
_WORDS_AT_ONCE = 1 << 12

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_SCHEMA = f"{PIECE}, ids binary, part long"
_ARROW = pa.schema(
    [(name, pa.int64()) for name in PIECE.replace(" long", "").split(", ")]
    + [("ids", pa.binary()), ("part", pa.int64())]
)


class _WordTable:
    """Ids of words by a 64-bit hash of their bytes: open addressing in arrays that grow with the words held."""

    def __init__(self, size: int):
        self.size = size
        self.clear()

    def clear(self) -> None:
        self._make(_FIRST_WORDS)
        self.ids = np.empty(1 << 16, "<u4")
        self.held = self.used = 0

    def _make(self, words: int) -> None:
        self.bits = max(8, (2 * words).bit_length())  # at most half of the places are taken
        self.keys = np.zeros(1 << self.bits, np.uint64)  # 0: empty
        self.start = np.zeros(1 << self.bits, np.uint32)
        self.count = np.zeros(1 << self.bits, np.uint32)

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Where each hash is, or the empty place where its search ended."""
        place = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        left = np.flatnonzero((self.keys[place] != hashes) & (self.keys[place] != 0))
        while len(left):
            place[left] = (place[left] + 1) & (len(self.keys) - 1)
            found = self.keys[place[left]]
            left = left[(found != hashes[left]) & (found != 0)]
        return place

    def add(self, hashes: np.ndarray, ids: list[list[int]]) -> None:
        """Take in words that are not there."""
        counts = np.array([len(i) for i in ids], np.int64)
        flat = np.fromiter(chain.from_iterable(ids), "<u4", counts.sum())
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        self.ids[self.used : self.used + len(flat)] = flat
        if 2 * (self.held + len(hashes)) > len(self.keys):
            keys, start, count = self.keys, self.start, self.count
            self._make(self.held + len(hashes))
            for at in range(0, len(keys), _FIRST_WORDS):
                own = at + np.flatnonzero(keys[at : at + _FIRST_WORDS])
                self._put(keys[own], start[own], count[own])
        self._put(hashes, self.used + np.cumsum(counts) - counts, counts)
        self.held += len(hashes)
        self.used += len(flat)

    def _put(self, hashes: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> None:
        left = np.arange(len(hashes))
        while len(left):  # of hashes that meet at an empty place one stays, the others go on
            place = self.places(hashes[left])
            self.keys[place] = hashes[left]
            mine = self.keys[place] == hashes[left]
            self.start[place[mine]] = starts[left[mine]]
            self.count[place[mine]] = counts[left[mine]]
            left = left[~mine]


#: Words of more bytes are hashed one by one, because sums of weighted letters can be equal for long ones.
_SHORT = 64
#: Bytes of text whose words are looked up together.
_TEXT_AT_ONCE = 1 << 18
_random = np.random.default_rng(97)
_LETTER = _random.integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)
_LETTER[[9, 10, 11, 12, 13, 32]] = 0
_POWER = np.cumprod(np.full(1 << 12, 0x9E3779B97F4A7C15 | 5, np.uint64))
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _hashed_words(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, stops and hashes of the words between ASCII white space."""
    letters = _LETTER[np.frombuffer(data, np.uint8)]
    inside = np.concatenate([[False], letters != 0, [False]])
    starts, stops = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(inside[:-1] & ~inside[1:])
    if not len(starts):
        return starts, stops, np.empty(0, np.uint64)
    first = starts[0]
    place = np.arange(first, len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
    hashes = np.add.reduceat(letters[first:] * _POWER[place & (len(_POWER) - 1)], starts - first)
    hashes ^= (stops - starts).astype(np.uint64) * _MIX
    hashes = (hashes ^ (hashes >> np.uint64(32))) * _MIX
    hashes ^= hashes >> np.uint64(29)
    hashes *= _MIX
    for k in np.flatnonzero(stops - starts > _SHORT):
        hashes[k] = xxhash.xxh3_64_intdigest(data[starts[k] : stops[k]], 97)
    return starts, stops, np.maximum(hashes, np.uint64(1))


def word_encoder(path: str, end_id: int = END_ID) -> Callable[[list[str | None]], list[np.ndarray]]:
    """The encoder of whole texts, which a Python worker keeps from task to task."""
    return per_worker(("words", path, end_id), lambda: _word_encoder(path, end_id))


def _word_encoder(path: str, end_id: int) -> Callable[[list[str | None]], list[np.ndarray]]:
    """Encode whole texts. White space only separates and case is dropped, so words are tokenised alone.

    Words are cut at ASCII white space and only A-Z are lowered here; the tokenizer does the rest, once
    for each distinct word as long as it is remembered. Words are told apart by a 64-bit hash.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)
    table = _WordTable(REMEMBERED)
    end = np.array([end_id], "<u4")

    def together(texts: list[bytes]) -> list[np.ndarray]:
        data = b"\n".join(texts).lower()
        starts, stops, hashes = _hashed_words(data)
        place = table.places(hashes)
        absent = np.flatnonzero(table.keys[place] != hashes)
        new, at = np.unique(hashes[absent], return_index=True)
        if table.held + len(new) > table.size:  # too many: forget all but the words of these texts
            new, at = np.unique(hashes, return_index=True)
            table.size = max(table.size, len(new))
            table.clear()
            absent = np.arange(len(hashes))
        if len(new):
            at = absent[at]
            for k in range(0, len(new), _WORDS_AT_ONCE):
                some = at[k : k + _WORDS_AT_ONCE]
                words = [data[a:b].decode() for a, b in zip(starts[some], stops[some])]
                said = tokenizer.encode_batch_fast(words, add_special_tokens=False)
                table.add(new[k : k + _WORDS_AT_ONCE], [e.ids for e in said])
            place = table.places(hashes)
        counts = table.count[place].astype(np.int64)
        upto = np.concatenate([[0], np.cumsum(counts)])
        ids = table.ids[np.repeat(table.start[place] - upto[:-1], counts) + np.arange(upto[-1])]
        ends = np.cumsum([len(t) + 1 for t in texts])
        cuts = upto[np.searchsorted(starts, ends)]
        return [np.append(ids[a:b], end) for a, b in zip([0, *cuts], cuts)]

    def encode(texts: list[str | None]) -> list[np.ndarray]:
        plain = [(text or "").encode() for text in texts]
        found, first, size = [], 0, 0
        for k, text in enumerate(plain):
            size += len(text)
            if size >= _TEXT_AT_ONCE or k + 1 == len(plain):
                found += together(plain[first : k + 1])
                first, size = k + 1, 0
        return found

    return encode


class Packer:
    """A fixed number of open windows; pieces go to the one they fill best.

    A piece that fits in no open window fills up the fullest, which is emitted, if that takes at
    least ``LEAST_PIECE`` ids of it and leaves as many; else the fullest is emitted as it is.
    """

    def __init__(self, windows: int, first_sequence: int):
        self.windows, self.next = windows, first_sequence
        self.open: list[tuple[int, int, list]] = []  # free ids, order of opening, pieces; fullest first
        self.done: list[tuple] = []
        self.opened = 0

    def add(self, doc_id: int | None, start: int, ids: np.ndarray, doc_tokens: int) -> None:
        while len(ids):
            if len(ids) >= WINDOW:
                self._emit([(doc_id, start, ids[:WINDOW], doc_tokens)])
                ids, start = ids[WINDOW:], start + WINDOW
                continue
            at = bisect.bisect_left(self.open, (len(ids),))
            if at < len(self.open):
                free, order, pieces = self.open.pop(at)
            elif len(self.open) < self.windows:
                self.opened += 1
                free, order, pieces = WINDOW, self.opened, []
            else:
                free, _, pieces = self.open.pop(0)
                if free >= LEAST_PIECE and len(ids) - free >= LEAST_PIECE or self.windows == 1:
                    pieces.append((doc_id, start, ids[:free], doc_tokens))
                    ids, start = ids[free:], start + free
                self._emit(pieces)
                continue
            pieces.append((doc_id, start, ids, doc_tokens))
            if free == len(ids):
                self._emit(pieces)
            else:
                bisect.insort(self.open, (free - len(ids), order, pieces))
            return

    def _emit(self, pieces: list) -> None:
        offset = 0
        for doc_id, start, ids, doc_tokens in pieces:
            crc = zlib.crc32(ids.tobytes())
            self.done.append((doc_id, start, len(ids), crc, doc_tokens, self.next, offset, None, None))
            offset += len(ids)
        self.next += 1

    def flush(self) -> None:
        for _, _, pieces in self.open:
            self._emit(pieces)
        self.open = []

    def leftovers(self, part: int) -> None:
        """Hand the pieces of open windows on, with their ids."""
        for _, _, pieces in self.open:
            for doc_id, start, ids, doc_tokens in pieces:
                self.done.append((doc_id, start, len(ids), None, doc_tokens, None, None, ids.tobytes(), part))
        self.open = []

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.done)) or [()] * len(_ARROW)
        self.done = []
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)


def _first_sequence(step: int) -> int:
    """Sequence numbers of one task: 5 bits of the round, 26 of the task, 32 of the count."""
    return step << 58 | TaskContext.get().partitionId() << 32


def _pack_texts(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    def pack(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_encoder(tokenizer_path)
        packer = Packer(OPEN_WINDOWS, _first_sequence(0))
        for part in parts:
            for at in range(0, part.num_rows, 256):
                ids, texts = (c.to_pylist() for c in part.slice(at, 256).columns)
                for doc_id, tokens in zip(ids, encode(texts)):
                    packer.add(doc_id, 0, tokens, len(tokens))
                yield packer.take()
        packer.leftovers(TaskContext.get().partitionId())
        yield packer.take()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(pack, _SCHEMA)


def _merge(left: DataFrame, step: int, last: bool) -> DataFrame:
    """Pack the leftovers of ``FAN_IN`` parts together, long pieces first."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, group = None, None
        first = _first_sequence(step)
        for batch in batches:
            for row in batch.to_pylist():
                if packer is None or row["part"] != group:
                    if packer:
                        packer.leftovers(group)
                        first = packer.next
                        yield packer.take()
                    group, packer = row["part"], Packer(1 if last else OPEN_WINDOWS, first)
                ids = np.frombuffer(row["ids"], "<u4")
                packer.add(row["doc_id"], row["start"], ids, row["doc_tokens"])
            if packer:
                yield packer.take()
        if packer:
            packer.flush() if last else packer.leftovers(group)
            yield packer.take()

    grouped = left.withColumn("part", F.expr(f"part div {FAN_IN}"))
    order = ["part", F.desc("length"), "doc_id", "start", F.xxhash64("ids")]
    spread = grouped.coalesce(1) if last else grouped.repartition("part")
    return spread.sortWithinPartitions(*order).mapInArrow(pack, _SCHEMA)


def pack(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """Pieces of packed sequences of at most ``WINDOW`` ids for all rows of ``docs``.

    One row per piece: ``doc_id``, ``start`` (the document's ids before it), ``length``,
    ``ids_crc32``, ``doc_tokens``, ``sequence_id`` and ``offset`` in that sequence. A document is the
    ids of its whole text and an end id; a null or empty text is the end id alone. Ids lie in exactly
    one piece. Repeated rows and rows with a null ``doc_id`` are packed like any others. Columns
    other than ``doc_id`` and ``text`` are not read; an empty table gives no pieces.

    Each task keeps ``OPEN_WINDOWS`` open and passes its text once, so its memory is bounded. What is
    left open is merged in rounds of ``FAN_IN`` tasks each, so the last round has at most
    ``FAN_IN * OPEN_WINDOWS`` windows, whatever the input. Every round is written to the shared
    folder: sequence numbers do not change when an executor is lost.
    """
    pieces = materialize(_pack_texts(docs, tokenizer_path or public_tokenizers.path(TOKENIZER)), "pieces")
    closed, step = [pieces.where("part is null")], 0
    left = pieces.where("part is not null")
    parts = left.agg(F.max("part")).first()[0]
    while parts is not None:
        step, last = step + 1, parts < FAN_IN
        merged = materialize(_merge(left, step, last), "merged")
        closed.append(merged.where("part is null"))
        left, parts = merged.where("part is not null"), None if last else parts // FAN_IN
    result = closed[0]
    for more in closed[1:]:
        result = result.unionByName(more)
    return result.select(*(c.split()[0] for c in PIECE.split(", ")))
