"""Chat formatting in budgeted windows of whole turns, with a loss mask and an exact way back."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlake.llm.packing import TOKENIZER, word_encoder
from cohortlake.llm.texts import annotate
from cohortlake.session import materialize

#: Tokens of a window, new tokens per window, and tokens of earlier turns that a window may repeat.
BUDGET, STEP, HISTORY = 2048, 1024, 512
#: Tokens that the marks of a turn take.
MARKS = 4
#: Turns whose prefix sums are made together.
CHUNK_TURNS = 64
TARGET, SYSTEM = "assistant", "system"

#: Strings that stand for marks in this or other templates and are escaped in texts and roles.
CONTROL = ("<|", "|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_TURN = re.compile(r"<\|(.*?)\|>\n(.*?)</s>\n", re.DOTALL)

_WINDOW_FIELDS = (
    "conv_id long, window long, text string, fresh_from long, loss array<struct<start: long, stop: long>>, tokens long"
)
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
_WINDOW_TYPES = (pa.int64(), pa.int64(), pa.string(), pa.int64(), _SPAN, pa.int64())


def escape(text: str) -> str:
    """A backslash before each backslash and inside each control string."""
    text = text.replace("\\", "\\\\")
    for mark in CONTROL:
        text = text.replace(mark, f"{mark[0]}\\{mark[1:]}")
    return text


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """A marked turn, and where its text starts and stops in it."""
    head, body = f"<|{escape(role)}|>\n", escape(text)
    return f"{head}{body}</s>\n", len(head), len(head) + len(body)


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of formatted turns."""
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(formatted)]


def _runs(parts: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Rows of sorted batches, one iterator for each run of equal leading ``keys`` columns."""
    rows = (row for part in parts for at in range(0, part.num_rows, 256) for row in _rows(part.slice(at, 256)))
    row = next(rows, None)

    def run(key: tuple) -> Iterator[tuple]:
        nonlocal row
        while row is not None and row[:keys] == key:
            yield row
            row = next(rows, None)

    while row is not None:
        key = row[:keys]
        mine = run(key)
        yield key, mine
        for _ in mine:
            pass


def _rows(part: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(c.to_pylist() for c in part.columns))


def _placed(conversations: DataFrame, tokenizer_path: str) -> DataFrame:
    """Each turn with its tokens before it, once for every window that shows it."""

    def count(texts: list[str | None]) -> list[dict]:
        ids = word_encoder(tokenizer_path)(texts)
        return [{"tokens": len(i) - 1 + MARKS} for i in ids]

    plain = conversations.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    counted = annotate(plain, plain.columns, "found", "tokens long", lambda: count)
    turns = counted.select(*plain.columns, "found.tokens", F.expr(f"turn div {CHUNK_TURNS}").alias("chunk"))

    # A long conversation is many chunks: only their sums are put in one order.
    sums = turns.groupBy("conv_id", "chunk").agg(F.sum("tokens").alias("tokens"))
    of_conversation = Window.partitionBy("conv_id").orderBy("chunk")
    earlier = F.sum("tokens").over(of_conversation.rowsBetween(Window.unboundedPreceding, -1))
    whole = Window.partitionBy("conv_id")
    starts = sums.select(
        F.col("conv_id").alias("of"),
        F.col("chunk").alias("of_chunk"),
        F.coalesce(earlier, F.lit(0)).alias("before"),
        F.sum("tokens").over(whole).alias("total"),
    )
    in_chunk = Window.partitionBy("conv_id", "chunk").orderBy("turn", "role", "text")
    running = F.sum("tokens").over(in_chunk.rowsBetween(Window.unboundedPreceding, 0))
    located = (
        turns.withColumn("upto", running)
        .join(starts, F.col("conv_id").eqNullSafe(F.col("of")) & F.col("chunk").eqNullSafe(F.col("of_chunk")))
        .withColumn("stop", F.col("before") + F.col("upto"))
        .withColumn("start", F.col("stop") - F.col("tokens"))
    )
    own = F.expr(f"(stop - 1) div {STEP}")
    last = F.expr(f"(total - 1) div {STEP}")
    reach = F.expr(f"(start + {HISTORY}) div {STEP}")
    first_system = (F.col("start") == 0) & (F.col("role") == SYSTEM)
    until = F.when(first_system, last).otherwise(F.least(reach, last))
    windows = F.sequence(own, F.greatest(own, until))
    return located.select("conv_id", F.explode(windows).alias("window"), "start", "role", "text", "tokens", own.alias("own"))


def _format(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows from turns sorted by conversation, window and place."""
    done: list[tuple] = []
    for (conv_id, window), rows in _runs(parts, 2):
        turns = list(rows)
        fresh = [t for t in turns if t[6] == window]
        if fresh:
            done.append(_window(conv_id, window, [t for t in turns if t[6] != window], fresh))
        if len(done) >= 64:
            yield _batch(done)
            done = []
    yield _batch(done)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(_WINDOW_TYPES)
    names = [f.split()[0] for f in _WINDOW_FIELDS.split(", ", 4)[:4]] + ["loss", "tokens"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _WINDOW_TYPES)], names)


def _window(conv_id, window: int, repeated: list[tuple], fresh: list[tuple]) -> tuple:
    """The system turn, as many of the latest repeated turns as the budget leaves, and the new ones."""
    system = [t for t in repeated if t[2] == 0 and t[3] == SYSTEM][:1]
    history = [t for t in repeated if t not in system]
    tokens = sum(t[5] for t in [*system, *fresh])
    kept: list[tuple] = []
    for turn in reversed(history):
        if tokens + turn[5] > BUDGET:
            break
        tokens += turn[5]
        kept.insert(0, turn)
    text = "".join(format_turn(t[3], t[4])[0] for t in [*system, *kept])
    fresh_from, pieces, place, loss = len(text), [text], len(text), []
    for turn in fresh:
        marked, start, stop = format_turn(turn[3], turn[4])
        if turn[3] == TARGET:
            loss.append({"start": place + start, "stop": place + stop})
        pieces.append(marked)
        place += len(marked)
    return conv_id, window, "".join(pieces), fresh_from, loss, tokens


def format_windows(conversations: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """Windows of all ``conversations(conv_id, turn, role, text)``, other columns unread.

    One row per window: ``conv_id``, ``window`` (rising), ``text``, ``fresh_from`` (code points of
    repeated turns, which carry no loss), ``loss`` (spans of code points) and ``tokens``. Prefix sums
    of the turns' tokens put every turn into one window as new: the one in whose ``STEP`` tokens it
    ends. A window repeats the conversation's opening system turn and up to ``HISTORY`` tokens of
    whole turns before it, the latest first, as far as ``BUDGET`` allows. Turns are never cut: a
    window goes over the budget only if its new turns and the system turn alone do.

    Rows are ordered by turn; ties by role and text, and repeated rows stay. A null text or role
    counts as empty, null ids are one conversation, null turns come first. An empty table gives no
    windows. A conversation of any length is dealt over tasks by chunks and windows.
    """
    placed = _placed(conversations, tokenizer_path or public_tokenizers.path(TOKENIZER))
    keys = ["conv_id", "window"]
    return placed.repartition(*keys).sortWithinPartitions(*keys, "start").mapInArrow(_format, _WINDOW_FIELDS)


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _digest(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = []
    for (conv_id,), windows in _runs(parts, 1):
        turns, loss = hashlib.sha256(), hashlib.sha256()
        n_turns = loss_chars = formatted_chars = 0
        for _, _, text, fresh_from, spans in windows:
            formatted_chars += len(text)
            for role, said in parse_turns(text[fresh_from:]):
                n_turns += 1
                turns.update(f"{role}\n{said}\n".encode())
            for span in spans:
                target = unescape(text[span["start"] : span["stop"]])
                loss_chars += len(target)
                loss.update(target.encode())
        rows.append((conv_id, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), formatted_chars))
    names = [f.split()[0] for f in DIGEST.split(", ")]
    kinds = [pa.string() if n.endswith("sha256") else pa.int64() for n in names]
    columns = list(zip(*rows)) or [()] * len(names)
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def read_back(windows: DataFrame) -> DataFrame:
    """What the windows say of each conversation: its turns and the text under the loss mask, as digests.

    A digest runs over a conversation in order, so its windows stream through one task, one at a time.
    """
    ordered = windows.select("conv_id", "window", "text", "fresh_from", "loss").repartition("conv_id")
    return ordered.sortWithinPartitions("conv_id", "window").mapInArrow(_digest, DIGEST)


def conversation_digests(conversations: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """``read_back`` of the written windows of ``format_windows``."""
    return read_back(materialize(format_windows(conversations, tokenizer_path), "windows"))
