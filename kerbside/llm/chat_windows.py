"""Chat formatting: conversations as windows of whole turns within a token budget.

A window holds the conversation's system turn, a limited stretch of the turns
before it as history, and new turns as far as the budget goes. Each turn is new
in exactly one window. The loss mask covers the texts of new assistant turns
only: a target that is repeated as history is masked out.

Turns are cut where prefix sums of their tokens say so. A conversation may be of
any length: its rows are sorted over all tasks, each task sums up what it has,
and one row per task carries the sums over to the next. Windows start afresh at
every ``BLOCK_WINDOWS`` budgets of tokens, so a task sees one such block at a
time, with the turns before it that may be its history, and its system turn.

Formatted text can be read back. Marks stand around turns; a text that holds
one of them itself gets a backslash after the mark's first character, in
addition to those that stand there already.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import BATCH_ROWS, materialize

# Most tokens of a window, and of the history within it.
BUDGET = 2048
HISTORY = 512
BLOCK_WINDOWS = 32

# Marks before and after the text of a turn, by role. A role of another name is
# spelled out between the first two of OTHER.
MARKS = {
    "system": ("<<SYS>>\n", "\n<</SYS>>\n"),
    "user": ("[INST] ", " [/INST]\n"),
    "assistant": ("<s> ", " </s>\n"),
}
OTHER = ("[ROLE] ", " [/ROLE]\n", " [END]\n")

_REST = r"(/?s>|/?INST\]|/?ROLE\]|END\]|<SYS>>|</SYS>>)"
_PLAIN = re.compile(r"([<\[])(\\*)" + _REST)
_ESCAPED = re.compile(r"([<\[])\\(\\*)" + _REST)


# --- template ----------------------------------------------------------------


def escape(text: str) -> str:
    """The text without control strings; each may hold more backslashes than before by one."""
    return _PLAIN.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def format_turn(role: str | None, text: str | None) -> tuple[str, int, int]:
    """A turn with its marks, and where its escaped text starts and ends; null is empty."""
    body = escape(text or "")
    if role in MARKS:
        before, after = MARKS[role]
    else:
        before, after = f"{OTHER[0]}{escape(role or '')}{OTHER[1]}", OTHER[2]
    return before + body + after, len(before), len(before) + len(body)


def parse_turns(text: str) -> list[tuple[str, str]]:
    """Role and text of each turn of a formatted text."""
    turns, at = [], 0
    while at < len(text):
        for role, (before, after) in MARKS.items():
            if text.startswith(before, at):
                at += len(before)
                break
        else:
            if not text.startswith(OTHER[0], at):
                raise ValueError(f"no turn at character {at}")
            start = at + len(OTHER[0])
            end = text.index(OTHER[1], start)
            role, after, at = unescape(text[start:end]), OTHER[2], end + len(OTHER[1])
        end = text.index(after, at)
        turns.append((role, unescape(text[at:end])))
        at = end + len(after)
    return turns


# --- turns -------------------------------------------------------------------


@lru_cache(maxsize=1)
def _model(path: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=path)


_TURN = "piece string, start int, end int, tokens long, system boolean, target boolean"
_TURN_NAMES = ["piece", "start", "end", "tokens", "system", "target"]
_SUMMED = "part int, at long, before long"


def _formatted(model: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roles, texts = (batch.column(i).to_pylist() for i in (2, 3))
            made = [format_turn(r, t) for r, t in zip(roles, texts, strict=True)]
            pieces = [m[0] for m in made]
            tokens = [len(ids) for ids in _model(model).encode(pieces, num_threads=1)]
            columns = [
                pa.array(pieces, pa.string()),
                pa.array([m[1] for m in made], pa.int32()),
                pa.array([m[2] for m in made], pa.int32()),
                pa.array(tokens, pa.int64()),
                pa.array([r == "system" for r in roles], pa.bool_()),
                pa.array([r == "assistant" for r in roles], pa.bool_()),
            ]
            both = [*batch.columns[:2], *columns]
            yield pa.RecordBatch.from_arrays(both, ["conv_id", "turn", *_TURN_NAMES])

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Place and tokens before each turn, within what this task has of its conversation."""
    part = TaskContext.get().partitionId()
    seen, last, n, total = False, None, 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column(0).to_pylist()
        tokens = batch.column(batch.schema.get_field_index("tokens")).to_numpy()
        new = np.array([not seen or ids[0] != last, *[a != b for a, b in zip(ids, ids[1:])]])
        first = np.maximum.accumulate(np.where(new, np.arange(len(ids)), -1))
        sums = np.append(0, np.cumsum(tokens))
        began = np.maximum(first, 0)
        goes_on = first < 0
        at = np.arange(len(ids)) - began + np.where(goes_on, n, 0)
        before = sums[:-1] - sums[began] + np.where(goes_on, total, 0)
        seen, last, n, total = True, ids[-1], int(at[-1]) + 1, int(before[-1] + tokens[-1])
        columns = [pa.array(np.full(len(ids), part, np.int32)), pa.array(at), pa.array(before)]
        names = [*batch.schema.names, "part", "at", "before"]
        yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names)


def ordered_turns(conversations: DataFrame, *, model: str) -> DataFrame:
    """Formatted turns with ``at``, their place in the conversation, and the tokens ``before`` them.

    Order: ``turn``, null first; then a hash of role and text. Equal rows are
    turns of their own. Rows without ``conv_id`` are one conversation.
    """
    spark = conversations.sparkSession
    kinds = [f"{c} {conversations.schema[c].dataType.simpleString()}" for c in ("conv_id", "turn")]
    schema = ", ".join([*kinds, _TURN])
    turns = conversations.select("conv_id", "turn", "role", "text").mapInArrow(_formatted(model), schema)
    # Written first: a sort runs what is before it twice, once for the ranges.
    turns = materialize(turns, "chat-pieces")
    # The last key lets equal rows of one turn be dealt to several tasks.
    turns = turns.orderBy("conv_id", "turn", F.xxhash64("piece"), F.monotonically_increasing_id())
    turns = materialize(turns.mapInArrow(_summed, f"{schema}, {_SUMMED}"), "chat-turns")
    end = F.struct("at", F.col("before") + F.col("tokens"), "conv_id")
    start = F.min(F.struct(F.col("conv_id").isNotNull(), "conv_id")).alias("start")
    stop = F.max(F.struct(F.col("conv_id").isNotNull(), "conv_id", end)).alias("stop")
    offsets, held, n, total = [], None, 0, 0
    for part, (_, first), (_, last, (at, tokens, _)) in sorted(
        map(tuple, turns.groupBy("part").agg(start, stop).collect()), key=lambda row: row[0]
    ):
        if not offsets or first != held:
            n, total = 0, 0
        offsets.append((part, first, n, total))
        if first != last:
            n, total = 0, 0
        held, n, total = last, n + at + 1, total + tokens
    carried = spark.createDataFrame(offsets, f"part int, first {kinds[0].split()[1]}, n long, total long")
    goes_on = F.col("conv_id").eqNullSafe(F.col("first"))
    rows = turns.join(carried, "part")
    rows = rows.withColumn("at", F.col("at") + F.when(goes_on, F.col("n")).otherwise(0))
    rows = rows.withColumn("before", F.col("before") + F.when(goes_on, F.col("total")).otherwise(0))
    return rows.drop("part", "first", "n", "total")


# --- windows -----------------------------------------------------------------


def choose_spans(
    tokens: np.ndarray, first: int, system: int, budget: int, history: int
) -> list[tuple[int, int, int]]:
    """Windows as (first turn of history, first new turn, end) over ``tokens``.

    Turns before ``first`` can only be history; ``system`` tokens are part of every
    window. A window takes at least one new turn, even if that is over the budget.
    """
    sums = np.append(0, np.cumsum(tokens))
    spans, at = [], first
    while at < len(tokens):
        room = min(history, budget - system - int(tokens[at]))
        back = int(np.searchsorted(sums[: at + 1], sums[at] - room, "left")) if room > 0 else at
        end = int(np.searchsorted(sums, sums[back] + budget - system, "right")) - 1
        end = max(end, at + 1)
        spans.append((back, at, end))
        at = end
    return spans


_WINDOW = [
    ("first_turn", pa.int64()), ("n_new", pa.int32()), ("n_history", pa.int32()), ("has_system", pa.bool_()),
    ("tokens", pa.int64()), ("text", pa.string()),
    ("loss", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
]
_WINDOW_SCHEMA = (
    "first_turn long, n_new int, n_history int, has_system boolean, tokens long, text string, "
    "loss array<struct<start:int, end:int>>"
)


def _windows_of(turns: list[dict], budget: int, history: int) -> Iterator[tuple]:
    """Windows of one block; its system turn comes first, then history, then the block's own."""
    lead = next((t for t in turns if t["at"] == 0 and t["system"]), None)
    rest = turns if lead is None or lead["own"] else [t for t in turns if t is not lead]
    carried = 0 if lead is None else lead["tokens"]
    tokens = np.array([t["tokens"] for t in rest], np.int64)
    first = next((i for i, t in enumerate(rest) if t["own"]), len(rest))
    begins = lead is not None and lead["own"]  # the system turn is itself new in this block
    if begins:
        tokens[0] = 0  # counted as the system turn already
    for back, at, end in choose_spans(tokens, first, carried, budget, history):
        if begins and at:
            back = max(back, 1)
        shown = rest[back:end] if lead is None or (begins and at == 0) else [lead, *rest[back:end]]
        size, loss, parts = 0, [], []
        for t in shown:
            if t["target"] and t["at"] >= rest[at]["at"]:
                loss.append({"start": size + t["start"], "end": size + t["end"]})
            parts.append(t["piece"])
            size += len(t["piece"])
        used = sum(t["tokens"] for t in shown)
        yield rest[at]["at"], end - at, at - back, lead is not None, used, "".join(parts), loss


def _to_windows(id_type: pa.DataType, budget: int, history: int):
    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [("conv_id", id_type), *_WINDOW]
        columns = [pa.array(c, k) for c, (_, k) in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, [n for n, _ in kinds])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, turns, out = None, [], []
        for batch in batches:
            for row in batch.to_pylist():
                if turns and (row["conv_id"], row["block"]) != key:
                    out += [(key[0], *w) for w in _windows_of(turns, budget, history)]
                    turns = []
                key = row["conv_id"], row["block"]
                turns.append(row)
                if len(out) >= BATCH_ROWS:
                    yield batch_of(out)
                    out = []
        if turns:
            out += [(key[0], *w) for w in _windows_of(turns, budget, history)]
        if out:
            yield batch_of(out)

    return run


def chat_windows(
    conversations: DataFrame, *, model: str, budget: int = BUDGET, history: int = HISTORY
) -> DataFrame:
    """Windows of all conversations (``conv_id, turn, role, text``), written and read again.

    Columns: ``conv_id``, ``first_turn`` (place of the first new turn), ``n_new``,
    ``n_history``, ``has_system``, ``tokens``, ``text`` and ``loss``, the spans of
    characters that are trained on. The system turn is a conversation's first one,
    if that has this role; it counts as new in the first window. Tokens are those
    of each formatted turn encoded by itself with the SentencePiece file ``model``.
    A turn longer than the budget makes a window of its own. Null text and role
    are empty; other columns are ignored.
    """
    turns = ordered_turns(conversations, model=model)
    id_type = turns.schema["conv_id"].dataType.simpleString()
    length = budget * BLOCK_WINDOWS
    block = F.floor(F.col("before") / length)
    turns = turns.withColumn("block", block.cast("long")).drop("turn")
    lead = (F.col("at") == 0) & F.col("system")
    near = (F.col("before") >= (F.col("block") + 1) * length - history) & ~lead
    own = F.struct(F.col("block"), F.lit(True).alias("own"))
    next_one = F.struct((F.col("block") + 1).alias("block"), F.lit(False).alias("own"))
    rows = turns.withColumn("to", F.explode(F.array_compact(F.array(own, F.when(near, next_one)))))
    rows = rows.withColumns({"block": F.col("to.block"), "own": F.col("to.own")}).drop("to")
    later = turns.where(F.col("block") > 0).groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("n"))
    later = materialize(later, "chat-blocks").select(F.col("conv_id").alias("id"), F.col("block").alias("to"))
    leads = turns.where(lead).join(later, F.col("conv_id").eqNullSafe(F.col("id")))
    leads = leads.withColumns({"block": F.col("to"), "own": F.lit(False)}).drop("id", "to")
    rows = rows.unionByName(leads)
    rows = rows.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "at")
    arrow_id = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[id_type]
    made = rows.mapInArrow(_to_windows(arrow_id, budget, history), f"conv_id {id_type}, {_WINDOW_SCHEMA}")
    return materialize(made, "chat-windows")


# --- reading back ------------------------------------------------------------


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_windows"]
    key, state = None, None

    def row() -> pa.RecordBatch:
        n, turns, chars, loss, size, windows = state
        values = [key[0], n, turns.hexdigest(), chars, loss.hexdigest(), size, windows]
        kinds = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)

    for batch in batches:
        id_type = batch.schema.field("conv_id").type
        for w in batch.to_pylist():
            if key != (w["conv_id"],):
                if state is not None:
                    yield row()
                key, state = (w["conv_id"],), [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
            for role, text in parse_turns(w["text"])[-w["n_new"] :]:
                state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            for span in w["loss"]:
                target = unescape(w["text"][span["start"] : span["end"]])
                state[2] += len(target)
                state[3].update(target.encode("utf-8", "surrogatepass"))
            state[0], state[4], state[5] = state[0] + w["n_new"], state[4] + len(w["text"]), state[5] + 1
    if state is not None:
        yield row()


def conversation_digests(windows: DataFrame) -> DataFrame:
    """What the windows hold of each conversation, read back from their texts and masks.

    ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars,
    n_windows``. A digest over all turns of a conversation is one stream of bytes,
    so a task reads its windows one after another; it holds no more than a batch.
    """
    id_type = windows.schema["conv_id"].dataType.simpleString()
    schema = (
        f"conv_id {id_type}, n_turns long, turns_sha256 string, loss_chars long, "
        "loss_sha256 string, formatted_chars long, n_windows long"
    )
    rows = windows.select("conv_id", "first_turn", "n_new", "text", "loss")
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "first_turn").mapInArrow(_digests, schema)
