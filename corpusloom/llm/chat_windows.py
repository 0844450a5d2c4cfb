"""Chat formatting in budgeted windows (operator 6).

A conversation becomes one or more windows of at most ``budget`` tokens, cut
between turns where the prefix sum of turn tokens would pass the budget.  A
window opens with the conversation's system turn, if its first turn is one and
fits beside the next turn, and repeats up to ``history`` turns before it as far
as half the budget allows; the loss mask covers the texts of new assistant
turns only, so each is learnt once.  Only a turn that alone exceeds the budget
makes a window that does; that turn has it for itself, whole.

A window reads ``<s>`` and for each turn ``[INST]role[/INST]text</s>``.  Control
strings inside roles and texts get a backslash after their first character, and
those that have backslashes there one more, so unescaping is exact.  Tokens are
counted turn by turn as written, marks included, by the function given.

Rows of a conversation are ordered by turn, then role and text, and repeated
rows are turns of their own; null roles and texts are empty, a null turn comes
last, and a null conv_id is a conversation too.  An empty table has no windows,
and other columns than the four named are not read.  Rows stream through a
sorted partition: memory holds one window, however long the conversation.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUDGET = 1024
HISTORY = 2
BOS, HEAD, TAIL, EOS = "<s>", "[INST]", "[/INST]", "</s>"
_CONTROL = re.compile(r"([<\[])(\\*)(?=/?s>|/?INST\])")
_ESCAPED = re.compile(r"([<\[])\\(\\*)(?=/?s>|/?INST\])")
_TURN = re.compile(re.escape(HEAD) + r"(.*?)" + re.escape(TAIL) + r"(.*?)" + re.escape(EOS), re.S)

WINDOWS = "conv_id long, window long, formatted string, n_repeated int, loss array<struct<start:int,end:int>>, n_tokens long"


def escape(text: str) -> str:
    return _CONTROL.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def escaped(text: Column) -> Column:
    """escape() as a column."""
    return F.regexp_replace(text, _CONTROL.pattern, r"$1\\$2")


class Turn(NamedTuple):
    role: str
    written: str
    body: int  # where the text begins in what is written
    tokens: int


def window_rows(turns: Iterator[Turn], budget: int, history: int, opening: int) -> Iterator[tuple[str, int, list[dict], int]]:
    """(formatted, repeated turns, loss spans in code points, tokens) of one conversation's turns; ``opening`` are the tokens of the mark that opens a window."""
    system = None
    past: deque = deque(maxlen=history)
    repeated: list = []
    new: list = []
    used = opening

    def emit():
        at, loss = len(BOS), []
        for k, t in enumerate([*repeated, *new]):
            if k >= len(repeated) and t.role == "assistant":
                loss.append({"start": at + t.body, "end": at + len(t.written) - len(EOS)})
            at += len(t.written)
        return "".join([BOS, *(t.written for t in repeated), *(t.written for t in new)]), len(repeated), loss, used

    for i, turn in enumerate(turns):
        if new and used + turn.tokens > budget:
            yield emit()
            past.extend(x for x in new if x is not system)
            repeated, used = [], opening
            if system and used + system.tokens + turn.tokens <= budget:
                repeated, used = [system], used + system.tokens
            back: list = []
            for x in reversed(past):
                if used + x.tokens > budget // 2 or used + x.tokens + turn.tokens > budget:
                    break
                back.append(x)
                used += x.tokens
            repeated += back[::-1]
            new = []
        if i == 0 and turn.role == "system":
            system = turn
        new.append(turn)
        used += turn.tokens
    if new:
        yield emit()


def format_windows(conversations: DataFrame, tokens: Callable[[Column], Column], budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """WINDOWS rows; ``tokens`` counts those of a text column, such as a codec's."""
    opening = conversations.sparkSession.range(1).select(tokens(F.lit(BOS))).first()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        ahead = next(rows, None)
        out: list = []
        size = 0
        while ahead is not None:
            conv = ahead[0]

            def turns():
                nonlocal ahead
                while ahead is not None and ahead[0] == conv:
                    yield Turn(*ahead[1:])
                    ahead = next(rows, None)

            for k, (text, repeated, loss, used) in enumerate(window_rows(turns(), budget, history, opening)):
                out.append({"conv_id": conv, "window": k, "formatted": text, "n_repeated": repeated, "loss": loss, "n_tokens": used})
                size += len(text)
                if size > 1 << 20:
                    yield pa.RecordBatch.from_pylist(out, schema=_SCHEMA)
                    out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_SCHEMA)

    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
    head = F.concat(F.lit(HEAD), escaped(F.col("role")), F.lit(TAIL))
    rows = rows.withColumn("written", F.concat(head, escaped(F.col("text")), F.lit(EOS))).withColumn("body", F.length(head)).withColumn("tokens", tokens(F.col("written")).cast("int"))
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_last(), "role", "text")
    return dealt.select("conv_id", "role", "written", "body", "tokens").mapInArrow(run, WINDOWS)


_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])
_SCHEMA = pa.schema([("conv_id", pa.int64()), ("window", pa.int64()), ("formatted", pa.string()), ("n_repeated", pa.int32()), ("loss", pa.list_(_SPAN)), ("n_tokens", pa.int64())])


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a window."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted, len(BOS))]


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


class _Digest:
    def __init__(self, conv: int | None):
        self.conv, self.turns, self.loss = conv, hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.size = 0

    def add(self, formatted: str, n_repeated: int, loss: list[dict]) -> None:
        for role, text in parse(formatted)[n_repeated:]:
            self.n_turns += 1
            self.turns.update(f"{role}\n{text}\n".encode())
        for span in loss:
            text = unescape(formatted[span["start"] : span["end"]])
            self.loss_chars += len(text)
            self.loss.update(text.encode())
        self.size += len(formatted)

    def row(self) -> dict:
        return dict(zip(_DIGEST.names, (self.conv, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.size), strict=True))


def read_back(windows: DataFrame) -> DataFrame:
    """DIGEST rows, a conversation each, read from the formatted windows alone, however these are stored and partitioned."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list = []
        now: _Digest | None = None
        for b in batches:
            for conv, *window in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if now is None or conv != now.conv:
                    if now:
                        out.append(now.row())
                    now = _Digest(conv)
                now.add(*window)
            if len(out) > 10_000:
                yield pa.RecordBatch.from_pylist(out, schema=_DIGEST)
                out.clear()
        if now:
            out.append(now.row())
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_DIGEST)

    dealt = windows.repartition("conv_id").sortWithinPartitions("conv_id", "window")
    return dealt.select("conv_id", "formatted", "n_repeated", "loss").mapInArrow(run, DIGEST)
