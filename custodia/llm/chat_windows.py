r"""Chat formatting in budgeted windows of whole turns.

Prefix sums of turn tokens choose spans of turns that fit a budget. Every window
starts with the system turn, if the conversation begins with one, repeats a
limited number of turns before its own, and masks the loss of what it repeats, so
each assistant turn is learned from once.

The template is ``<|im_start|>role\ntext<|im_end|>\n`` per turn. A backslash is put
between ``<`` and ``|`` wherever a text or role holds them, also after backslashes
that stand there, which takes it back without loss; ``\n`` in a role is escaped too.

Defined results: a null text or role is an empty one; rows of a conversation are
ordered by turn, then role and text, null turns first, and repeated rows are turns of
their own; a turn larger than the budget is a window by itself, never cut; rows
without a conversation id form one conversation; an empty table gives an empty
table; further columns are not read. Only one window's turns are held at a time.
"""

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Template parts. Fixed values.
START, END = "<|im_start|>", "<|im_end|>"

#: Tokens of a window, and turns of history that it repeats at most.
BUDGET, HISTORY = 512, 4

_TOKEN = re.compile(r"\w+|[^\w\s]")
_OPEN = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")

WINDOW = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("window", pa.int64()),
        ("n_repeated", pa.int64()),
        ("n_new", pa.int64()),
        ("formatted", pa.string()),
        ("loss_starts", pa.list_(pa.int64())),
        ("loss_ends", pa.list_(pa.int64())),
    ]
)
WINDOWS = (
    "conv_id long, window long, n_repeated long, n_new long, formatted string, "
    "loss_starts array<long>, loss_ends array<long>"
)
READ = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
    ]
)
DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


class Turn(NamedTuple):
    role: str
    text: str
    tokens: int


def escape(text: str) -> str:
    return _OPEN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("%", "%25").replace("\n", "%0A"))


def unescape_role(role: str) -> str:
    return unescape(role).replace("%0A", "\n").replace("%25", "%")


def count_tokens(role: str, text: str) -> int:
    """Words and marks of a turn, and its template's two."""
    return len(_TOKEN.findall(text)) + len(_TOKEN.findall(role)) + 2


def format_window(repeated: list[Turn], new: list[Turn]) -> tuple[str, list[int], list[int]]:
    """The text of a window, and where the new assistant texts start and end in it."""
    parts, starts, ends, at = [], [], [], 0
    for i, turn in enumerate([*repeated, *new]):
        head, body = f"{START}{escape_role(turn.role)}\n", escape(turn.text)
        if i >= len(repeated) and turn.role == "assistant":
            starts.append(at + len(head))
            ends.append(at + len(head) + len(body))
        parts.append(f"{head}{body}{END}\n")
        at += len(parts[-1])
    return "".join(parts), starts, ends


class Windows:
    """Cuts one conversation, turn by turn, into windows."""

    def __init__(self, budget: int, history: int):
        self.budget, self.history = budget, history
        self.system: list[Turn] = []
        self.past: list[Turn] = []  # what the next window may repeat
        self.repeated: list[Turn] = []
        self.new: list[Turn] = []
        self.sum = 0  # running sum of tokens in the open window
        self.first = True

    def add(self, turn: Turn):
        """Takes a turn; returns the window that it closed, if any."""
        closed = None
        if self.new and self.sum + turn.tokens > self.budget:
            closed = self.close()
            self._open(turn)
        if self.first and turn.role == "system":
            self.system = [turn]
        self.first = False
        self.new.append(turn)
        self.sum += turn.tokens
        return closed

    def close(self):
        """The open window: repeated and new turns."""
        out = (self.repeated, self.new)
        kept = [turn for turn in self.past + self.new if not (self.system and turn is self.system[0])]
        self.past = kept[-self.history :] if self.history else []
        self.repeated, self.new, self.sum = [], [], 0
        return out

    def _open(self, turn: Turn) -> None:
        """Repeats the system turn always, and the longest run of latest turns that leaves room for the new one."""
        room = self.budget - turn.tokens - sum(t.tokens for t in self.system)
        run: list[Turn] = []
        for old in reversed(self.past):
            room -= old.tokens
            if room < 0:
                break
            run.insert(0, old)
        self.repeated = self.system + run
        self.sum = sum(t.tokens for t in self.repeated)


def format_conversations(rows: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """The windows of all conversations, in order within a partition.

    Rows are sorted within partitions and streamed, so a conversation of any length
    needs the memory of one window.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, at, number = None, None, 0
        out: list[dict] = []

        def put(window) -> None:
            repeated, new = window
            text, starts, ends = format_window(repeated, new)
            out.append(
                {
                    "conv_id": at,
                    "window": number,
                    "n_repeated": len(repeated),
                    "n_new": len(new),
                    "formatted": text,
                    "loss_starts": starts,
                    "loss_ends": ends,
                }
            )

        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(3)]
            for conv_id, role, text in zip(*columns, strict=True):
                if state is None or conv_id != at:
                    if state is not None:
                        put(state.close())
                    state, at, number = Windows(budget, history), conv_id, 0
                if window := state.add(Turn(role, text, count_tokens(role, text))):
                    put(window)
                    number += 1
            if out:
                yield pa.RecordBatch.from_pylist(out, WINDOW)
                out.clear()
        if state is not None:
            put(state.close())
            yield pa.RecordBatch.from_pylist(out, WINDOW)

    named = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.col("turn").cast("long").alias("turn"),
    )
    # Sorted by what a conversation's rows are dealt by, so each one is whole in one task.
    dealt = named.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.select("conv_id", "role", "text").mapInArrow(run, WINDOWS)


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted window."""
    out, at = [], 0
    while at < len(formatted):
        line = formatted.index("\n", at)
        end = formatted.index(END, line)
        out.append((unescape_role(formatted[at + len(START) : line]), unescape(formatted[line + 1 : end])))
        at = end + len(END) + 1
    return out


def read_back(windows: DataFrame) -> DataFrame:
    """Digests of conversations, from nothing but their formatted windows and masks.

    Takes the windows as `format_conversations` returns them, a conversation's in
    order within one partition, and moves nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def digest() -> dict:
            conv_id, n_turns, turns, loss_chars, loss, chars = held
            found = {"conv_id": conv_id, "n_turns": n_turns, "turns_sha256": turns.hexdigest()}
            return found | {"loss_chars": loss_chars, "loss_sha256": loss.hexdigest(), "formatted_chars": chars}

        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if held is None or row["conv_id"] != held[0]:
                    if held is not None:
                        out.append(digest())
                    held = [row["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                turns = parse_turns(row["formatted"])[row["n_repeated"] :]
                held[1] += len(turns)
                for role, text in turns:
                    held[2].update(f"{role}\n{text}\n".encode())
                for start, end in zip(row["loss_starts"], row["loss_ends"], strict=True):
                    text = unescape(row["formatted"][start:end])
                    held[3] += len(text)
                    held[4].update(text.encode())
                held[5] += len(row["formatted"])
            if out:
                yield pa.RecordBatch.from_pylist(out, READ)
        if held is not None:
            yield pa.RecordBatch.from_pylist([digest()], READ)

    return windows.mapInArrow(run, DIGESTS)
