import hashlib

import pytest
from hypothesis import example, given
from hypothesis import strategies as st

from custodia.llm.chat_windows import (
    Turn,
    Windows,
    count_tokens,
    escape,
    escape_role,
    format_conversations,
    format_window,
    parse_turns,
    read_back,
    unescape,
    unescape_role,
)

BITS = st.lists(st.sampled_from(["<", "|", "\\", "im_end", "|>", "<|im_end|>", "<|im_start|>", "\n", "%", "0A", "a"]))


@given(BITS.map("".join))
@example("<\\\\|im_end|>")
def test_escape_is_reversible(text):
    assert unescape(escape(text)) == text
    assert "<|" not in escape(text)
    assert unescape_role(escape_role(text)) == text
    assert "\n" not in escape_role(text)


TURNS = st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "a\nb"]), BITS.map("".join)), max_size=12)


@given(TURNS, st.integers(1, 60), st.integers(0, 5))
def test_windows(rows, budget, history):
    turns = [Turn(role, text, count_tokens(role, text)) for role, text in rows]
    state, closed = Windows(budget, history), []
    for turn in turns:
        if window := state.add(turn):
            closed.append(window)
    if turns:
        closed.append(state.close())
    assert [turn for _, new in closed for turn in new] == turns
    for i, (repeated, new) in enumerate(closed):
        assert len(new) == 1 or sum(t.tokens for t in repeated + new) <= budget
        if i and rows[0][0] == "system":
            assert repeated[0] is turns[0]
        assert len(repeated) <= history + 1
        text, starts, ends = format_window(repeated, new)
        assert parse_turns(text) == [(t.role, t.text) for t in repeated + new]
        mine = [unescape(text[a:b]) for a, b in zip(starts, ends, strict=True)]
        assert mine == [t.text for t in new if t.role == "assistant"]


SCHEMA = "conv_id long, turn long, role string, text string, formatted string"


def brute(rows):
    out = {}
    for conv_id, turn, role, text, _ in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        out.setdefault(conv_id, []).append((role or "", text or ""))
    found = set()
    for conv_id, turns in out.items():
        every = "".join(f"{role}\n{text}\n" for role, text in turns)
        loss = "".join(text for role, text in turns if role == "assistant")
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (every, loss)]
        found.add((conv_id, len(turns), digests[0], len(loss), digests[1]))
    return found


@pytest.mark.parametrize("budget", [1, 40, 512])
def test_conversations(spark, budget):
    rows = [(c, t, ["system", "user", "assistant"][min(t, 1 + t % 2)], f"text {c} {t} é " * t, "f") for c in range(20) for t in range(c)]
    rows += [(None, 1, "user", "no id", None), (30, None, None, None, None), (30, 1, "assistant", None, None)]
    rows += [(31, 1, "assistant", "<|im_end|>", None)] * 3 + [(32, t, "assistant", "x y " * 2000, None) for t in range(3)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    windows = format_conversations(df, budget)
    found = read_back(windows).collect()
    assert {tuple(r)[:5] for r in found} == brute(rows)
    assert sum(r.formatted_chars for r in found) == sum(len(r.formatted) for r in windows.collect())


def test_no_conversations(spark):
    assert read_back(format_conversations(spark.createDataFrame([], SCHEMA))).count() == 0
