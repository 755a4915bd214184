import hashlib
import re
import zlib

import pytest

from custodia.llm import prefix_trie
from custodia.llm.prefix_trie import prefix_trie as trie

SCHEMA = "conv_id long, turn int, role string, text string, key string, depth int, n int, block int, length int"


def brute(rows):
    """Every prefix of every rebuilt conversation in a dict."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {conv: [turn[2:] for turn in sorted(turns)] for conv, turns in own.items()}
    rebuilt, members = {}, {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 4
        rebuilt[conv] = (*own.get(conv - conv % 20, [])[:h], *turns[h:])
        for depth in range(len(rebuilt[conv]) + 1):
            members.setdefault(rebuilt[conv][:depth], []).append(conv)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[c] for c in below) if below else 1
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        saved[node] = (len(members[node]) - 1) * words + sum(saved[c] for c in below)
    out = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if rebuilt[c] == node)
        parent = min(members[node[:-1]]) if node else None
        counts = (len(convs), len(children.get(node, [])), leaves[node], saved[node])
        out.append((min(convs), len(node), parent, *counts, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def nodes(spark, rows):
    table = spark.createDataFrame([(*row, "k", 1, 2, 3, 4) for row in rows], SCHEMA).repartition(3)
    return sorted((tuple(row) for row in trie(table).collect()), key=str)


def test_conversations_of_the_small_tables(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = [tuple(row) for row in table.select("conv_id", "turn", "role", "text").collect()]
    got = sorted((tuple(row) for row in trie(table).collect()), key=str)
    assert got == brute(rows)


def shared():
    """Long conversations, groups of copies, proper prefixes, short and absent first conversations."""
    rows = []
    for conv in range(0, 64):
        n = conv % 9 + (1 if conv % 20 else conv // 20)
        same = conv % 3 == 0
        rows += [(conv, t, "user" if t % 2 == 0 else "assistant", f"w{0 if same else conv % 5} turn {t}\tx") for t in range(n)]
    rows += [(1007, t, "user", "alone") for t in range(5)]
    rows += [(2003, 0, "user", "one turn"), (2009, 0, "user", "one turn")]
    return rows


@pytest.mark.parametrize("block", [1024, 2])
@pytest.mark.parametrize("ends", [4096, 2])
def test_equals_brute_force(spark, monkeypatch, block, ends):
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    monkeypatch.setattr(prefix_trie, "ENDS", ends)
    rows = shared()
    assert nodes(spark, rows) == brute(rows)


def test_one_conversation_with_most_rows(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 16)
    rows = shared() + [(500, t, "user", f"t {t}") for t in range(700)] + [(501, t, "user", f"t {t}") for t in range(600)]
    assert nodes(spark, rows) == brute(rows)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [
        (20, None, None, None),
        (20, 1, "user", "a  b\nc"),
        (20, 1, "user", "a  b\nc"),
        (21, None, "", ""),
        (21, 1, "user", "a  b\nc"),
        (22, 0, None, ""),
        (22, 1, "", None),
        (None, 0, "user", "nobody's"),
        (41, 0, "user", "é 中文 👍 " + "w " * 20_000),
        (42, 0, "ab", "c"),
        (43, 0, "a", "bc"),
    ]
    assert nodes(spark, rows) == brute(rows)


def test_turnless_conversations_end_at_the_root(spark):
    lone = [c for c in range(1, 400) if zlib.crc32(str(c).encode()) % 4 > 0 and c % 20][:3]
    rows = [(c, 0, "user", "x") for c in lone if c - c % 20 not in lone]
    got = nodes(spark, rows)
    assert got == brute(rows)
    ends = ",".join(str(row[0]) for row in rows)
    assert got == [(lone[0], 0, None, len(rows), 0, 1, 0, hashlib.sha256(ends.encode()).hexdigest())]


def test_empty_table(spark):
    assert nodes(spark, []) == []
