import hashlib
import re
from fractions import Fraction

import pytest

from custodia.llm.mixing import Level, mix, repeat_documents, water_level


def n_words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(sizes, weights, epochs):
    """Water-filling round by round, in fractions."""
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in sizes if s not in capped]
        left = total - sum(epochs * sizes[s] for s in capped)
        share = {s: Fraction(left * weights[s], sum(weights[f] for f in free)) for s in free}
        over = {s for s in free if share[s] >= epochs * sizes[s]}
        if not over:
            return {s: share.get(s, Fraction(epochs * sizes[s])) for s in sizes}
        capped |= over


def brute(rows, weights=(5, 2, 1), epochs=3, seed="mix-1"):
    rows = [(d, n_words(t), s) for d, t, s in rows]
    names = sorted({s for *_, s in rows}, key=lambda s: (s is None, (s or "").encode()))
    sizes = {name: sum(n for _, n, s in rows if s == name) for name in names}
    goal = brute_targets(sizes, {name: weights[i % len(weights)] for i, name in enumerate(names)}, epochs)
    out = []
    for name in names:
        want = int(goal[name] + Fraction(1, 2))
        whole, extra = divmod(want, sizes[name]) if sizes[name] else (0, 0)
        place = {}
        for d, n, s in rows:
            if s == name:
                key = hashlib.md5(f"{seed}:{'' if d is None else d}".encode()).hexdigest()
                place.setdefault(key, []).append((d, n))
        for key in sorted(place):
            here = sum(n for _, n in place[key])
            part = 0 if extra <= 0 else None if here <= extra else extra // len(place[key])
            for d, n in place[key]:
                out.append((d, n, sizes[name], float(goal[name]), whole * n + (n if part is None else min(n, part))))
            extra -= here
    return sorted(out, key=str)


def check(docs, **how):
    rows = [(r.doc_id, r.text, r.source) for r in docs.select("doc_id", "text", "source").collect()]
    found = sorted((tuple(r) for r in mix(docs, **how).collect()), key=str)
    want = brute(rows, **how)
    assert [r[:3] + r[4:] for r in found] == [r[:3] + r[4:] for r in want]
    assert [r[3] for r in found] == pytest.approx([r[3] for r in want])


@pytest.mark.parametrize("how", [{}, {"weights": (50, 1), "epochs": 2}, {"epochs": 1}])
def test_documents(small_docs, how):
    check(small_docs, **how)


def test_edge_rows(edge_docs, no_docs):
    check(edge_docs)
    assert mix(no_docs).count() == 0
    assert repeat_documents(no_docs).count() == 0


def test_level(spark):
    rows = [("0a", 100, 5), ("0b", 10, 5), ("0c", 100, 1)]
    sources = spark.createDataFrame(rows, "stratum string, source_size long, weight long")
    # b gives 30 at most; the rest of 210 words is shared by 5 and 1.
    assert water_level(sources, 3) == Level(180, 6)
    assert water_level(sources.filter("source_size = 0"), 3) is None


def test_taken_words_meet_the_target(small_docs):
    found = mix(small_docs).groupBy("source_size", "target").agg({"taken": "sum"}).collect()
    assert all(abs(r["sum(taken)"] - r.target) <= 0.5 for r in found)


def test_repeat_documents(small_docs, edge_docs):
    taken = {r.doc_id: r for r in mix(small_docs).collect()}
    repeated = repeat_documents(small_docs)
    assert repeated.columns == small_docs.columns
    counts = {r.doc_id: r["count"] for r in repeated.groupBy("doc_id").count().collect()}
    for doc_id, row in taken.items():
        assert counts.get(doc_id, 0) == (int(row.taken / row.size + 0.5) if row.size else 0)
    assert repeat_documents(edge_docs).columns == edge_docs.columns
