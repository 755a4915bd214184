import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from custodia.llm.exact_dedup import QuotientFilter, drop_copies, duplicates, repeated_fingerprints


def brute(rows):
    groups = {}
    for doc_id, text in rows:
        bare = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        groups.setdefault(bare, []).append((-len(text or ""), doc_id is None, doc_id if doc_id is not None else 0, doc_id))
    out = []
    for doc_id, text in rows:
        bare = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        group = groups[bare]
        keep = doc_id if len(group) == 1 else min(group)[3]
        out.append((doc_id, keep, len(group), doc_id is None or doc_id == keep, hashlib.sha256(bare.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("block_rows", [1, 7, 20_000])
def test_documents(small_docs, edge_docs, block_rows):
    for docs in (small_docs, edge_docs):
        rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        assert sorted((tuple(r)[:5] for r in duplicates(docs, block_rows).collect()), key=str) == brute(rows)


def test_drop_copies(edge_docs, no_docs):
    kept = drop_copies(edge_docs)
    assert kept.columns == edge_docs.columns
    # Of the empty texts the white one is the longest; 7 and 8 are longer than 6; the row without an id stays.
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([2, 3, 4, 5, 7, 9, 10, None], key=str)
    assert duplicates(no_docs).count() == 0
    assert drop_copies(no_docs).count() == 0


def test_repeated_rows(spark):
    rows = [(1, "a b"), (1, "a b"), (1, "a\tb"), (2, "other"), (1, "third")]
    kept = drop_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.text.replace("\t", " ") for r in kept) == ["a b", "other", "third"]


def test_merge_is_lossless():
    random = np.random.default_rng(1)
    bits = 20
    parts, whole = [], Counter()
    for _ in range(5):
        keys = random.integers(0, 1 << 32, 300, dtype=np.uint64) & np.uint64(0xFFF00FFF)
        keys[:50] = 77
        distinct, counts = np.unique(keys, return_counts=True)
        whole.update(dict(zip(distinct.tolist(), counts.tolist(), strict=True)))
        packed = QuotientFilter.of(distinct, counts, bits).pack()
        parts.append(QuotientFilter.unpack(packed["quotients"], packed["remainders"], packed["counts"]))
    merged = QuotientFilter.merge(parts, bits)
    assert dict(zip(merged.keys(bits).tolist(), merged.counts.tolist(), strict=True)) == whole
    run = merged.remainders[: merged.lengths[0]]
    assert (np.diff(run.astype(np.int64)) > 0).all()


def test_only_repeated_are_routed(spark):
    docs = spark.range(1000).selectExpr("id doc_id", "concat('t', cast(id % 997 as string)) text")
    assert repeated_fingerprints(docs, 100).count() == 3
