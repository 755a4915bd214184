import hashlib
import zlib
from collections import Counter

import pytest

from custodia.llm.sharding import shard


def brute(rows, shards, seed="shard-1"):
    """Ranks within sources, one sorted list, equal cuts."""
    sources = {}
    for doc_id, text, source in rows:
        key = hashlib.md5(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
        data = (text or "").encode()
        row = (doc_id, len(data) + 1, zlib.crc32(data))
        sources.setdefault("1" if source is None else f"0{source}", []).append((key, str(doc_id), row))
    whole = []
    for name, members in sources.items():
        members.sort()
        whole += [((i + 0.5) / len(members), name, row) for i, (*_, row) in enumerate(members)]
    whole.sort(key=lambda x: x[:2])
    out, n = [], len(whole)
    for k in range(shards):
        for slot, (_, _, row) in enumerate(whole[k * n // shards : (k + 1) * n // shards]):
            out.append((*row, k, slot))
    return sorted(out, key=str)


@pytest.mark.parametrize(("shards", "cell_rows"), [(16, 5_000), (16, 10), (3, 1), (1, 50)])
def test_documents(small_docs, edge_docs, shards, cell_rows):
    for docs in (small_docs, edge_docs):
        rows = [(r.doc_id, r.text, r.source) for r in docs.select("doc_id", "text", "source").collect()]
        found = [tuple(r) for r in shard(docs, shards, cell_rows=cell_rows).collect()]
        assert sorted(found, key=str) == brute(rows, shards)


def test_shards_match_the_mixture(small_docs):
    names = {r.doc_id: r.source for r in small_docs.select("doc_id", "source").collect()}
    found = shard(small_docs, 4).collect()
    whole = Counter(names.values())
    for k in range(4):
        mine = Counter(names[r.doc_id] for r in found if r.shard == k)
        assert all(abs(mine[s] - n / 4) <= 1 for s, n in whole.items())


def test_empty(no_docs):
    assert shard(no_docs).count() == 0
