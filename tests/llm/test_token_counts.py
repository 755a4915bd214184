import numpy as np
import pytest

from custodia.llm.byte_bpe import encode_documents
from custodia.llm.queries import END_OF_DOCUMENT, RANKS
from custodia.llm.token_counts import count_tokens, write_token_files
from custodia.storage import new_folder, stage


def counts(docs, block_bytes):
    folder = new_folder(docs.sparkSession, "tokens")
    order = stage(write_token_files(docs, RANKS, END_OF_DOCUMENT, folder), "order")
    found = count_tokens(order, END_OF_DOCUMENT, END_OF_DOCUMENT, block_bytes)
    return sorted(map(tuple, order.join(found, ["file", "ordinal"]).select("doc_id", "n_tokens").collect()), key=str)


def expected(docs):
    return sorted(((r.doc_id, r.n_tokens) for r in encode_documents(docs, RANKS).collect()), key=str)


@pytest.mark.parametrize("block_bytes", [2, 6, 1000, 4_000_000])
def test_blocks(edge_docs, block_bytes):
    docs = edge_docs.filter("doc_id < 9 OR doc_id IS NULL") if block_bytes < 10 else edge_docs
    assert counts(docs, block_bytes) == expected(docs)


def test_documents(small_docs):
    assert counts(small_docs, 4096) == expected(small_docs)


def test_empty(no_docs):
    assert counts(no_docs, 4096) == []


@pytest.mark.parametrize("ids", [[], [9], [9, 9], [1, 2], [1, 9, 2, 3], [9, 1, 1, 1, 1, 1, 9, 9]])
def test_any_file(spark, tmp_path, ids):
    """Tokens after the last separator are one more document."""
    path = tmp_path / "a.tokens"
    path.write_bytes(np.array(ids, "<u2").tobytes())
    found = count_tokens(spark.createDataFrame([(str(path),)], "file string"), 9, 9, 4).orderBy("ordinal").collect()
    lengths, n = [], 0
    for i in ids:
        if i == 9:
            lengths.append(n)
            n = 0
        else:
            n += 1
    assert [r.n_tokens for r in found] == lengths + ([n] if n else [])
    assert [r.ordinal for r in found] == list(range(len(found)))
