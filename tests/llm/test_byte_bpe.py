import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from custodia.llm.byte_bpe import Codec, encode_documents, read_ranks
from custodia.llm.queries import RANKS

EDGE_ROWS = 14


@pytest.fixture(scope="module")
def codec():
    return Codec(read_ranks(RANKS))


@pytest.fixture(scope="module")
def peer():
    ranks = {token: i for i, token in enumerate(read_ranks(RANKS))}
    return tiktoken.Encoding("peer", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def check(codec, peer, texts):
    data = [text.encode() for text in texts]
    ids, first = codec.encode(data)
    for i, text in enumerate(texts):
        assert ids[first[i] : first[i + 1]].tolist() == peer.encode_ordinary(text)
    assert codec.decode(ids, first) == data
    assert codec.decimal(ids, first) == [" ".join(map(str, peer.encode_ordinary(t))).encode() for t in texts]


PARTS = ["'", "s", "t", "re", "ve", "m", "ll", "d", " ", "  ", "\n", "\t", "é", "1", "٣", "!", "　", "\x1c", "中文", "👍", "the"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=25).map("".join), min_size=1, max_size=8))
def test_as_tiktoken(codec, peer, texts):
    check(codec, peer, texts)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=60), min_size=1, max_size=5))
def test_any_character(codec, peer, texts):
    check(codec, peer, texts)


def test_long_pieces(codec, peer):
    check(codec, peer, ["ab" * 3000, "", " " * 2000 + "x", "'s" * 50, "!" * 999, "a" * 5000])


def test_pieces_that_a_polynomial_cannot_tell_apart(codec, peer):
    bits = [0]
    while len(bits) < 1024:
        bits += [1 - b for b in bits]
    one, two = ("".join(pair[b] for b in bits) for pair in ("ab", "ba"))
    check(codec, peer, [one, two])


def test_documents(codec, peer, documents):
    check(codec, peer, documents.text.tolist())


def test_pair_lookup(codec):
    rank = {token: i for i, token in enumerate(read_ranks(RANKS))}
    pairs = [(b"t", b"he"), (b"th", b"e"), (b"\xff", b"\xff"), (b"e", b"t")]
    found = codec.pairs.lookup(*(np.array([rank[p[k]] for p in pairs]) for k in (0, 1)))
    assert found.tolist() == [rank.get(a + b, 2**31 - 1) for a, b in pairs]


def test_edge_rows(spark, peer, edge_docs, no_docs):
    found = encode_documents(edge_docs, RANKS).collect()
    texts = {row.doc_id: row.text or "" for row in edge_docs.collect()}
    assert len(found) == edge_docs.count()
    for row in found:
        ids = peer.encode_ordinary(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()
    assert encode_documents(no_docs, RANKS).count() == 0
    assert len(found) == EDGE_ROWS
