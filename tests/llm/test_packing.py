import itertools
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from custodia.llm import packing
from custodia.llm.packing import best_fit_decreasing, certificate, cut, dual_feasible, lower_bound, offsets_of, pack, repack

MERGES = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    tokenizer = Tokenizer.from_file(MERGES)
    tokenizer.encode_special_tokens = True
    return tokenizer


def packed(docs, **options):
    return pack(docs, MERGES, public_tokenizers.PATTERN, 2, **options)


def check_pieces(rows, texts, tokenizer, capacity):
    """Every document's pieces are its ids, and sequences are filled without gaps or overlaps."""
    want = []
    for doc_id, text in texts:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        first = len(ids) % capacity or capacity
        starts = [0, *range(first, len(ids), capacity)]
        for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
            want.append((doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())))
    key = [str(row[:5]) for row in rows]
    assert sorted(key) == sorted(map(str, want))
    sequences = {}
    for row in rows:
        sequences.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for spans in sequences.values():
        spans.sort()
        assert [offset for offset, _ in spans] == [0, *itertools.accumulate(n for _, n in spans)][:-1]
        assert sum(n for _, n in spans) <= capacity


def test_documents_of_the_small_tables(small_docs, documents, tokenizer):
    result = packed(small_docs)
    check_pieces(result.collect(), list(zip(documents.doc_id, documents.text, strict=True)), tokenizer, 1024)
    sequences, fewest = certificate(result)
    assert fewest <= sequences <= fewest + 1


def test_rounds_exchange_what_is_left(small_docs, documents, tokenizer):
    """Runs of a few pieces each: several partitions exchange their emptiest bins, round after round."""
    alone = packed(small_docs, run_pieces=40, capacity=200)
    check_pieces(alone.collect(), list(zip(documents.doc_id, documents.text, strict=True)), tokenizer, 200)
    sequences, fewest = certificate(alone, 200)
    assert fewest <= sequences <= 1.02 * fewest + 2


def test_edge_rows(edge_docs, tokenizer):
    result = packed(edge_docs, capacity=64)
    rows = [(row.doc_id, row.text) for row in edge_docs.select("doc_id", "text").collect()]
    check_pieces(result.collect(), rows, tokenizer, 64)
    assert result.columns == packing.PACKED


def test_empty_table(no_docs):
    assert packed(no_docs).collect() == []


def test_special_strings_and_odd_bytes(spark, tokenizer):
    texts = ["a<|endoftext|>b", "don't  stop\n\n'll", "é 中文 👍‍", "   ", "x" * 3000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check_pieces(packed(docs).collect(), list(enumerate(texts)), tokenizer, 1024)
    broken = docs.selectExpr("doc_id", "cast(unhex('61FF62') as string) AS text")
    check_pieces(packed(broken).collect(), [(i, "a�b") for i in range(len(texts))], tokenizer, 1024)


@pytest.mark.parametrize(("n", "pieces"), [(1, [(0, 1)]), (8, [(0, 8)]), (9, [(0, 1), (1, 8)]), (24, [(0, 8), (8, 8), (16, 8)])])
def test_only_the_first_piece_may_be_shorter(n, pieces):
    assert cut(n, 8) == pieces


def fewest_bins(lengths, capacity):
    """The optimum, by trying every bin for every length."""
    best = [len(lengths)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] >= lengths[i] and bins[k] not in bins[:k]:
                place(i + 1, [*bins[:k], bins[k] - lengths[i], *bins[k + 1 :]])
        place(i + 1, [*bins, capacity - lengths[i]])

    place(0, [])
    return best[0]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 12), min_size=1, max_size=9))
def test_bounds_hold_and_certified_packings_are_optimal(lengths):
    lengths = np.array(sorted(lengths, reverse=True))
    optimum = fewest_bins(lengths.tolist(), 12)
    assert lower_bound(np.bincount(lengths, minlength=13), 12) <= optimum
    bins, free, certified = repack(lengths, 12)
    assert len(free) >= optimum
    assert (np.bincount(bins, lengths, len(free)) == 12 - free).all()
    assert (np.bincount(bins) > 0).all()
    if certified:
        assert len(free) == optimum
    offsets = offsets_of(bins, lengths)
    for number in range(len(free)):
        spans = sorted(zip(offsets[bins == number].tolist(), lengths[bins == number].tolist(), strict=True))
        assert [a for a, _ in spans] == [0, *itertools.accumulate(n for _, n in spans)][:-1]


@pytest.mark.parametrize("capacity", [6, 7, 12])
def test_functions_are_dual_feasible(capacity):
    """No multiset that fits a bin sums to more than a full bin."""

    def multisets(room, largest):
        yield ()
        for x in range(1, min(room, largest) + 1):
            for rest in multisets(room - x, x):
                yield (x, *rest)

    bins = list(multisets(capacity, capacity))
    for functions, full in dual_feasible(capacity):
        for f in functions:
            assert max(sum(int(f[x]) for x in one) for one in bins) <= full


def test_a_bound_beyond_the_sum():
    """Three lengths of more than half a bin need three bins, though their sum is less than two."""
    lengths = np.array([7, 7, 7])
    assert lower_bound(np.bincount(lengths, minlength=13), 12) == 3
    assert repack(lengths, 12)[2]


def test_exchanges_close_a_gap():
    """Best-fit decreasing alone needs five bins for what fits into four."""
    lengths = np.array([4, 5, 6, 5, 4, 7, 5, 6, 6, 8, 3, 3, 4, 9, 5])
    assert len(best_fit_decreasing(lengths, 20)[1]) == 5
    _, free, certified = repack(lengths, 20)
    assert (len(free), certified) == (4, True)
