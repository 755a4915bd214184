import hashlib
import math

import numpy as np
import pytest

from custodia.llm.vector_codes import codebook_digest, encode_vectors, nearest


def brute(rows, parts=4, entries=256, rounds=4):
    """Lloyd rounds over all pairs, in Python integers."""
    kept = [
        (vec_id, label, [math.floor(float(x) * 1024) for x in v])
        for vec_id, v, label in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    if not kept:
        return []
    width = len(kept[0][2]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, _, v in kept]
    books = [[cut[k][p] for k in range(min(entries, len(kept)))] for p in range(parts)]

    def best(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for c in cut:
                members.setdefault(best(c[p], books[p])[1], []).append(c[p])
            for k, found in members.items():
                books[p][k] = [sum(column) // len(found) for column in zip(*found, strict=True)]
    final = [[best(c[p], books[p]) for p in range(parts)] for c in cut]
    sha = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    errors = {}
    for (_, label, _), found in zip(kept, final, strict=True):
        errors[label] = errors.get(label, 0) + sum(d for d, _ in found)
    return [
        (vec_id, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), errors[label], sha)
        for (vec_id, label, _), found in zip(kept, final, strict=True)
    ]


SCHEMA = "vec_id long, embedding array<float>, label int, row string, entry int, part string, salt int"


def vectors(spark, rows):
    return spark.createDataFrame([(*row, "r", 7, "p", 1) for row in rows], SCHEMA).repartition(3)


def as_set(df):
    return sorted((tuple(row) for row in df.collect()), key=str)


def some(n, seed=5, centres=7):
    random = np.random.default_rng(seed)
    middle = random.normal(size=(centres, 8))
    return [(i, (middle[i % centres] + 0.2 * random.normal(size=8)).astype("f4").tolist(), i % 3) for i in range(n)]


@pytest.mark.parametrize("entries", [1, 5, 16])
def test_equals_brute_force(spark, entries):
    rows = some(90)
    got = encode_vectors(vectors(spark, rows), entries=entries)
    assert as_set(got) == sorted(brute(rows, entries=entries), key=str)


def test_nulls_copies_ties_and_clashing_columns(spark):
    rows = some(12)
    rows += [rows[0], rows[0], (None, rows[1][1], None), (3, rows[2][1], None), (77, [0.0] * 8, None)]
    rows += [
        (90, None, 1),
        (91, [None] * 8, 1),
        (92, [float("nan")] * 8, 1),
        (93, [float("inf")] + [0.0] * 7, 1),
        (94, [float("-inf")] + [0.0] * 7, 1),
    ]
    got = encode_vectors(vectors(spark, rows), entries=6)
    assert as_set(got) == sorted(brute(rows, entries=6), key=str)
    assert got.count() == 17


def test_a_third_of_all_rows_in_one_entry(spark):
    rows = some(60) + [(100 + i, [0.5] * 8, 9) for i in range(30)]
    got = encode_vectors(vectors(spark, rows), entries=8)
    assert as_set(got) == sorted(brute(rows, entries=8), key=str)


def test_no_vectors(spark):
    assert encode_vectors(vectors(spark, [])).collect() == []
    assert encode_vectors(vectors(spark, [(1, None, 2)])).collect() == []


@pytest.mark.parametrize("wrong", [[(1, [0.0] * 7, 0)], [(1, [0.0] * 8, 0), (2, [0.0] * 12, 0)], [(1, [1e30] * 8, 0)]])
def test_lengths_and_sizes_that_cannot_be_cut_stop_the_query(spark, wrong):
    with pytest.raises(Exception, match="(?i)vector"):
        encode_vectors(vectors(spark, wrong), entries=1).collect()


def test_large_components_are_compared_exactly():
    book = np.array([[0, 0], [2**27, 1]], np.int64)
    parts = np.array([[2**26, 0], [2**26, 1], [2**26 + 1, 0]], np.int64)
    entry, distance = nearest(parts, book)
    want = [min((sum((int(a) - int(b)) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book)) for x in parts]
    assert list(zip(distance.tolist(), entry.tolist(), strict=True)) == want


def test_digest_of_codebooks():
    assert codebook_digest(np.array([[[1, -2]], [[3, 4]]])) == hashlib.sha256(b"1,-2,3,4").hexdigest()
