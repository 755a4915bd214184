import re
import zlib
from collections import Counter

import numpy as np
import pytest

from custodia.llm import quality_filter, rule_ensemble
from custodia.llm.common import TextArrays
from custodia.llm.quality_filter import assess_documents, keep_good


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    marked = {i + k for i in range(len(words) - 2) for k in range(3) if windows[tuple(words[i : i + 3])] > 1}
    failed = len(words) < 50 or 100 * len(marked) > 50 * len(words)
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(marked), failed)


@pytest.fixture(scope="module")
def ngram_model(small_docs, labels):
    return quality_filter.train(small_docs, labels)


def test_base_counts(small_docs, edge_docs, ngram_model):
    for docs in (small_docs, edge_docs):
        texts = {r.doc_id: r.text for r in docs.collect()}
        found = assess_documents(docs, ngram_model).collect()
        assert len(found) == docs.count()
        for r in found:
            if r.doc_id is not None:
                counts = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                assert counts == brute_counts(texts[r.doc_id])
            assert r.kept == (not r.base_failed and r.score >= quality_filter.KEEP_AT)


def test_scores_do_not_depend_on_neighbours(documents, ngram_model):
    texts = [t.encode() for t in documents.text[:50]]
    together = quality_filter.probability(ngram_model, TextArrays(texts))
    alone = [quality_filter.probability(ngram_model, TextArrays([t]))[0] for t in texts]
    assert together == pytest.approx(alone)


def test_keep_good(edge_docs, no_docs, small_docs, ngram_model):
    kept = keep_good(edge_docs, ngram_model)
    assert kept.schema.names == edge_docs.columns
    assert all(len(r.text.split()) >= 50 for r in kept.collect())
    assert keep_good(no_docs, ngram_model).count() == 0
    verdicts = assess_documents(small_docs, ngram_model).filter("kept").count()
    assert keep_good(small_docs, ngram_model).count() == verdicts


def test_without_labels(spark, small_docs, labels):
    none = labels.filter("quality = 7")
    model = quality_filter.train(small_docs, none)
    assert assess_documents(small_docs, model).filter("kept = base_failed").count() == 0
    rules = rule_ensemble.train(small_docs, none)
    assert {r.score for r in rule_ensemble.score_documents(small_docs, rules).collect()} == {0.5}


def test_windows_that_a_polynomial_cannot_tell_apart(spark, ngram_model):
    bits = [0]
    while len(bits) < 1024:
        bits += [1 - b for b in bits]
    one, two = ("".join(pair[b] for b in bits) for pair in ("ab", "ba"))
    texts = [f"x {one} y x {two} y z", f"x {one} y x {one} y"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.n_repeat_words for r in assess_documents(docs, ngram_model).collect()}
    assert found == {i: brute_counts(t)[4] for i, t in enumerate(texts)} == {0: 0, 1: 6}


@pytest.fixture(scope="module")
def larger(spark):
    folder = "/root/testdata/sf0.01"
    return spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")


def accuracy(scored, labels):
    rows = scored.join(labels, "doc_id").filter("held_out").select("good", "quality").collect()
    return np.mean([r.good == (r.quality == 1) for r in rows]), len(rows)


def test_rules_hold_out(larger):
    docs, labels = larger
    scored = rule_ensemble.score_documents(docs, rule_ensemble.train(docs, labels))
    share, n = accuracy(scored.selectExpr("doc_id", "held_out", "predicted = 1 AS good"), labels)
    assert n > 50
    assert share > 0.95
    remainders = {r.doc_id: r.held_out for r in scored.collect()}
    assert all(held == (zlib.crc32(str(d).encode()) % 4 == 2) for d, held in remainders.items())


def test_compiled_rules(spark, small_docs, labels, edge_docs, no_docs):
    """Columns and numpy give the same scores; both are the rules' sum."""
    model = rule_ensemble.train(small_docs, labels)
    for docs in (small_docs, edge_docs):
        stats = rule_ensemble.statistics()
        numbers = docs.select("doc_id", *[c.cast("double").alias(n) for n, c in stats.items()])
        rows = numbers.withColumn("score", model.column()).collect()
        x = np.array([[r[name] for name in stats] for r in rows])
        assert [r.score for r in rows] == pytest.approx(model.score(x).tolist())
    assert rule_ensemble.score_documents(no_docs, model).count() == 0
    edge = rule_ensemble.score_documents(edge_docs, model).collect()
    assert len(edge) == edge_docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in edge)


def test_lasso_is_sparse():
    random = np.random.default_rng(2)
    held = (random.random((800, 30)) < 0.5).astype(float)
    target = (held[:, 3] + held[:, 9] > 1).astype(float)
    weights, _ = rule_ensemble.lasso(held, target, np.ones(800))
    assert {3, 9} == set(np.argsort(-np.abs(weights))[:2])
    assert (weights == 0).sum() > 10
