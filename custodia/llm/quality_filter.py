"""Quality rules: fixed base rules, and a calibrated logistic regression over hashed n-grams.

The model reads single words, word pairs and four-byte grams, hashed into two
tables of weights; a text's score is the mean weight of its word grams plus that
of its byte grams. It is fitted on a bounded sample of labelled rows, calibrated
on a part of the sample that the weights have not seen, and applied to record
batches against a fixed threshold.

Defined results: a null or empty text has no words and fails the base rules;
equal texts get equal verdicts; an empty table gives an empty table; without
labels of both kinds every text that passes the base rules is kept; further
columns are passed on by `keep_good` and not read otherwise. Texts are read whole.
Words are compared by 64-bit hashes.
"""

import pickle
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custodia.llm.common import TextArrays, bounds, distinct_segments, like, mix, text_chunks

#: Labelled rows of each kind that the model is fitted and calibrated on, at most.
SAMPLE_PER_LABEL = 1500
#: A text stays if it is good with at least this probability.
KEEP_AT = 0.3
#: Base rules: a text fails below so many words, or above this percentage of words in repeated windows.
LEAST_WORDS, MOST_REPEATED = 50, 50

SYMBOLS = b"#*$%&|<>"
BUCKETS = 1 << 16
#: Bytes of sample texts that one set of arrays covers.
RUN_BYTES = 500_000
STEPS, RATE, RIDGE = 120, 0.3, 1e-4

SCHEMA = pa.schema(
    [(name, pa.int64()) for name in ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [("base_failed", pa.bool_()), ("kept", pa.bool_()), ("score", pa.float64())]
)
RESULT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, score double"
)


class Model(NamedTuple):
    """Weights by bucket, and the line that turns their sum into a calibrated logit."""

    word_weights: np.ndarray
    byte_weights: np.ndarray
    slope: float
    offset: float


def grams(text: TextArrays) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Buckets and text numbers of all word grams, and of all byte grams."""
    n = len(text.first_byte) - 1
    word_owner = np.repeat(np.arange(n), np.diff(text.first_word))
    one = text.word_hash
    same = word_owner[1:] == word_owner[:-1]
    two = mix(one[:-1] * np.uint64(3) + one[1:])[same]
    words = (np.concatenate([one, two]) >> np.uint64(48)).astype(np.int64)
    owners = np.concatenate([word_owner, word_owner[1:][same]])
    data = text.data.astype(np.uint32)
    window = data[:-3] | (data[1:-2] << 8) | (data[2:-1] << 16) | (data[3:] << 24)
    sizes = np.maximum(np.diff(text.first_byte) - 4, 0)  # windows that end before the separator
    at = np.arange(int(sizes.sum())) + np.repeat(text.first_byte[:-1] - bounds(sizes)[:-1], sizes)
    spread = (window[at] * np.uint32(0x9E3779B1)) >> np.uint32(16)
    return (words, owners), (spread.astype(np.int64), np.repeat(np.arange(n), sizes))


def mean_weight(weights: np.ndarray, buckets: np.ndarray, owners: np.ndarray, n: int) -> np.ndarray:
    total = np.bincount(owners, weights[buckets], n)
    return total / np.maximum(np.bincount(owners, minlength=n), 1)


def probability(model: Model, text: TextArrays) -> np.ndarray:
    n = len(text.first_byte) - 1
    by_word, by_byte = grams(text)
    raw = mean_weight(model.word_weights, *by_word, n) + mean_weight(model.byte_weights, *by_byte, n)
    return 1 / (1 + np.exp(-np.clip(model.slope * raw + model.offset, -50, 50)))


def _runs(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of about `RUN_BYTES`, each with the number of its first text; arrays over all would be large."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > RUN_BYTES:
            yield start, texts[start:i]
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, texts[start:]


def gram_shares(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets, of words and then of bytes, with a text's number and the share of its grams that they hold."""
    parts: tuple[list, list] = ([], [])
    for start, some in _runs(texts):
        for k, (buckets, owners) in enumerate(grams(TextArrays(some))):
            key, count = np.unique(owners * BUCKETS + buckets, return_counts=True)
            owner = key // BUCKETS
            share = count / np.bincount(owner, count, len(some))[owner]
            parts[k].append(((key % BUCKETS + k * BUCKETS).astype(np.int32), (owner + start).astype(np.int32), share))
    return tuple(np.concatenate(x) for x in zip(*parts[0], *parts[1], strict=True))


def fit(texts: list[bytes], labels: np.ndarray) -> Model:
    """Fit the weights on three quarters of the rows and calibrate on the rest."""
    fresh = np.arange(len(texts)) % 4 == 3
    model = Model(np.zeros(BUCKETS), np.zeros(BUCKETS), 0.0, 20.0)
    if len(set(labels[fresh])) < 2 or len(set(labels[~fresh])) < 2:
        return model  # both kinds are needed; all texts are good
    rows = [text for text, out in zip(texts, fresh, strict=True) if not out]
    feature, owner, share = gram_shares(rows)
    target = labels[~fresh].astype(float)
    balance = np.where(target == 1, 0.5 / target.mean(), 0.5 / (1 - target.mean()))
    weights, bias = np.zeros(2 * BUCKETS + 1), 2 * BUCKETS
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, STEPS + 1):
        z = np.bincount(owner, weights[feature] * share, len(rows)) + weights[bias]
        error = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - target) * balance / len(rows)
        gradient = np.append(np.bincount(feature, error[owner] * share, bias), error.sum())
        gradient[:bias] += RIDGE / len(rows) * weights[:bias]
        first += 0.1 * (gradient - first)
        second += 0.001 * (gradient**2 - second)
        # Adam.
        weights -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-12)
    model = Model(weights[:BUCKETS], weights[BUCKETS:bias], 1.0, float(weights[bias]))
    unseen = [text for text, out in zip(texts, fresh, strict=True) if out]
    p = np.concatenate([probability(model, TextArrays(some)) for _, some in _runs(unseen)])
    p = np.clip(p, 1e-12, 1 - 1e-12)
    slope, offset = calibrate(np.log(p / (1 - p)), labels[fresh])
    return Model(model.word_weights, model.byte_weights, slope, slope * model.offset + offset)


def calibrate(logit: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic fit to unseen logits, both kinds weighing the same."""
    good, bad = (labels == 1).sum(), (labels == 0).sum()
    # Targets short of 0 and 1 keep the fit finite when the kinds separate.
    target = np.where(labels == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    weight = np.where(labels == 1, 0.5 / good, 0.5 / bad)
    x = np.column_stack([logit, np.ones(len(logit))])
    line = np.array([0.1, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ line, -50, 50)))
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + 1e-9 * np.eye(2)
        move = np.linalg.solve(curve, x.T @ (weight * (p - target)))
        line -= move * min(1.0, 1.0 / max(1e-12, np.abs(move).max()))
    return max(float(line[0]), 1e-6), float(line[1])


def train(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL) -> Model:
    """Fit on the ``per_label`` labelled rows of each kind that a hash of the id puts first.

    The sample is bounded, and one task reads it.
    """
    chosen = None
    for quality in (0, 1):
        rows = labels.filter(F.col("quality") == quality).select(F.col("doc_id").cast("long").alias("doc_id"))
        first = rows.distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label)
        first = first.withColumn("label", F.lit(quality))
        chosen = first if chosen is None else chosen.unionByName(first)
    # At most two rows per chosen id, so the broadcast is bounded.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sample = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))

    def one(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([pd.DataFrame({"doc_id": [], "label": [], "text": []}), *frames])
        # An id that carries both labels says nothing; the order does not depend on the tasks before.
        rows = rows[~rows.duplicated("doc_id", keep=False)]
        order = np.argsort(mix(rows["doc_id"].to_numpy().astype(np.int64).astype(np.uint64)), kind="stable")
        rows = rows.iloc[order]
        texts = [(text or "").encode() for text in rows["text"]]
        yield pd.DataFrame({"model": [pickle.dumps(fit(texts, rows["label"].to_numpy().astype(int)))]})

    fitted = sample.repartition(1).mapInPandas(one, "model binary").first()
    return pickle.loads(fitted["model"]) if fitted else fit([], np.zeros(0, int))


def assess(texts: list[bytes], model: Model) -> dict[str, np.ndarray]:
    """Base counts, verdicts and scores of some texts."""
    text = TextArrays(texts)
    n = len(texts)
    n_words = np.diff(text.first_word)
    owner = np.repeat(np.arange(n), n_words)
    lead = (text.words & 0xC0) != 0x80
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    byte_owner = np.repeat(np.arange(n), np.diff(text.first_byte))
    n_dup_lines = []
    for one in texts:
        lines = [line for line in one.split(b"\n") if line.strip()]
        n_dup_lines.append(len(lines) - len(set(lines)))
    # Windows of three words, told apart by text as well; a repeated one marks its words.
    h = text.word_hash
    repeated = np.zeros(len(h), bool)
    if len(h) > 2:
        start = np.flatnonzero(owner[2:] == owner[:-2])
        window = mix(mix(h[start] * np.uint64(3) + h[start + 1]) * np.uint64(5) + h[start + 2])
        window = mix(window ^ mix(owner[start].astype(np.uint64) + np.uint64(1)))
        _, which, count = np.unique(window, return_inverse=True, return_counts=True)
        again = start[count[which] > 1]
        # Equal hashes only propose equal windows.
        _, kind = distinct_segments(text.words, bounds(text.lengths))
        found = np.column_stack([owner[again], kind[again], kind[again + 1], kind[again + 2]])
        _, which, count = np.unique(found, axis=0, return_inverse=True, return_counts=True)
        again = again[count[which.reshape(-1)] > 1]
        for k in range(3):
            repeated[again + k] = True
    n_repeat = np.bincount(owner, repeated, n).astype(np.int64)
    failed = (n_words < LEAST_WORDS) | (100 * n_repeat > MOST_REPEATED * n_words)
    score = probability(model, text)
    return {
        "n_words": n_words,
        "word_chars": np.bincount(np.repeat(owner, text.lengths), lead, n).astype(np.int64),
        "n_symbols": np.bincount(byte_owner, symbol[text.data], n).astype(np.int64),
        "n_dup_lines": np.array(n_dup_lines, np.int64),
        "n_repeat_words": n_repeat,
        "base_failed": failed,
        "kept": ~failed & (score >= KEEP_AT),
        "score": score,
    }


def assess_documents(docs: DataFrame, model: Model) -> DataFrame:
    """Counts and verdict of every document."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches):
            yield like({"doc_id": batch.column(0), **assess(texts, held.value)}, SCHEMA)

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, RESULT)


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches):
            yield batch.filter(pa.array(assess(texts, held.value)["kept"]))

    return docs.mapInArrow(run, docs.schema)
