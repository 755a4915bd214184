"""Quality classifier: a sparse rule ensemble over text statistics.

Boosted shallow trees propose rules, each a conjunction of thresholds on
statistics. A lasso logistic regression weighs the rules and drops most. What is
left is compiled into Spark columns, so every text is scored by expressions.

Defined results: a null or empty text has all statistics 0 and is scored like
any other; equal texts get equal scores; an empty table gives an empty table;
without training rows of both kinds every score is 0.5; only the id and the text
of a table are read, so further columns cannot reach a score. Texts are read whole.
"""

from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custodia.llm.common import WHITE_RUN, WORD

#: Labelled rows of each kind that the rules are learned from, at most.
SAMPLE_PER_LABEL = 3000
#: A text is called good from this score on.
GOOD_AT = 0.7
#: Rows whose checksum of the id leaves this remainder are never learned from.
FOLDS, HELD_OUT = 4, 2

TREES, DEPTH, LEAF, SHRINK, CUTS = 30, 3, 20, 0.3, 32
LASSO, LASSO_STEPS = 2e-3, 2000

def statistics(text: str = "text") -> dict[str, Column]:
    """Numbers that describe a text."""
    body = F.coalesce(F.col(text), F.lit(""))
    n_chars = F.char_length(body)
    words = F.regexp_count(body, F.lit(WORD))
    lines = F.split(body, "\n")

    def count(kind: str) -> Column:
        return F.regexp_count(body, F.lit(kind))

    def share(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part / whole).otherwise(0.0)

    return {
        "log_words": F.log1p(words),
        "word_length": share(F.char_length(F.regexp_replace(body, WHITE_RUN, "")), words),
        "symbols": share(count(r"[#*$%&|<>]"), n_chars),
        "marks": share(count(r"[!?]"), n_chars),
        "stops": share(count(r"[.,;:]"), n_chars),
        "upper": share(count(r"\p{Lu}"), n_chars),
        "digits": share(count(r"[0-9]"), n_chars),
        "fresh_words": share(F.size(F.array_distinct(F.split(body, WHITE_RUN))), words),
        "fresh_lines": share(F.size(F.array_distinct(lines)), F.size(lines)),
        "line_words": share(words, F.size(lines)),
    }


class Rule(NamedTuple):
    """A conjunction: each part is a statistic's number, whether it must lie above, and the threshold."""

    parts: frozenset[tuple[int, bool, float]]

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for feature, above, cut in self.parts:
            out &= (x[:, feature] > cut) == above
        return out

    def column(self, names: list[str]) -> Column:
        out = F.lit(True)
        for feature, above, cut in sorted(self.parts):
            name = F.col(names[feature])
            out = out & (name > cut if above else name <= cut)
        return out


def _split(x: np.ndarray, residual: np.ndarray, weight: np.ndarray, cuts: list[np.ndarray]):
    """The statistic and threshold that explain most of the weighted residual."""
    best = (1e-9, None, None)
    total, mass = (residual * weight).sum(), weight.sum()
    for feature, values in enumerate(cuts):
        for cut in values:
            low = x[:, feature] <= cut
            n = low.sum()
            if n < LEAF or len(x) - n < LEAF:
                continue
            s, m = (residual[low] * weight[low]).sum(), weight[low].sum()
            gain = s**2 / m + (total - s) ** 2 / (mass - m) - total**2 / mass
            if gain > best[0]:
                best = (gain, feature, float(cut))
    return best[1:]


def _grow(x, residual, weight, cuts, rows, parts, depth, rules, leaves) -> None:
    feature, cut = (None, None)
    if depth:
        feature, cut = _split(x[rows], residual[rows], weight[rows], cuts)
    if feature is None:
        leaves.append((rows, np.average(residual[rows], weights=weight[rows])))
        return
    low = x[rows, feature] <= cut
    for above, chosen in ((False, rows[low]), (True, rows[~low])):
        path = parts | {(feature, above, cut)}
        rules.add(Rule(path))
        _grow(x, residual, weight, cuts, chosen, path, depth - 1, rules, leaves)


def propose_rules(x: np.ndarray, target: np.ndarray, weight: np.ndarray, seed: int = 7) -> list[Rule]:
    """All tree paths of a boosted ensemble, each tree grown on a seeded half of the rows."""
    random = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, CUTS + 1)[:-1])) for f in range(x.shape[1])]
    rules: set[Rule] = set()
    z = np.zeros(len(x))
    for _ in range(TREES):
        residual = target - 1 / (1 + np.exp(-z))
        rows = np.sort(random.permutation(len(x))[: max(2 * LEAF, len(x) // 2)])
        found: set[Rule] = set()
        leaves: list = []
        _grow(x, residual, weight, cuts, rows, frozenset(), DEPTH, found, leaves)
        rules |= found
        # The tree's own step, on every row, by its leaves' paths.
        paths = [rule for rule in found if not any(rule.parts < other.parts for other in found)]
        for rule in paths:
            held = rule.holds(x)
            if held.any():
                z[held] += SHRINK * 4 * np.average(residual[held], weights=weight[held])
    return sorted(rules, key=lambda rule: (len(rule.parts), sorted(rule.parts)))


def lasso(held: np.ndarray, target: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Sparse logistic weights of 0/1 columns, by accelerated proximal gradient, and the intercept."""
    scale = np.maximum(held.std(axis=0), 1e-3)
    x = (held - held.mean(axis=0)) / scale
    weight = weight / weight.sum()
    step = 4 / max(1e-9, np.linalg.eigvalsh((x * weight[:, None]).T @ x)[-1] + 1)
    w = look = np.zeros(x.shape[1])
    b = look_b = 0.0
    pace = 1.0
    for _ in range(LASSO_STEPS):
        error = (1 / (1 + np.exp(-np.clip(x @ look + look_b, -50, 50))) - target) * weight
        new = look - step * (x.T @ error)
        new = np.sign(new) * np.maximum(np.abs(new) - step * LASSO, 0)
        new_b = look_b - step * error.sum()
        next_pace = (1 + np.sqrt(1 + 4 * pace**2)) / 2
        look = new + (pace - 1) / next_pace * (new - w)
        look_b = new_b + (pace - 1) / next_pace * (new_b - b)
        moved = np.abs(new - w).max()
        w, b, pace = new, new_b, next_pace
        if moved < 1e-7:
            break
    return w / scale, b - float((w / scale) @ held.mean(axis=0))


class RuleModel(NamedTuple):
    """Rules with their weights; the score is the logistic function of their sum and the intercept."""

    names: list[str]
    rules: list[tuple[Rule, float]]
    intercept: float

    def column(self) -> Column:
        """The score as an expression over columns that hold the statistics."""
        z = F.lit(self.intercept)
        for rule, weight in self.rules:
            z = z + F.when(rule.column(self.names), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.intercept)
        for rule, weight in self.rules:
            z = z + np.where(rule.holds(x), weight, 0.0)
        return 1 / (1 + np.exp(-z))


def learn(x: np.ndarray, target: np.ndarray, names: list[str]) -> RuleModel:
    if len(set(target)) < 2:
        return RuleModel(names, [], 0.0)
    # Both kinds weigh the same.
    weight = np.where(target == 1, 0.5 / target.mean(), 0.5 / (1 - target.mean()))
    rules = propose_rules(x, target, weight)
    if not rules:
        return RuleModel(names, [], 0.0)
    held = np.column_stack([rule.holds(x) for rule in rules]).astype(float)
    weights, intercept = lasso(held, target, weight)
    kept = [(rule, float(w)) for rule, w in zip(rules, weights, strict=True) if w]
    return RuleModel(names, kept, intercept)


def fold(doc_id: str = "doc_id") -> Column:
    """The remainder that decides who is held out."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(FOLDS))


def train(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL) -> RuleModel:
    """Learn from the ``per_label`` labelled rows of each kind, none held out, that a hash of the id puts first.

    The driver receives only that many rows of statistics.
    """
    chosen = None
    for quality in (0, 1):
        rows = labels.filter(F.col("quality") == quality).select(F.col("doc_id").cast("long").alias("doc_id"))
        first = rows.filter(fold() != HELD_OUT).distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label)
        first = first.withColumn("label", F.lit(quality))
        chosen = first if chosen is None else chosen.unionByName(first)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # At most two rows per chosen id, so the broadcast is bounded.
    sample = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    stats = statistics()
    rows = sample.select("doc_id", "label", *[column.cast("double").alias(name) for name, column in stats.items()])
    found = rows.toPandas().drop_duplicates("doc_id", keep=False).sort_values("doc_id")
    return learn(found[list(stats)].to_numpy(float), found["label"].to_numpy(float), list(stats))


def score_documents(docs: DataFrame, model: RuleModel) -> DataFrame:
    """doc_id, held_out, score and predicted class of every document."""
    stats = statistics()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    numbers = rows.select("doc_id", *[column.cast("double").alias(name) for name, column in stats.items()])
    scored = numbers.select("doc_id", (fold() == HELD_OUT).alias("held_out"), model.column().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= GOOD_AT).cast("int"))
