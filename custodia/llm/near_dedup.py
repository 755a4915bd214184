"""Near duplicates by minhash, banding, exact verification, and connected components.

A document is its set of distinct shingles of lower-cased words. Universal hash
minima are cut into bands, and documents that agree in a band share a bucket.
Equal sets are one class, which only its lowest document stands for. In every
bucket one class, that with the lowest number, is the centre. Classes are checked on the full sets
against the centres of their buckets, first against the lowest one, then against
those whose component they have not joined, so a group of near copies costs about
one check for each of its classes.

Links make components. Only buckets whose classes are then still in several
components are looked at again. Their pivots are the classes of a component with the fewest shingles
that no other class in question has: of a group of near copies, the one most like what
they were copied from. All classes of the bucket are checked against it. What a class
shares with the pivot bounds what it can share with others, but for shingles that the
pivot lacks; those that most of its classes have count as if the pivot had them. So a pair
that is still apart is checked only if these shingles alone
could make it similar, or if it has enough others in common, by which it is found. So no
two classes of a bucket that are similar enough end in two components, and no group is
paired with itself.

Two documents at the threshold share no bucket with a probability of
(1 - similarity^rows)^bands, below 1 in a million for the defaults.

Defined results: null and empty texts, and texts without words, have an empty set
and are linked with nothing; a text with fewer words than a shingle is one shingle;
rows that share an id are one document; a row without an id is linked with nothing
and kept; an empty table gives an empty table; only the id and the text are read. Texts
are read whole. Classes are told apart by 128-bit digests of the words, links by the
words themselves. For `drop_near_copies`, which passes all columns on, a document is its
id and its text: different texts of one id are linked only if they are similar, texts
without an id like others, after which they come; of rows equal in both, one stays.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custodia.llm.common import TextArrays, mark_listed, mix, only_listed, small_batches, text_chunks, text_key
from custodia.llm.components import connected_components
from custodia.operators.keys import assign_ids
from custodia.storage import Staging, stage, staging

#: Minima per band, and bands.
ROWS, BANDS = 7, 64
#: Links have 100 * intersection >= PERCENT * union.
PERCENT = 80
SEED = 20_240_601

_CELL = 512


def shingle_hashes(text: TextArrays, words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    h, first = text.word_hash, text.first_word.tolist()
    rolled = h.copy()
    for k in range(1, words):
        left = max(0, len(h) - k)
        rolled[:left] = mix(rolled[:left] * np.uint64(2 * k + 1) + h[k:])
    out = []
    for start, end in zip(first[:-1], first[1:], strict=True):
        if end - start >= words:
            out.append(np.unique(rolled[start : end - words + 1]))
        elif end > start:
            whole = np.array([end - start], np.uint64)
            for k in range(start, end):
                whole = mix(whole * np.uint64(31) + h[k])
            out.append(whole)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


class MinHash:
    """Minima of multiply-add hashes modulo 2^64, combined by band."""

    def __init__(self, rows: int, bands: int):
        random = np.random.default_rng(SEED)
        self.rows, self.bands = rows, bands
        self.a = random.integers(0, 1 << 63, (rows * bands, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = random.integers(0, 1 << 63, (rows * bands, 1), dtype=np.uint64)

    def keys(self, hashes: np.ndarray) -> np.ndarray:
        """One key per band, which also depends on the band's number."""
        low = np.full(self.rows * self.bands, np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(hashes), _CELL):
            np.minimum(low, (self.a * hashes[at : at + _CELL] + self.b).min(axis=1), out=low)
        low = low.reshape(self.bands, self.rows)
        key = np.arange(1, self.bands + 1, dtype=np.uint64)
        for k in range(self.rows):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + low[:, k])
        return key.view(np.int64)


def _type(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def _batch(columns: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(columns, names)


def sign(docs: DataFrame, words: int, rows: int = ROWS, bands: int = BANDS) -> DataFrame:
    """Set size, digest of the words, and band keys of every document of (node, text); no digest without words."""
    minhash = MinHash(rows, bands)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches):
            sets = shingle_hashes(TextArrays(texts, lower=True), words)
            digests = [
                hashlib.blake2b(b" ".join(text.lower().split()), digest_size=16).digest() if len(s) else None
                for text, s in zip(texts, sets, strict=True)
            ]
            known: dict[bytes, np.ndarray] = {}
            for digest, s in zip(digests, sets, strict=True):
                if digest and digest not in known:
                    known[digest] = minhash.keys(s)
            sizes = pa.array([len(s) for s in sets], pa.int64())
            keys = pa.array([known[digest] if digest else None for digest in digests], pa.list_(pa.int64()))
            columns = [batch.column(0), sizes, pa.array(digests, pa.binary()), keys]
            yield _batch(columns, ["node", "n_shingles", "digest", "bands"])

    types = f"node {_type(docs, 'node')}, n_shingles long, digest binary, bands array<long>"
    return docs.select("node", "text").mapInArrow(run, types)


def hash_sets(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """The shingle hashes of some documents: head, the number of its set, hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches):
            sets = [s.view(np.int64) for s in shingle_hashes(TextArrays(texts, lower=True), words)]
            column = pa.array(sets, pa.list_(pa.int64()))
            yield _batch([batch.column(0), batch.column(1), column], ["head", "set_id", "hashes"])

    with staging(docs.sparkSession) as staged:
        numbered = staged.stage(assign_ids(ids.toDF("node").distinct(), "set_id"), "near-ids")
        rows = only_listed(docs.select("node", "text"), "node", numbered.select("node"), staged.stage)
        texts = rows.join(numbered, "node").select("node", "set_id", "text")
        types = f"head {_type(texts, 'node')}, set_id long, hashes array<long>"
        return stage(texts.mapInArrow(run, types), "near-sets")


def shared_shingles(sets: DataFrame) -> DataFrame:
    """Per document, how many of its shingles any other one has too: head, shared."""
    every = sets.select("set_id", F.explode("hashes").alias("hash"))
    owners = every.groupBy("hash").agg(F.min("set_id").alias("set_id"), F.max("set_id").alias("last"))
    alone = owners.filter("set_id = last").groupBy("set_id").agg(F.count("*").alias("alone"))
    sizes = sets.groupBy("set_id", "head").agg(F.sum(F.size("hashes")).alias("n"))
    joined = sizes.join(alone, "set_id", "left")
    return joined.select("head", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("shared"))


def shingle_set(text: bytes, words: int) -> set:
    """The shingles of a text, as tuples of words."""
    found = text.lower().split()
    if len(found) < words:
        return {tuple(found)} if found else set()
    return set(zip(*(found[k:] for k in range(words)), strict=False))


def check_pairs(pairs: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """Intersection and union sizes of pairs (a, b) of documents: a, b, both, either."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_text, held = None, set()
        for batch in batches:
            both, either = [], []
            one, two = (batch.column(k).cast(pa.large_binary()) for k in (2, 3))
            for x, y in zip(one, two, strict=True):
                x, y = x.as_py() or b"", y.as_py() or b""
                if y != held_text:
                    held_text, held = y, shingle_set(y, words)
                mine = shingle_set(x, words)
                n = len(mine & held)
                both.append(n)
                either.append(len(mine) + len(held) - n)
            columns = [batch.column(0), batch.column(1), pa.array(both, pa.int64()), pa.array(either, pa.int64())]
            yield _batch(columns, ["a", "b", "both", "either"])

    first = texts.select(F.col("node").alias("a"), F.col("text").alias("a_text"))
    second = texts.select(F.col("node").alias("b"), F.col("text").alias("b_text"))
    joined = pairs.join(first, "a").join(second, "b").select("a", "b", "a_text", "b_text")
    node = _type(texts, "node")
    return joined.mapInArrow(run, f"a {node}, b {node}, both long, either long")


def _texts(docs: DataFrame, pairs: DataFrame, staged: Staging) -> DataFrame:
    """Texts of the documents in some columns of nodes, and of a few others."""
    nodes = pairs.select(F.explode(F.array(*pairs.columns)).alias("node")).distinct()
    nodes = staged.stage(nodes, "near-ids")
    return only_listed(docs.select("node", "text"), "node", nodes, staged.stage)


def link(docs: DataFrame, words: int, percent: int = PERCENT, rows: int = ROWS, bands: int = BANDS) -> DataFrame:
    """Components of near copies of (node, text): node, n_shingles, component of every row."""
    with small_batches(docs.sparkSession), staging(docs.sparkSession) as staged:
        return _link(docs, words, percent, rows, bands, staged)


def _link(docs: DataFrame, words: int, percent: int, rows: int, bands: int, staged: Staging) -> DataFrame:
    signed = stage(assign_ids(sign(docs, words, rows, bands), "row_id"), "near-signed")
    with_node = signed.filter("digest IS NOT NULL AND node IS NOT NULL")
    # A class has the number of its head's row.
    first = with_node.groupBy("digest").agg(
        F.min(F.struct("node", "row_id")).alias("first"), F.first("n_shingles").alias("n")
    )
    classes = first.select("digest", F.col("first.row_id").alias("class_id"), F.col("first.node").alias("head"), "n")
    classes = stage(classes, "near-classes")
    heads = classes.select("class_id", "head", "n")
    copies = with_node.select("digest", "row_id", "node").join(classes.drop("n"), "digest").filter("row_id <> class_id")
    copies = stage(copies.select("row_id", F.col("node").alias("u"), F.col("head").alias("v")), "near-copies")

    # Buckets of two classes or more, each with its centre. There is a row for every band, so rows are numbers only.
    others = copies.select("row_id")
    marked = mark_listed(with_node.select("row_id", "bands"), "row_id", others, staged.stage)
    apart = marked.filter("NOT listed").unionByName(marked.filter("listed").join(others, "row_id", "left_anti"))
    keyed = apart.select(F.col("row_id").alias("class_id"), F.explode("bands").alias("bucket"))
    centres = keyed.groupBy("bucket").agg(F.min("class_id").alias("centre"), F.count("*").alias("n_classes"))
    centres = stage(centres.filter("n_classes > 1").drop("n_classes"), "near-centres")
    shared = only_listed(keyed, "bucket", centres.select("bucket"), staged.stage)
    numbered = stage(shared.join(centres, "bucket"), "near-numbered")
    members = stage(numbered.join(heads, "class_id").select("bucket", "head", "n"), "near-members")
    # Most texts share no bucket, and only the others are looked at from here on.
    nodes = staged.stage(members.select(F.col("head").alias("node")).distinct(), "near-ids")
    texts = only_listed(docs.select("node", "text"), "node", nodes, staged.stage)
    docs = staged.stage(texts.join(nodes, "node", "left_semi"), "near-texts")

    # First everything against its lowest centre.
    found = Links(docs, words, percent, copies.select("u", "v"))
    lowest = numbered.filter("class_id <> centre").groupBy("class_id").agg(F.min("centre").alias("centre"))
    centre_heads = heads.select(F.col("class_id").alias("centre"), F.col("head").alias("centre_head"))
    pairs = lowest.join(heads, "class_id").join(centre_heads, "centre").filter("head <> centre_head")
    pair = [F.greatest("head", "centre_head").alias("a"), F.least("head", "centre_head").alias("b")]
    found.check(pairs.select(*pair).distinct())
    inside, sets = _against_pivots(found, members)
    found.check(_left(found, inside, sets, staged))
    label = found.components.select("node", "component")
    return signed.join(label, "node", "left").select(
        "node", "n_shingles", F.coalesce("component", "node").alias("component")
    )


class Links:
    """Links found so far, and the components that they make."""

    def __init__(self, docs: DataFrame, words: int, percent: int, copies: DataFrame):
        self.docs, self.words, self.percent = docs, words, percent
        self.links, self.checked, self.components = copies, None, None

    def check(self, pairs: DataFrame) -> None:
        """Check pairs (a, b) of classes, those that are new, and join the components of similar ones."""
        todo = pairs if self.checked is None else pairs.join(self.checked, ["a", "b"], "left_anti")
        todo = stage(todo, "near-todo")
        if todo.isEmpty() and self.checked is not None:
            return
        with staging(todo.sparkSession) as staged:
            new = stage(check_pairs(todo, _texts(self.docs, todo, staged), self.words), "near-checked")
        self.checked = new if self.checked is None else self.checked.unionByName(new)
        near = new.filter(f"either > 0 AND both * 100 >= either * {self.percent}")
        self.links = self.links.unionByName(near.select(F.col("a").alias("u"), F.col("b").alias("v")))
        self.components = stage(connected_components(self.links), "near-components")

    def component_of(self, rows: DataFrame, node: str, name: str) -> DataFrame:
        """Adds the component of a column of nodes; a node without links is its own."""
        of = self.components.select(F.col("node").alias("_node"), F.col("component").alias("_component"))
        joined = rows.join(of, F.col(node) == F.col("_node"), "left")
        return joined.withColumn(name, F.coalesce("_component", node)).drop("_node", "_component")


def _open(found: Links, members: DataFrame) -> DataFrame:
    """Classes of the buckets that still hold several components, with their components."""
    placed = found.component_of(members.drop("component"), "head", "component")
    components = placed.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    open_ = stage(components.filter("low <> high").select("bucket"), "near-open")
    return stage(placed.join(open_, "bucket", "left_semi"), "near-inside")


def _against_pivots(found: Links, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Check the classes of every open bucket against its pivot; returns them, and the hash sets of all in question.

    Adds ``shared``, how many of a class's shingles any other one in question has, the
    pivot, and ``common``, how many of them that has.
    """
    inside = _open(found, members)
    sets = hash_sets(found.docs, inside.select("head").distinct(), found.words)
    inside = stage(inside.join(stage(shared_shingles(sets), "near-shared"), "head"), "near-inside")
    score = F.struct(F.col("shared") / F.col("n"), F.xxhash64("head"))
    central = inside.groupBy("bucket").agg(F.max_by("component", score).alias("central"))
    best = inside.groupBy(F.col("component").alias("central")).agg(F.max_by("head", score).alias("pivot"))
    pivots = stage(central.join(best, "central").select("bucket", "pivot"), "near-pivots")
    inside = inside.join(pivots, "bucket")
    pair = [F.greatest("head", "pivot").alias("a"), F.least("head", "pivot").alias("b")]
    found.check(inside.filter("head <> pivot").select(*pair).distinct())
    both = found.checked.groupBy("a", "b").agg(F.max("both").alias("common"))
    joined = inside.select("*", *pair).join(stage(both, "near-both"), ["a", "b"], "left").drop("a", "b")
    # A pivot shares all of its own.
    return stage(joined.withColumn("common", F.coalesce("common", "n")), "near-inside"), sets


def _left(found: Links, members: DataFrame, sets: DataFrame, staged: Staging) -> DataFrame:
    """Pairs (a, b) of a bucket in different components that may yet be similar.

    What two classes share is at most what the pivot has of the one with less of it, and
    what both have beyond the pivot. So a pair either needs nothing beyond, or has some
    shingle beyond the pivot in common, by which it is found. This holds for any set of
    shingles, so the pivot gets those that most of its classes have. At least one of the
    pair is not in the pivot's component.
    """
    placed = found.component_of(members.drop("component"), "head", "component")
    placed = found.component_of(placed, "pivot", "central")
    inside = placed.withColumn("outside", F.col("component") != F.col("central"))
    per_bucket = inside.groupBy("bucket").agg(
        F.min("n").alias("least_n"), F.max("shared").alias("most_shared"), F.max("outside").alias("open")
    )
    # A bucket has a class of its pivot's component, so it is open if any class is outside of that.
    bounds = staged.stage(per_bucket.filter("open").drop("open"), "near-bounds")
    held = inside.join(bounds, "bucket")

    def similar(common: str, n: str) -> str:
        return f"({common}) * 100 >= ({n} - ({common})) * {found.percent}"

    # A similar class has at least `percent` hundredths of a class's size, and as many as they share.
    most = "least(shared, most_shared)"
    smallest = f"greatest(least_n, n * {found.percent} / 100, {most})"
    held = held.filter(similar(most, f"n + {smallest}"))
    columns = ["bucket", "pivot", "head", "n", "component", "common", "outside", "least_n"]
    may = staged.stage(held.select(*columns), "near-may")
    # Buckets of which all that may be similar to something is in the pivot's component are done. The others are read often.
    left = staged.stage(may.filter("outside").select("bucket").distinct(), "near-left")
    may = staged.stage(may.join(left, "bucket", "left_semi"), "near-may")
    pair = [F.greatest("head", "x_head").alias("a"), F.least("head", "x_head").alias("b")]

    def outer(rows: DataFrame, *key: str) -> DataFrame:
        renamed = [F.col(c).alias(f"x_{c}") for c in ("head", "n", "component", "common")]
        return rows.filter("outside").select(*key, *renamed)

    # Shingles beyond the pivot.
    placed = may.select("pivot", "head", "n", "component", "common", "outside").distinct()
    heads, centres = (staged.stage(may.select(c).distinct(), "near-ids") for c in ("head", "pivot"))
    own = placed.join(only_listed(sets, "head", heads, staged.stage), "head")
    pivots = only_listed(sets, "head", centres, staged.stage)
    pivots = pivots.select(F.col("head").alias("pivot"), F.col("hashes").alias("pivot_hashes"))
    beyond = own.join(pivots, "pivot").select(
        *placed.columns, F.explode(F.array_except("hashes", "pivot_hashes")).alias("hash")
    )
    every = staged.stage(beyond, "near-beyond")
    # Those of most of its classes are what the pivot itself lost, and count as if it had them.
    key = ["pivot", "hash"]
    several = every.groupBy(*key).agg(F.count("*").alias("n_with"), F.max("outside").alias("outside"))
    of_pivot = staged.stage(placed.groupBy("pivot").agg(F.count("*").alias("n_all")), "near-sizes")
    several = several.filter("n_with > 1 AND outside").drop("outside").join(of_pivot, "pivot")
    several = staged.stage(several.select(*key, F.expr("n_with * 2 > n_all").alias("lost")), "near-several")
    beyond = staged.stage(every.join(several, key), "near-beyond")
    more = staged.stage(beyond.filter("lost").groupBy("pivot", "head").agg(F.count("*").alias("more")), "near-more")

    def with_more(rows: DataFrame) -> DataFrame:
        joined = rows.join(more, ["pivot", "head"], "left")
        return joined.withColumn("common", F.col("common") + F.coalesce("more", F.lit(0))).drop("more")

    # Pairs that need nothing beyond that.
    near = with_more(may).filter(similar("common", f"n + greatest(least_n, n * {found.percent} / 100, common)"))
    near = staged.stage(near, "near-enough")
    met = outer(near, "bucket").join(near, "bucket").filter(
        f"component <> x_component AND {similar('least(x_common, common)', 'x_n + n')}"
    )

    # Pairs with shingles in common beyond it.
    beyond = staged.stage(with_more(beyond.filter("NOT lost").drop("lost")), "near-beyond")
    also = outer(beyond, *key).join(beyond, key).filter("component <> x_component")
    columns = ["pivot", "x_head", "head", "x_n", "n", "x_common", "common"]
    counted = also.groupBy(*columns).agg(F.count("*").alias("n_beyond"))
    counted = counted.filter(similar("least(x_common, common) + n_beyond", "x_n + n"))
    return met.select(*pair).unionByName(counted.select(*pair)).distinct()


def near_duplicates(docs: DataFrame, words: int, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and whether the document is the lowest of its component."""
    linked = link(docs.select(F.col("doc_id").cast("long").alias("node"), "text"), words, percent)
    kept = F.coalesce(F.col("node") == F.col("component"), F.lit(True))
    return linked.select(
        F.col("node").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), kept.alias("kept")
    )


def drop_near_copies(docs: DataFrame, words: int, percent: int = PERCENT) -> DataFrame:
    """One document of each component, the lowest, with all its columns."""
    doc_id = F.col("doc_id").cast("long")
    node = F.struct(doc_id.isNull().alias("no_id"), doc_id.alias("doc_id"), text_key().alias("text_key"))
    rows = docs.select(F.struct("*").alias("row"), node.alias("node"), "text")
    linked = link(rows.select("node", "text"), words, percent)
    nodes = linked.groupBy("node").agg(F.min("component").alias("component"), F.count("*").alias("n"))
    decided = stage(nodes.filter("node <> component OR n > 1"), "near-decided")
    # Rows that nothing was decided about stay where they are.
    marked = mark_listed(rows.select("row", "node"), "node", decided.select("node"))
    left = marked.filter("listed").join(decided.filter("node <> component").select("node"), "node", "left_anti")
    again = decided.filter("node = component").select("node")
    if not again.isEmpty():
        # Rows that are equal in id and text.
        one = left.join(again, "node", "left_semi").groupBy("node").agg(F.first("row").alias("row"))
        left = left.join(again, "node", "left_anti").select("row").unionByName(one.select("row"))
    return marked.filter("NOT listed").select("row.*").unionByName(left.select("row.*"))
