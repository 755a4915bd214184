"""Helpers shared by the operators: table access, byte-level text arrays, packed columns."""

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from custodia.storage import stage

#: The white space of all word definitions here, as characters.
WHITE = " \t\n\x0b\x0c\r"
#: White space between words, for Spark's regular expressions.
WHITE_RUN = r"[\x20\x09-\x0D]+"
#: A word, for Spark's regular expressions.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that one set of numpy arrays covers; longer single texts get a set of their own.
CHUNK_BYTES = 1_000_000

#: Bytes of a batch of rows that hold several texts each.
BATCH_BYTES = 4_000_000

#: Bits for each key of a bitmap of keys, bits of all at most (8 MB), and bits of a page of it.
KEY_BITS, MOST_KEY_BITS, PAGE_BITS = 16, 1 << 26, 1 << 15

_IS_WHITE = np.zeros(256, bool)
_IS_WHITE[list(WHITE.encode())] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def n_words(text: str | Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_chunks(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES
) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of record batches with their texts as UTF-8, null as empty, of about ``limit`` bytes at most."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary())
        sizes = np.diff(np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1])
        start = held = 0
        for i, size in enumerate(sizes.tolist()):
            if held and held + size > limit:
                yield batch.slice(start, i - start), _bytes(texts, start, i)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start), _bytes(texts, start, batch.num_rows)


def _bytes(texts: pa.Array, start: int, end: int) -> list[bytes]:
    return [text or b"" for text in texts[start:end].to_pylist()]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (one to one)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bounds(counts: np.ndarray) -> np.ndarray:
    """Where each of consecutive runs starts, and where the last one ends."""
    out = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=out[1:])
    return out


def segment_hash(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hashes of consecutive, non-empty segments of bytes that cover ``values``.

    Eight bytes at a time are mixed with a key of their place and summed up. Different
    segments may share a hash; see `distinct_segments`.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    n_lanes = (lengths + 7) // 8
    first = bounds(n_lanes)
    padded = np.zeros(int(first[-1]) * 8, np.uint8)
    padded[np.arange(len(values)) + np.repeat(first[:-1] * 8 - starts, lengths)] = values
    place = np.arange(int(first[-1])) - np.repeat(first[:-1], n_lanes)
    keys = mix(np.arange(1, int(n_lanes.max()) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    terms = mix(padded.view("<u8") ^ keys[place])
    return mix(np.add.reduceat(terms, first[:-1]) + lengths.astype(np.uint64))


def distinct_segments(values: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of consecutive, non-empty segments are equal: a segment of each kind, and the kind of each segment.

    Equal hashes only propose equal segments; their bytes are compared.
    """
    starts, lengths = cuts[:-1], np.diff(cuts)
    hashes = segment_hash(values, starts, lengths)
    _, sample, kind = np.unique(hashes, return_index=True, return_inverse=True)
    if not len(starts):
        return sample, kind
    model = sample[kind]
    at = np.arange(len(values)) + np.repeat(starts[model] - starts, lengths)
    unequal = values[np.minimum(at, len(values) - 1)] != values
    odd = np.flatnonzero((lengths[model] != lengths) | np.logical_or.reduceat(unequal, starts))
    if len(odd):
        kinds: dict[bytes, int] = {}
        more = []
        for i in odd.tolist():
            segment = values[starts[i] : starts[i] + lengths[i]].tobytes()
            if segment not in kinds:
                kinds[segment] = len(sample) + len(more)
                more.append(i)
            kind[i] = kinds[segment]
        sample = np.append(sample, more)
    return sample, kind


class TextArrays:
    """The words of some texts as flat arrays.

    ``word_hash`` has all words' hashes in order; those of text ``i`` are at
    ``first_word[i]`` up to ``first_word[i + 1]``. A text without words has none.
    """

    def __init__(self, texts: Sequence[bytes], lower: bool = False):
        # The separator is white space, so no word crosses from one text to the next.
        data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
        if lower:
            data = _LOWER[data]
        sizes = np.fromiter((len(text) + 1 for text in texts), np.int64, len(texts))
        self.data, self.first_byte = data, bounds(sizes)
        inside = ~_IS_WHITE[data]
        edges = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
        self.starts, ends = edges[0::2], edges[1::2]
        self.lengths = ends - self.starts
        self.first_word = np.searchsorted(self.starts, self.first_byte)
        self.words = data[inside]
        self.word_hash = segment_hash(self.words, bounds(self.lengths)[:-1], self.lengths)


@contextmanager
def small_batches(spark: SparkSession, limit: int = BATCH_BYTES) -> Iterator[None]:
    """Jobs run in here pass rows to Python in batches of about ``limit`` bytes; buffers for large ones stay allocated."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(limit))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def like(columns: dict[str, object], schema: pa.Schema) -> pa.RecordBatch:
    """A record batch of a schema from sequences by column."""
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def text_key(text: str = "text") -> Column:
    """A 64-bit hash that tells rows with one id and different texts apart."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def mark_listed(
    rows: DataFrame, column: str, keys: DataFrame, put: Callable[[DataFrame, str], DataFrame] = stage
) -> DataFrame:
    """Adds ``listed``, which is false only for rows whose key is not among the keys, a written table of one column.

    A bitmap of hashed keys goes to every task, so that of wide rows only those with a
    listed key, and a few others, need to move to be joined with the keys. More keys than
    the bitmap has bits for let more rows pass. Both columns need the same type; ``put``
    writes the bitmap.
    """
    n_bits = min(MOST_KEY_BITS, max(PAGE_BITS, KEY_BITS * keys.count()))

    def place(key: str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(n_bits).cast("long"))

    spots = keys.select(place(keys.columns[0]).alias("_at"))
    spots = spots.select(F.expr(f"_at div {PAGE_BITS}").alias("_page"), F.expr(f"_at % {PAGE_BITS}").alias("_bit"))
    # Keys move rather than a page of each task.
    pages = spots.repartition("_page").groupBy("_page").agg(F.expr("bitmap_construct_agg(_bit)").alias("_bits"))
    pages = F.broadcast(put(pages, "listed"))
    placed = rows.withColumn("_at", place(column)).withColumn("_page", F.expr(f"_at div {PAGE_BITS}"))
    byte = f"conv(hex(substring(_bits, int(_at % {PAGE_BITS} div 8) + 1, 1)), 16, 10)"
    listed = F.expr(f"coalesce(int({byte}) & shiftleft(1, int(_at % 8)), 0) <> 0")
    return placed.join(pages, "_page", "left").select(*(rows[c] for c in rows.columns), listed.alias("listed"))


def only_listed(
    rows: DataFrame, column: str, keys: DataFrame, put: Callable[[DataFrame, str], DataFrame] = stage
) -> DataFrame:
    """The rows whose key may be among the keys; see `mark_listed`."""
    return mark_listed(rows, column, keys, put).filter("listed").drop("listed")


def keep_rows(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """The rows of a table that a decision keeps, with all columns.

    ``decided`` has doc_id, text_key, kept and the unit (group) of every row. Only
    dropped keys are joined, so kept texts move no more than they must. Of rows
    kept in one unit under one id, one stays; rows without an id all stay.
    """
    decided = decided.filter("doc_id IS NOT NULL")
    kept = decided.filter("kept").groupBy("doc_id", "unit")
    again = kept.agg(F.count("*").alias("n"), F.min("text_key").alias("stays")).filter("n > 1")
    again = stage(again, "repeated-rows")
    losers = decided.join(again, ["doc_id", "unit"]).filter("kept AND text_key <> stays")
    dropped = decided.filter("NOT kept").select("doc_id", "text_key").unionByName(losers.select("doc_id", "text_key"))
    dropped = stage(dropped.distinct(), "dropped-rows")
    rows = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key")
    )
    key = ["doc_id", "text_key"]
    left = rows.join(dropped, key, "left_anti")
    if not again.isEmpty():
        # A unit's kept rows that are equal in id and text.
        equal = again.select("doc_id", F.col("stays").alias("text_key")).distinct()
        one = left.join(equal, key, "left_semi").groupBy(*key).agg(F.first("row").alias("row"))
        left = left.join(equal, key, "left_anti").select("row").unionByName(one.select("row"))
    return left.select("row.*")
