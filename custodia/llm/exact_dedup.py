"""Exact deduplication by counting quotient filters and byte verification.

Every partition builds a counting quotient filter of its texts' 64-bit
fingerprints: the high bits of a fingerprint are the quotient, the low bits the
remainder, and a run of sorted remainders with counts is held per quotient. The
filters hold whole fingerprints, so merging sorted runs loses nothing. Texts
whose merged count is above one go on to a comparison of all their bytes; all
others are unique.

Defined results: a null text is an empty one; texts of white space only are equal
to the empty one; a row without an id is kept, but counts in its group, and stays
for it if it is the longest; rows that repeat id and text are marked alike in
`duplicates`, and `drop_copies` keeps one of them; an empty table gives an empty
table; only the id and the text are read, and `drop_copies` passes all columns on.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custodia.llm.common import WHITE_RUN, bounds, keep_rows, text_key
from custodia.storage import stage

#: Rows whose fingerprints one block of quotients holds in the merged filter, about.
BLOCK_ROWS = 20_000
#: Quotients of a block, as bits.
RUN_BITS = 12

FILTER = "block long, quotients binary, remainders binary, counts binary"


class QuotientFilter:
    """The runs of one block: for each quotient in use, sorted remainders with counts.

    The run of ``quotients[i]`` is ``remainders[first[i]:first[i + 1]]``.
    """

    def __init__(self, quotients: np.ndarray, lengths: np.ndarray, remainders: np.ndarray, counts: np.ndarray):
        self.quotients, self.lengths, self.remainders, self.counts = quotients, lengths, remainders, counts

    @classmethod
    def of(cls, keys: np.ndarray, counts: np.ndarray, remainder_bits: int) -> "QuotientFilter":
        """From sorted distinct keys (quotient above remainder) and their counts."""
        bits = np.uint64(remainder_bits)
        quotients, lengths = np.unique((keys >> bits).astype(np.uint16), return_counts=True)
        remainders = keys & ((np.uint64(1) << bits) - np.uint64(1))
        return cls(quotients, lengths.astype(np.uint32), remainders, counts.astype(np.uint64))

    def keys(self, remainder_bits: int) -> np.ndarray:
        return (np.repeat(self.quotients, self.lengths).astype(np.uint64) << np.uint64(remainder_bits)) | self.remainders

    def pack(self) -> dict[str, bytes]:
        runs = np.column_stack([self.quotients.astype(np.uint32), self.lengths]).astype("<u4")
        return {
            "quotients": runs.tobytes(),
            "remainders": self.remainders.astype("<u8").tobytes(),
            "counts": self.counts.astype("<u8").tobytes(),
        }

    @classmethod
    def unpack(cls, quotients: bytes, remainders: bytes, counts: bytes) -> "QuotientFilter":
        runs = np.frombuffer(quotients, "<u4").reshape(-1, 2)
        return cls(
            runs[:, 0].astype(np.uint16), runs[:, 1], np.frombuffer(remainders, "<u8"), np.frombuffer(counts, "<u8")
        )

    @staticmethod
    def merge(filters: list["QuotientFilter"], remainder_bits: int) -> "QuotientFilter":
        """Runs of equal quotients merge in the order of remainders; equal remainders add their counts."""
        keys = np.concatenate([f.keys(remainder_bits) for f in filters])
        counts = np.concatenate([f.counts for f in filters])
        order = np.argsort(keys, kind="stable")  # sorted runs: a merge
        keys, first = np.unique(keys[order], return_index=True)
        return QuotientFilter.of(keys, np.add.reduceat(counts[order], first) if len(first) else counts, remainder_bits)


def fingerprint_filters(prints: DataFrame, block_bits: int) -> DataFrame:
    """One filter per partition of a column of fingerprints, cut into blocks by the highest bits."""
    rest = 64 - block_bits
    remainder_bits = max(0, rest - RUN_BITS)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            new = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            every = np.concatenate([held, new])
            weight = np.concatenate([counts, np.ones(len(new), np.int64)])
            held, which = np.unique(every, return_inverse=True)
            counts = np.bincount(which, weight).astype(np.int64)
        blocks = (held >> np.uint64(rest)) if block_bits else np.zeros(len(held), np.uint64)
        numbers, sizes = np.unique(blocks, return_counts=True)
        cuts = bounds(sizes)
        packed = []
        for number, start, end in zip(numbers.tolist(), cuts[:-1], cuts[1:], strict=True):
            keys = held[start:end] & np.uint64((1 << rest) - 1)
            packed.append({"block": number} | QuotientFilter.of(keys, counts[start:end], remainder_bits).pack())
        schema = pa.schema([("block", pa.int64()), *((n, pa.binary()) for n in ("quotients", "remainders", "counts"))])
        yield pa.RecordBatch.from_pylist(packed, schema)

    return prints.mapInArrow(build, FILTER)


def merge_filters(filters: DataFrame, block_bits: int) -> DataFrame:
    """Fingerprints with their counts over all partitions: fingerprint, n."""
    rest = 64 - block_bits
    remainder_bits = max(0, rest - RUN_BITS)

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        parts = [QuotientFilter.unpack(*row) for row in rows[["quotients", "remainders", "counts"]].itertuples(index=False)]
        whole = QuotientFilter.merge(parts, remainder_bits)
        high = np.uint64(int(rows["block"].iloc[0]) << rest if block_bits else 0)
        keys = whole.keys(remainder_bits) | high
        return pd.DataFrame({"fingerprint": keys.view(np.int64), "n": whole.counts.astype(np.int64)})

    return filters.groupBy("block").applyInPandas(merge, "fingerprint long, n long")


def normalised(text: str = "text") -> Column:
    """The text without white space; empty for null."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), WHITE_RUN, "")


def repeated_fingerprints(docs: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Fingerprints of more than one row, from the merged filter."""
    blocks = max(1, docs.count() // block_rows)
    block_bits = min(40, max(0, (blocks - 1).bit_length()))
    prints = docs.select(F.xxhash64(normalised()).alias("fingerprint"))
    merged = merge_filters(fingerprint_filters(prints, block_bits), block_bits)
    return merged.filter("n > 1").select("fingerprint")


def duplicates(docs: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 and text_key of every row."""
    repeated = stage(repeated_fingerprints(docs, block_rows), "repeated")
    bare = normalised()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", bare.alias("bare"))
    # Equal bytes only come together here. Copies are summed up where they are read, so a text of
    # any number of copies moves once per task, and the join's hot fingerprints can be split.
    suspects = rows.withColumn("fingerprint", F.xxhash64("bare")).join(repeated, "fingerprint", "left_semi")
    length = F.char_length(F.coalesce("text", F.lit("")))
    first = F.min(F.struct((-length).alias("length"), F.col("doc_id").isNull().alias("no_id"), "doc_id"))
    verified = suspects.groupBy("bare").agg(F.count("*").alias("n"), first.alias("first")).filter("n > 1")
    groups = verified.select(
        F.sha2(F.col("bare").cast("binary"), 256).alias("sha"), "n", F.col("first.doc_id").alias("first_id")
    )
    groups = stage(groups, "groups")
    hashed = rows.select(
        "doc_id", F.sha2(F.col("bare").cast("binary"), 256).alias("text_sha256"), text_key().alias("text_key")
    )
    joined = hashed.join(groups, F.col("text_sha256") == F.col("sha"), "left")
    found = joined.withColumn("keep_id", F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("first_id")))
    return found.select(
        "doc_id",
        "keep_id",
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("doc_id").isNull()).alias("kept"),
        "text_sha256",
        "text_key",
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """One row of each group of equal texts, with all its columns."""
    found = duplicates(docs)
    return keep_rows(docs, found.select("doc_id", "text_key", "kept", F.col("text_sha256").alias("unit")))
