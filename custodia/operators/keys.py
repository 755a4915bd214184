"""Keys: uniqueness checks, new ids, latest ids, upsert."""

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that are null or occur more than once, with their row count.

    Rows are counted per key before the shuffle, so copies of a key cost nothing.
    """
    missing = reduce(or_, [F.col(key).isNull() for key in keys])
    counts = df.groupBy(*keys).agg(F.count("*").alias("n_rows"))
    return counts.filter((F.col("n_rows") > 1) | missing)


def assign_ids(df: DataFrame, id_col: str, start: int = 1) -> DataFrame:
    """Put a unique bigint of at least ``start`` before the other columns; gaps are allowed.

    Ids follow from the partition and the position in it, which needs no shuffle
    and no order over the data. Write the result once and read it back: a second
    evaluation may number the rows differently.
    """
    return df.select((F.monotonically_increasing_id() + F.lit(start).cast("bigint")).alias(id_col), "*")


#: Bits of an id for the position in a partition, and for the partition.
POSITION_BITS, PARTITION_BITS = 27, 17


def numbered_ids(df: DataFrame, id_col: str, run: int) -> DataFrame:
    """Put a bigint before the other columns that is unique over all runs and ascends over them; gaps are allowed.

    It holds the run's number, the partition and the position in it, so runs need not
    know of each other. More rows in a partition or more partitions than there are bits
    for stop the query.
    """
    place = F.monotonically_increasing_id()
    partition, position = F.shiftright(place, 33), place.bitwiseAND(F.lit((1 << 33) - 1))
    base = F.lit(run << (POSITION_BITS + PARTITION_BITS)).cast("bigint")
    fits = (position < 1 << POSITION_BITS) & (partition < 1 << PARTITION_BITS)
    number = base + F.shiftleft(partition, POSITION_BITS) + position
    return df.select(F.when(fits, number).otherwise(F.raise_error(F.lit("too many rows to number")).cast("bigint")).alias(id_col), "*")


def latest_id(df: DataFrame, col: str) -> DataFrame:
    """One row with the highest id; null if there is none."""
    return df.agg(F.max(col).alias(col))


def next_id(df: DataFrame, col: str) -> int:
    """The id after the highest one in use."""
    return (latest_id(df, col).first()[0] or 0) + 1


def latest_review(detail: DataFrame, reviews: DataFrame) -> DataFrame:
    """Rows of the newest review.

    The id is a scalar subquery, so a detail table partitioned by it is pruned
    to one partition when the query runs.
    """
    newest = latest_id(reviews, "access_review_id").scalar()
    return detail.filter(F.col("access_review_id") == newest)


def exclude_owners(df: DataFrame, owners: Sequence[str]) -> DataFrame:
    """Drop rows of the given owners, and rows without an owner."""
    return df.filter(~F.col("object_owner").isin(*owners))


def rows_of_owner(df: DataFrame, owner: str) -> DataFrame:
    return df.filter(F.col("object_owner") == owner)


def count_by_owner(df: DataFrame) -> DataFrame:
    return df.groupBy("object_owner").agg(F.count("*").alias("n_rows"))


def owners(df: DataFrame) -> DataFrame:
    return df.select("object_owner").distinct()


def union_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name of a few frames; columns that a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


class DuplicateKeyError(ValueError):
    """A merge source has several rows for one key."""


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows without a match, plus all source rows.

    Null keys match nothing. Other source keys must be unique.
    """
    if not source.dropna(subset=list(keys)).groupBy(*keys).count().filter("count > 1").isEmpty():
        raise DuplicateKeyError(f"the source has several rows for one value of {', '.join(keys)}")
    return target.join(source, list(keys), "left_anti").select(*target.columns).unionByName(source)
