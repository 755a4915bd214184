"""Mixing sources to target weights by capped water-filling.

Sources share all words by weight. A source never gives more than a maximum
number of epochs of itself; what it cannot give is shared among the others by
weight, until none is above its maximum. A source's target is then met exactly:
whole repetitions of all its documents, and a fraction of one more pass that
takes documents in a seeded order and cuts into at most one of them.

The seeded order is never laid out in one place. Rows have a place, a seeded
digest of their id, and places fall into buckets by its head. Sums per bucket
tell in which bucket a source's fraction ends, sums per place in that bucket at
which place. So each source has one cut, and a row is taken by comparing with it.

Defined results: a null text has size 0; null is a source of its own, the last
one; rows that share an id share a place, and are cut evenly if the cut falls on
them; documents of size 0 take part with 0 words; an empty table gives an
empty table; further columns are passed on by `repeat_documents`, whatever their names.
Everything is DataFrame operations.
"""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from custodia.llm.common import n_words
from custodia.storage import stage

#: Source weights, repeating by rank. Fixed values.
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix-1"
#: Hex digits of the digest that name a bucket: 4,096 buckets for each source.
BUCKET_DIGITS = 3


class Level(NamedTuple):
    """The water level: words per unit of weight for sources below their maximum."""

    words: int
    weight: int


def seeded_order(seed: str, doc_id: str = "doc_id") -> Column:
    """A digest that puts rows in a repeatable random order."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("binary"))


def stratum(source: str = "source") -> Column:
    """A key for the source that sorts by code point and is never null; null sorts last."""
    return F.coalesce(F.concat(F.lit("0"), F.col(source)), F.lit("1"))


def weighted_sources(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """One row per source: its size, and a weight by its rank in code point order."""
    sizes = sized.groupBy("stratum").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(W.orderBy("stratum")) - 1  # one row per source
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    return sizes.withColumn("weight", weight.cast("long"))


def water_level(sources: DataFrame, epochs: int) -> Level | None:
    """Clamp sources at their maximum and share the rest anew, until no more are clamped.

    The driver holds three sums. Each round clamps at least one more source, and
    rounds end as soon as one clamps none.
    """
    cap = F.col("source_size") * epochs
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level = None
    while True:
        # words / weight * w >= cap, in whole numbers.
        clamped = F.lit(False) if level is None else F.col("weight") * level.words >= cap * level.weight
        n, given, left = sources.agg(
            F.count_if(clamped), F.sum(F.when(clamped, cap)), F.sum(F.when(~clamped, F.col("weight")))
        ).first()
        if not left:
            return None  # every source is at its maximum
        new = Level(total - (given or 0), left)
        if new == level:
            return level
        level = new


def targets(sources: DataFrame, level: Level | None, epochs: int) -> DataFrame:
    """Sources with their targets in words."""
    cap = (F.col("source_size") * epochs).cast("double")
    if level is None:
        return sources.withColumn("target", cap)
    share = F.lit(float(level.words)) / F.lit(float(level.weight)) * F.col("weight")
    clamped = F.col("weight") * level.words >= F.col("source_size") * epochs * level.weight
    return sources.withColumn("target", F.when(clamped, cap).otherwise(share))


def sized_rows(docs: DataFrame, seed: str, *more: Column) -> DataFrame:
    """Size, stratum and place of every row, with further columns before them."""
    return docs.select(
        *more, n_words("text").alias("size"), stratum().alias("stratum"), seeded_order(seed).alias("place")
    )


def plan_mix(rows: DataFrame, weights: tuple[int, ...], epochs: int) -> DataFrame:
    """Per source: size, target, whole repetitions, the cut's place, and the words of each row at that place."""
    sources = stage(weighted_sources(rows, weights), "mix-sources")
    per_source = targets(sources, water_level(sources, epochs), epochs)
    wanted = F.round("target").cast("long")
    whole = F.expr("if(source_size > 0, cast(round(target) as long) div source_size, 0L)")
    per_source = per_source.withColumn("whole", whole)
    per_source = per_source.withColumn("extra", wanted - F.col("whole") * F.col("source_size"))
    buckets = rows.groupBy("stratum", F.substring("place", 1, BUCKET_DIGITS).alias("bucket"))
    ends = _first_beyond(buckets.agg(F.sum("size").alias("words")), per_source, "bucket")
    # Of the bucket where the fraction ends: the place where it does.
    at = ends.select(F.col("stratum").alias("of"), F.col("bucket").alias("in"))
    same = (F.col("stratum") == F.col("of")) & (F.substring("place", 1, BUCKET_DIGITS) == F.col("in"))
    inside = rows.join(at, same)
    places = inside.groupBy("stratum", "place").agg(F.sum("size").alias("words"), F.count("*").alias("n"))
    left = ends.select("stratum", F.col("left").alias("extra"))
    cuts = _first_beyond(places, left, "place").select(
        "stratum", F.col("place").alias("cut"), F.expr("left div n").alias("part")
    )
    plan = per_source.join(cuts, "stratum", "left").select(
        F.col("stratum").alias("of"), "source_size", "target", "whole", "cut", "part"
    )
    return stage(plan, "mix-plan")


def _first_beyond(groups: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Per source the first group that the words wanted do not cover, and the words left for it."""
    earlier = W.partitionBy("stratum").orderBy(key).rowsBetween(W.unboundedPreceding, -1)
    before = groups.withColumn("before", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
    beyond = before.join(wanted.select("stratum", "extra"), "stratum").filter("before + words > extra AND before <= extra")
    return beyond.filter("words > 0").withColumn("left", F.col("extra") - F.col("before"))


def take(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Adds the plan's columns and the words taken to rows of `sized_rows`."""
    part = F.least(F.col("part"), F.col("size"))
    more = F.when(F.col("place") < F.col("cut"), F.col("size")).when(F.col("place") == F.col("cut"), part).otherwise(0)
    return rows.join(plan, F.col("stratum") == F.col("of")).withColumn("taken", F.col("whole") * F.col("size") + more)


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = MAX_EPOCHS, seed: str = SEED
) -> DataFrame:
    """Words that the mix takes of every document: doc_id, size, source_size, target, taken."""
    rows = stage(sized_rows(docs, seed, F.col("doc_id").cast("long").alias("doc_id")), "mix-sizes")
    return take(rows, plan_mix(rows, weights, epochs)).select("doc_id", "size", "source_size", "target", "taken")


def repeat_documents(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = MAX_EPOCHS, seed: str = SEED
) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with all their columns.

    The one document of a source that the fraction cuts into counts whole if it
    is taken by half or more. Documents without words are not taken.
    """
    plan = plan_mix(stage(sized_rows(docs, seed), "mix-sizes"), weights, epochs)
    rows = take(sized_rows(docs, seed, F.struct("*").alias("row")), plan).filter("taken > 0")
    times = F.floor(F.col("taken") / F.col("size") + 0.5).cast("int")
    return rows.select("row", F.explode(F.array_repeat(F.lit(1), times)).alias("one")).select("row.*")
