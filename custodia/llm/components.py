"""Connected components by alternating large-star and small-star rounds."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custodia.storage import new_folder, remove_folder, stage


def _with_lowest(pairs: DataFrame) -> DataFrame:
    """Pairs with the lowest neighbour of their node u.

    It is summed up before rows move, so a node of any degree is one row, and
    written, so that Spark knows its size and can split a hot node's pairs.
    """
    return pairs.join(stage(pairs.groupBy("u").agg(F.min("v").alias("low")), "lowest"), "u")


def large_star(edges: DataFrame) -> DataFrame:
    """Every node hangs its higher neighbours below the lowest of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_lowest(both).filter("v > u").select(F.col("v").alias("u"), F.least("u", "low").alias("v"))


def small_star(edges: DataFrame) -> DataFrame:
    """Every node hangs its lower neighbours and itself below the lowest of them."""
    down = _with_lowest(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
    hung = F.when(F.col("v") > F.col("low"), F.col("v")).otherwise(F.col("u"))
    return down.select(hung.alias("u"), F.col("low").alias("v")).distinct()


def _is_settled(edges: DataFrame) -> bool:
    """Whether every node hangs below one node only, which hangs below none."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).unionByName(
        edges.select(F.col("v").alias("n"), F.lit(0).alias("hangs"), F.lit(1).alias("holds"))
    )
    counts = ends.groupBy("n").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return counts.filter("hangs > 1 OR hangs = 1 AND holds = 1").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """node, component (its lowest node) for every node that has an edge, from edges (u, v).

    Each round is written to the shared folder and the one before it deleted; the
    driver learns only whether it was the last. Edges of a node to itself, repeated
    edges and null ends add nothing.
    """
    spark = edges.sparkSession
    folders = [new_folder(spark, "edges")]
    down = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    current = stage(down.distinct(), "edges", folders[-1])
    while not _is_settled(current):
        folders += [new_folder(spark, "edges"), new_folder(spark, "edges")]
        large = stage(large_star(current), "edges", folders[-2])
        current = stage(small_star(large), "edges", folders[-1])
        for folder in folders[:-1]:
            remove_folder(spark, folder)
        folders = folders[-1:]
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
