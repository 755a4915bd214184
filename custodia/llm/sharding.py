"""Sharding by proportional stratified interleaving.

Within each source, rows are put in a seeded random order and ranked; a row's
place in the whole is its fractional rank, (rank - 0.5) / rows of the source.
Cutting that order into equal parts gives shards that all match the mixture and
differ by one row at most.

Neither order is laid out in one place. Ranks come from buckets by the head of a
seeded digest, places from cells of equal width of the fractional rank: counts
per bucket or cell give where it starts, and rows are ordered inside it only.

Defined results: a null text has size 1; null is a source of its own, the last
one; equal rows are told apart by nothing, and which of them gets which slot makes
no difference; with fewer rows than shards, some shards are empty; an empty table
gives an empty table; only the id, the text and the source are read. Everything
is DataFrame operations.
"""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from custodia.llm.mixing import BUCKET_DIGITS, seeded_order, stratum
from custodia.storage import stage

SHARDS = 16
SEED = "shard-1"
#: Rows that one cell of the final order holds, about.
CELL_ROWS = 5_000


def shard(docs: DataFrame, shards: int = SHARDS, seed: str = SEED, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Shard and slot of every row: doc_id, size, text_crc32, shard, slot."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        stratum().alias("stratum"),
        seeded_order(seed).alias("place"),
    )
    rows = stage(rows.withColumn("bucket", F.substring("place", 1, BUCKET_DIGITS)), "shard-rows")
    total = rows.count()
    cells = -(-total // cell_rows)
    counts = rows.groupBy("stratum", "bucket").agg(F.count("*").alias("n"))
    earlier = W.partitionBy("stratum").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(
        "stratum",
        "bucket",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"),
        F.sum("n").over(W.partitionBy("stratum")).alias("n"),
    )
    in_bucket = W.partitionBy("stratum", "bucket").orderBy("place", "doc_id", "size", "text_crc32")
    ranked = rows.withColumn("local", F.row_number().over(in_bucket)).join(starts, ["stratum", "bucket"])
    fraction = (F.col("first") + F.col("local") - F.lit(0.5)) / F.col("n")
    placed = ranked.select("doc_id", "size", "text_crc32", "stratum", fraction.alias("fraction"))
    placed = stage(placed.withColumn("cell", F.floor(F.col("fraction") * cells)), "shard-places")
    before = W.orderBy("cell").rowsBetween(W.unboundedPreceding, -1)  # one row per cell
    cell_starts = placed.groupBy("cell").agg(F.count("*").alias("n"))
    cell_starts = cell_starts.select("cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    in_cell = W.partitionBy("cell").orderBy("fraction", "stratum")
    numbered = placed.withColumn("nth", F.row_number().over(in_cell) - 1).join(cell_starts, "cell")
    # Shard k holds the positions from (k * total div shards) up to the next shard's first.
    cut = numbered.withColumn("position", F.col("start") + F.col("nth")).withColumn(
        "shard", F.expr(f"cast(((position + 1) * {shards} - 1) div {max(total, 1)} as int)")
    )
    slot = F.expr(f"position - (cast(shard as long) * {total}) div {shards}")
    return cut.select("doc_id", "size", "text_crc32", "shard", slot.alias("slot"))
