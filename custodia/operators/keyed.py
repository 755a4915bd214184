"""Keyed tables, into which rows are merged.

Rows lie in buckets by a hash of their key. A merge writes only the buckets that change,
each as a new partition, and then one row into the table of merges, which says for every
bucket which merge wrote it last. That row makes the merge visible, in all buckets at
once; the table itself is a view that follows it. Buckets that a merge does not change
are neither read nor written. One merge of a table may run at a time.
"""

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from custodia.operators.constraints import declaration, key_of, properties, refuse_repeats, without_nulls
from custodia.operators.keys import upsert
from custodia.operators.partitions import drop_partitions, partition_values, table_folder, write_partition
from custodia.storage import staging

BUCKETS = 64
#: Merges whose rows stay for queries that have begun.
KEPT = 2


def _rows(table: str) -> str:
    return f"{table}__rows"


def _merges(table: str) -> str:
    return f"{table}__merges"


def ensure_keyed_table(
    spark: SparkSession,
    table: str,
    schema: StructType,
    key: Sequence[str],
    required: Sequence[str] = (),
    buckets: int = BUCKETS,
) -> None:
    """Create an empty keyed table unless it exists."""
    rows, merges = _rows(table), _merges(table)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {rows} ({schema.toDDL()}, key_bucket INT, merge BIGINT) "
        f"USING parquet PARTITIONED BY (key_bucket, merge){declaration(key, required)}"
    )
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {merges} (buckets MAP<INT, BIGINT>, merged_at TIMESTAMP, merge BIGINT) "
        f"USING parquet OPTIONS (ignoreMissingFiles 'true') PARTITIONED BY (merge) TBLPROPERTIES ('buckets' = '{buckets}')"
    )
    newest = f"(SELECT max_by(buckets, merge) FROM {merges})"
    spark.sql(
        f"CREATE VIEW IF NOT EXISTS {table} AS SELECT {', '.join(schema.names)} FROM {rows} "
        f"WHERE merge = element_at({newest}, key_bucket)"
    )


def newest_buckets(spark: SparkSession, table: str) -> dict[int, int]:
    """Bucket -> the merge that wrote it last; as many entries as the table has buckets at most."""
    spark.catalog.refreshTable(_merges(table))
    found = spark.table(_merges(table)).agg(F.max_by("buckets", "merge").alias("buckets")).first()
    return dict(found.buckets or {})


def _bucket_of(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def _of_buckets(spark: SparkSession, table: str, held: dict[int, int]) -> DataFrame:
    """Rows of some buckets, each as of one merge; other partitions are pruned."""
    pairs = [F.lit(x) for bucket, merge in held.items() for x in (bucket, merge)]
    rows = spark.table(_rows(table))
    if not held:
        return rows.filter(F.lit(False))
    of = F.create_map(*pairs)
    return rows.filter(F.col("key_bucket").isin(*held) & (F.col("merge") == of[F.col("key_bucket")]))


def upsert_table(source: DataFrame, table: str) -> int:
    """Merge rows into a keyed table by its key; returns how many buckets were written.

    Rows that the table has already change nothing. A null or repeated key, or a null
    in a required column, stops the merge; so does any failure, without a trace.
    """
    spark = source.sparkSession
    rows_table = _rows(table)
    key = key_of(spark, rows_table)
    n_buckets = int(properties(spark, _merges(table))["buckets"])
    columns = [name for name in spark.table(rows_table).columns if name not in ("key_bucket", "merge")]
    with staging(spark) as staged:
        bucketed = without_nulls(source.select(*columns), rows_table).withColumn("key_bucket", _bucket_of(key, n_buckets))
        source = staged.stage(bucketed, "merge-source")
        refuse_repeats(source, table, key)
        newest = newest_buckets(spark, table)
        touched = {row.key_bucket for row in source.select("key_bucket").distinct().collect()}
        held = _of_buckets(spark, table, {b: newest[b] for b in touched if b in newest}).select(*columns)
        target = held.toDF(*[f"old_{name}" for name in columns])
        same = [F.col(name).eqNullSafe(F.col(f"old_{name}")) for name in columns]
        changed = staged.stage(source.join(target, same, "left_anti"), "merge-changed")
        written = sorted(row.key_bucket for row in changed.select("key_bucket").distinct().collect())
        if not written:
            return 0
        held = _of_buckets(spark, table, {b: newest[b] for b in written if b in newest}).select(*columns)
        merged = upsert(held, changed.select(*columns), key).withColumn("key_bucket", _bucket_of(key, n_buckets))
        merge = max([0, *(p["merge"] for p in partition_values(spark, rows_table)), *newest.values()]) + 1
        folder = f"{table_folder(spark, rows_table)}__files/merge={merge}"
        # Rows of a bucket together, in as many tasks as the shuffle needs.
        merged.repartition("key_bucket").write.mode("overwrite").partitionBy("key_bucket").parquet(folder)
    added = " ".join(
        f"PARTITION (key_bucket = {b}, merge = {merge}) LOCATION '{folder}/key_bucket={b}'" for b in written
    )
    spark.sql(f"ALTER TABLE {rows_table} ADD IF NOT EXISTS {added}")
    spark.catalog.refreshTable(rows_table)
    _show(spark, table, newest | dict.fromkeys(written, merge), merge)
    _remove_old(spark, table)
    return len(written)


def _show(spark: SparkSession, table: str, buckets: dict[int, int], merge: int) -> None:
    text = json.dumps({str(b): m for b, m in buckets.items()})
    listed = F.from_json(F.lit(text), "map<string, bigint>")
    by_bucket = F.map_from_entries(
        F.transform(F.map_entries(listed), lambda e: F.struct(e["key"].cast("int"), e["value"]))
    )
    row = spark.range(1).select(by_bucket.alias("buckets"), F.current_timestamp().alias("merged_at"))
    write_partition(row, _merges(table), "merge", merge)


def _remove_old(spark: SparkSession, table: str) -> None:
    """Drop partitions that none of the newest merges shows."""
    shown = spark.table(_merges(table)).orderBy(F.col("merge").desc()).limit(KEPT).collect()
    needed = {(b, m) for row in shown for b, m in row.buckets.items()}
    newest = max(row.merge for row in shown)
    drop_partitions(spark, _rows(table), lambda key_bucket, merge: (key_bucket, merge) not in needed and merge < newest)
    drop_partitions(spark, _merges(table), lambda merge: merge not in {row.merge for row in shown})
