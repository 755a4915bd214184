"""Tables and views."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from custodia.operators.constraints import declaration, key_of, refuse_repeats, without_nulls
from custodia.operators.partitions import drop_partition_with_rows, schema_of, write_partition
from custodia.operators.versions import publish_version, read_version


def ensure_namespace(spark: SparkSession, schema: str, location: str | None = None) -> None:
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}{at}")


def ensure_table(
    spark: SparkSession,
    name: str,
    schema: StructType,
    partition_by: Sequence[str] = (),
    key: Sequence[str] = (),
    required: Sequence[str] = (),
) -> None:
    """Create an empty parquet table unless it exists.

    Partition columns come last. The columns of the key and the required ones are
    checked with every write of this module.
    """
    partitioned = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    declared = declaration(key, required)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema.toDDL()}) USING parquet{partitioned}{declared}")


def publish(df: DataFrame, table: str) -> DataFrame:
    """Create or replace a published table with the full result; until that is written, the old one stays."""
    spark = df.sparkSession
    schema, name = schema_of(spark, table)
    publish_version(spark, schema, {name: df})
    return read_version(spark, schema, [name])[name]


def append(df: DataFrame, table: str) -> None:
    """Append rows; columns are matched by name. Nulls that the table does not take stop it."""
    columns = df.sparkSession.table(table).columns
    without_nulls(df.select(*columns), table).write.insertInto(table)


def replace_partition(df: DataFrame, table: str, column: str, value: int) -> None:
    """Write one whole partition, replacing what an earlier attempt left in it.

    Rows that break the table's constraints stop it; then the partition is gone. Only
    repeats within the partition are looked for, in the written rows' key columns.
    """
    spark = df.sparkSession
    columns = [name for name in spark.table(table).columns if name != column]
    write_partition(without_nulls(df.select(*columns), table), table, column, value)
    key = [name for name in key_of(spark, table) if name != column]
    try:
        refuse_repeats(spark.table(table).filter(f"{column} = {int(value)}"), table, key)
    except Exception:
        drop_partition_with_rows(spark, table, column, value)
        raise
