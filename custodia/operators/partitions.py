"""Partitions of catalog tables, each written into a folder of its own."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from custodia.storage import remove_folder


def schema_folder(spark: SparkSession, schema: str) -> str:
    return spark.catalog.getDatabase(schema).locationUri.rstrip("/")


def schema_of(spark: SparkSession, table: str) -> tuple[str, str]:
    """Schema and name of a table."""
    schema, _, name = table.rpartition(".")
    return schema or spark.catalog.currentDatabase(), name


def table_folder(spark: SparkSession, table: str) -> str:
    """Folder of a table that was created without a location."""
    schema, name = schema_of(spark, table)
    return f"{schema_folder(spark, schema)}/{name.lower()}"


def write_partition(df: DataFrame, table: str, column: str, value: int) -> None:
    """Write rows into a partition's folder, then show them at once; what another attempt left is replaced.

    Inserts into one table side by side would share a folder for their unfinished files.
    """
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(f"{table_folder(spark, table)}/{column}={int(value)}")
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({column} = {int(value)})")
    spark.catalog.refreshTable(table)


def partition_values(spark: SparkSession, table: str) -> list[dict[str, int]]:
    """Values of the partition columns, all of them numbers, of every partition."""
    listed = spark.sql(f"SHOW PARTITIONS {table}").collect()
    return [{k: int(v) for k, v in (part.split("=") for part in row.partition.split("/"))} for row in listed]


def drop_partitions(spark: SparkSession, table: str, unwanted: Callable[..., bool]) -> None:
    """Drop the partitions whose values, given by name, are unwanted."""
    for values in partition_values(spark, table):
        if unwanted(**values):
            spec = ", ".join(f"{column} = {value}" for column, value in values.items())
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")


def drop_partition_with_rows(spark: SparkSession, table: str, column: str, value: int) -> None:
    """Take a partition away that must not be seen."""
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({column} = {int(value)})")
    remove_folder(spark, f"{table_folder(spark, table)}/{column}={int(value)}")
    spark.catalog.refreshTable(table)
