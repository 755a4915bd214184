"""Tables: catalog metadata and published tables."""

from pyspark.sql import DataFrame, SparkSession

from custodia.operators.versions import read_version

# The metadata relations that the audit relation joins, as pairs of grants and objects.
METADATA_TABLES = (
    "metastore_privileges",
    "metastores",
    "catalog_privileges",
    "catalogs",
    "schema_privileges",
    "schemata",
    "table_privileges",
    "tables",
    "volume_privileges",
    "volumes",
    "connection_privileges",
    "connections",
    "external_location_privileges",
    "external_locations",
)

INVENTORY_TABLES = (
    "warehouse_privileges",
    "warehouses",
    "cluster_privileges",
    "clusters",
    "workspace_privileges",
    "workspaces",
)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_tables(spark: SparkSession, schema: str, names) -> dict[str, DataFrame]:
    """Tables of a schema; those that are published by version are all of one moment."""
    return read_version(spark, schema, names)


def privilege_frames(spark: SparkSession, inventory_schema: str, metadata_schema: str) -> dict[str, DataFrame]:
    """Every frame that the audit relation needs, by name."""
    return read_tables(spark, inventory_schema, INVENTORY_TABLES) | read_tables(
        spark, metadata_schema, METADATA_TABLES
    )
