"""Landed inventory.

Layout, one JSON object per line::

    <landing>/<entity>/*.json                        workspaces, users, runtime_pages
    <landing>/<entity>/workspace_id=<id>/*.json      everything collected per workspace

Files may be compressed (``*.json.gz``); one is then read by one task.
All workspaces of an entity are one scan. An access-list line is one entry with
the id of its object under ``object_id``.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custodia.functions.names import normalize_schema
from custodia.schemas import RAW

# Kind of object -> key column of its published access list.
ACL_KEY = {
    "clusters": "cluster_id",
    "warehouses": "warehouse_id",
    "dashboards": "dashboard_id",
    "volumes": "volume_id",
}


def read_inventory(spark: SparkSession, path: str, entity: str) -> DataFrame:
    """One entity with its declared type and normalised names.

    Missing keys read as null and unlisted keys are pruned. A value that does not
    fit its type fails the read. An empty directory gives an empty typed frame.
    """
    raw = spark.read.schema(RAW[entity]).option("mode", "FAILFAST").json(path)
    return normalize_schema(raw.select(RAW[entity].names))


def workspaces(df: DataFrame) -> DataFrame:
    return df.select(
        "account_id",
        "creation_time",
        "deployment_name",
        "location",
        "pricing_tier",
        "workspace_id",
        "workspace_name",
    )


def users(df: DataFrame) -> DataFrame:
    return df.select("emails", "active", "displayname", "externalid", "id", "name", "roles", "username")


def warehouses(df: DataFrame) -> DataFrame:
    return df.select(
        "auto_stop_mins",
        "creator_name",
        "enable_photon",
        "enable_serverless_compute",
        "id",
        "name",
        "spot_instance_policy",
        "tags",
        "warehouse_type",
        "workspace_id",
    )


def clusters(df: DataFrame) -> DataFrame:
    return df.select(
        "cluster_name",
        "spark_version",
        "node_type_id",
        "driver_node_type_id",
        "custom_tags",
        "autotermination_minutes",
        "runtime_engine",
        "data_security_mode",
        "single_user_name",
        "cluster_id",
        "spark_context_id",
        "cluster_memory_mb",
        "cluster_cores",
        "default_tags",
        "workspace_id",
    )


def workspace_assignments(df: DataFrame) -> DataFrame:
    return df.select("permissions", "principal", "workspace_id")


def object_acls(df: DataFrame, kind: str) -> DataFrame:
    """Access-list entries of one kind of object under that kind's key column."""
    return df.select(
        F.col("object_id").alias(ACL_KEY[kind]),
        "all_permissions",
        "display_name",
        "user_name",
        "service_principal_name",
        "group_name",
        "workspace_id",
    )
