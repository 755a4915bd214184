"""Named views over the published tables."""

from pyspark.sql import DataFrame, SparkSession

from custodia.plans.privileges import all_privileges, privilege_query
from custodia.plans.support import cluster_version_support, support_query
from custodia.sources.catalog import INVENTORY_TABLES, METADATA_TABLES, privilege_frames


def register_views(
    spark: SparkSession, inventory_schema: str, metadata_schema: str, as_of=None
) -> dict[str, DataFrame]:
    """Create or replace the views ``all_privileges`` and ``cluster_version_support`` for this session."""
    frames = privilege_frames(spark, inventory_schema, metadata_schema)
    views = {
        "all_privileges": all_privileges(frames),
        "cluster_version_support": cluster_version_support(
            frames["clusters"], spark.table(f"{inventory_schema}.runtime_versions"), as_of
        ),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    return views


def create_views(spark: SparkSession, schema: str, inventory_schema: str, metadata_schema: str) -> None:
    """Create or replace both views in a schema, for every session; days count from the time of the query."""
    tables = {name: f"{inventory_schema}.{name}" for name in INVENTORY_TABLES}
    tables |= {name: f"{metadata_schema}.{name}" for name in METADATA_TABLES}
    spark.sql(f"CREATE OR REPLACE VIEW {schema}.all_privileges AS {privilege_query(tables)}")
    support = support_query(tables["clusters"], f"{inventory_schema}.runtime_versions")
    spark.sql(f"CREATE OR REPLACE VIEW {schema}.cluster_version_support AS {support}")
