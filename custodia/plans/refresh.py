"""Refresh job: landed inventory to published tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from custodia.operators import inventory
from custodia.operators.sinks import ensure_namespace
from custodia.operators.versions import publish_version, read_version
from custodia.sources import landing
from custodia.sources.landing import ACL_KEY, read_inventory


def _acl(kind: str) -> Callable[[DataFrame], DataFrame]:
    return lambda raw: inventory.flatten_acl(landing.object_acls(raw, kind), ACL_KEY[kind])


# Table -> landed entity and the steps from there to the published form.
TABLES: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "users": ("users", lambda raw: inventory.flat_users(landing.users(raw))),
    "workspaces": ("workspaces", landing.workspaces),
    "workspace_privileges": (
        "workspace_assignments",
        lambda raw: inventory.flatten_assignments(landing.workspace_assignments(raw)),
    ),
    "clusters": ("clusters", lambda raw: inventory.owned_clusters(landing.clusters(raw))),
    "warehouses": ("warehouses", lambda raw: inventory.owned_warehouses(landing.warehouses(raw))),
    "cluster_privileges": ("cluster_acl", _acl("clusters")),
    "warehouse_privileges": ("warehouse_acl", _acl("warehouses")),
    "dashboard_privileges": ("dashboard_acl", _acl("dashboards")),
}

# Collected, but not published unless asked for.
VOLUME_TABLE = {"volume_privileges": ("volume_acl", _acl("volumes"))}


def inventory_frames(
    spark: SparkSession, landing_dir: str, release_anchor: str, volumes: bool = False
) -> dict[str, DataFrame]:
    """Every published relation, straight from the landed files."""
    pages = read_inventory(spark, f"{landing_dir}/runtime_pages", "runtime_pages")
    frames = {"runtime_versions": inventory.runtime_versions(pages, release_anchor)}
    for table, (entity, build) in (TABLES | (VOLUME_TABLE if volumes else {})).items():
        frames[table] = build(read_inventory(spark, f"{landing_dir}/{entity}", entity))
    return frames


def refresh(
    spark: SparkSession,
    landing_dir: str,
    schema: str,
    release_anchor: str,
    volumes: bool = False,
    location: str | None = None,
) -> dict[str, DataFrame]:
    """Publish all inventory tables as one version and return them.

    Readers see the old tables until all new ones are written, then all new ones; a run
    that fails changes nothing.

    ``release_anchor`` is the heading id of the release table in the stored pages.
    The tables do not depend on each other, so their jobs run side by side and
    small ones fill the executors that a large one leaves idle at its end.
    """
    ensure_namespace(spark, schema, location)
    frames = inventory_frames(spark, landing_dir, release_anchor, volumes)
    publish_version(spark, schema, frames)
    return read_version(spark, schema, frames)
