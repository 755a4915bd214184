"""The audit relation: every privilege on every kind of object."""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custodia.operators.keys import exclude_owners
from custodia.schemas import PRIVILEGE_COLUMNS

# Fixed values of the published relation.
NOT_TAGGED = "Not tagged"
SYSTEM_OWNERS = ("System user",)

_NOT_APPLICABLE = "'N/A'"
_TAGGED_OWNER = f"ifnull(o.owner, '{NOT_TAGGED}')"
_FIRST_SOURCE = "ifnull(get(p.inherited_from_object, 0), 'NONE')"

Frames = Mapping[str, DataFrame]


@dataclass(frozen=True)
class ObjectKind:
    """How the grants on one kind of object join the objects, as SQL expressions.

    ``p`` is the frame of grants, ``o`` the frame of objects. ``keys`` maps the
    grant's columns to the object's. The defaults fit catalog metadata.
    """

    grants: str
    objects: str
    keys: Mapping[str, str]
    name: str
    owner: str
    grantee: str = "p.grantee"
    catalog: str = _NOT_APPLICABLE
    schema: str = _NOT_APPLICABLE
    grantable: str = "p.is_grantable"
    inherited: str = "p.inherited_from"


def _same(*columns: str) -> dict[str, str]:
    return {column: column for column in columns}


KINDS = {
    "warehouse": ObjectKind(
        "warehouse_privileges",
        "warehouses",
        {"warehouse_id": "id"},
        name="o.name",
        owner=_TAGGED_OWNER,
        grantee="p.display_name",
        grantable=_NOT_APPLICABLE,
        inherited=_FIRST_SOURCE,
    ),
    "cluster": ObjectKind(
        "cluster_privileges",
        "clusters",
        _same("cluster_id"),
        name="o.cluster_name",
        owner=_TAGGED_OWNER,
        grantee="p.display_name",
        grantable=_NOT_APPLICABLE,
        inherited=_FIRST_SOURCE,
    ),
    "workspace": ObjectKind(
        "workspace_privileges",
        "workspaces",
        _same("workspace_id"),
        name="o.workspace_name",
        owner=_NOT_APPLICABLE,
        grantee="p.display_name",
        grantable=_NOT_APPLICABLE,
        inherited="'NONE'",
    ),
    "metastore": ObjectKind(
        "metastore_privileges",
        "metastores",
        _same("metastore_id"),
        name="p.metastore_id",
        owner="o.metastore_owner",
    ),
    "catalog": ObjectKind(
        "catalog_privileges",
        "catalogs",
        _same("catalog_name"),
        name="p.catalog_name",
        owner="o.catalog_owner",
        catalog="p.catalog_name",
    ),
    "schema": ObjectKind(
        "schema_privileges",
        "schemata",
        _same("catalog_name", "schema_name"),
        name="p.schema_name",
        owner="o.schema_owner",
        catalog="p.catalog_name",
        schema="p.schema_name",
    ),
    "table": ObjectKind(
        "table_privileges",
        "tables",
        _same("table_catalog", "table_schema", "table_name"),
        name="p.table_name",
        owner="o.table_owner",
        catalog="p.table_catalog",
        schema="p.table_schema",
    ),
    # Volumes are published without their catalog and schema.
    "volume": ObjectKind(
        "volume_privileges",
        "volumes",
        _same("volume_catalog", "volume_schema", "volume_name"),
        name="p.volume_name",
        owner="o.volume_owner",
    ),
    "connection": ObjectKind(
        "connection_privileges",
        "connections",
        _same("connection_name"),
        name="p.connection_name",
        owner="o.connection_owner",
    ),
    "external_location": ObjectKind(
        "external_location_privileges",
        "external_locations",
        _same("external_location_name"),
        name="p.external_location_name",
        owner="o.external_location_owner",
    ),
}


def _on(kind: ObjectKind) -> str:
    return " AND ".join(f"p.{grant} = o.{key}" for grant, key in kind.keys.items())


def _columns(name: str) -> dict[str, str]:
    """The published columns of a kind as SQL expressions.

    The kind is a literal, so that a filter on it drops whole branches.
    """
    kind = KINDS[name]
    columns = {
        "object_type": f"'{name}'",
        "object_name": kind.name,
        "object_owner": kind.owner,
        "grantee": kind.grantee,
        "catalog_name": kind.catalog,
        "schema_name": kind.schema,
        "privilege_type": "p.privilege_type",
        "is_grantable": kind.grantable,
        "inherited_from": kind.inherited,
    }
    return {column: columns[column] for column in PRIVILEGE_COLUMNS}


def branch(name: str, grants: DataFrame, objects: DataFrame) -> DataFrame:
    """Privileges on one kind of object.

    Spark broadcasts the objects if they are small by their file sizes. Otherwise
    both sides are shuffled on the key and AQE splits a key that holds much of
    the grants.
    """
    joined = grants.alias("p").join(objects.alias("o"), F.expr(_on(KINDS[name])))
    return joined.selectExpr(*[f"{expression} AS {column}" for column, expression in _columns(name).items()])


def all_privileges(frames: Frames, without: Sequence[str] = SYSTEM_OWNERS) -> DataFrame:
    """All branches, without the given owners and without rows that have no owner."""
    branches = [branch(name, frames[kind.grants], frames[kind.objects]) for name, kind in KINDS.items()]
    return exclude_owners(reduce(DataFrame.unionByName, branches), without)


def counts_of_kind(name: str, grants: DataFrame, objects: DataFrame) -> DataFrame:
    """Number of privileges per owner on one kind of object.

    Grants are counted per object before the join, so the join moves one row per
    object instead of one per grant, also for an object with most of the grants.
    """
    kind = KINDS[name]
    counted = grants.groupBy(*kind.keys).agg(F.count("*").alias("n"))
    joined = counted.alias("p").join(objects.alias("o"), F.expr(_on(kind)))
    per_object = joined.select(F.expr(kind.owner).alias("object_owner"), F.col("p.n").alias("n"))
    return per_object.groupBy("object_owner").agg(F.sum("n").alias("n_privileges"))


def privileges_by_owner(frames: Frames, without: Sequence[str] = SYSTEM_OWNERS) -> DataFrame:
    """Number of privileges per owner: `all_privileges` counted by owner."""
    counts = [counts_of_kind(name, frames[kind.grants], frames[kind.objects]) for name, kind in KINDS.items()]
    every = exclude_owners(reduce(DataFrame.unionByName, counts), without)
    return every.groupBy("object_owner").agg(F.sum("n_privileges").alias("n_privileges"))


def privilege_query(tables: Mapping[str, str], without: Sequence[str] = SYSTEM_OWNERS) -> str:
    """`all_privileges` as SQL over tables, for a view that outlives the session."""
    branches = [
        f"SELECT {', '.join(f'{expression} AS {column}' for column, expression in _columns(name).items())} "
        f"FROM {tables[kind.grants]} p JOIN {tables[kind.objects]} o ON {_on(kind)}"
        for name, kind in KINDS.items()
    ]
    owners = ", ".join(f"'{owner}'" for owner in without)
    return f"SELECT * FROM ({' UNION ALL '.join(branches)}) WHERE object_owner NOT IN ({owners})"
