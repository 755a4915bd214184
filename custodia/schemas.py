"""Types of every entity.

``RAW`` holds the types as landed, with the key case of the listings: JSON keys
are matched case-sensitively, so a wrong case would read as null without an
error. Keys left out of a schema are pruned by the JSON reader.
"""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_STRING, _INT, _LONG, _BOOL = StringType(), IntegerType(), LongType(), BooleanType()
_TAGS = MapType(_STRING, _STRING)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields.items()])


_ACL = _struct(
    object_id=_STRING,
    all_permissions=ArrayType(
        _struct(inherited=_BOOL, permission_level=_STRING, inherited_from_object=ArrayType(_STRING))
    ),
    display_name=_STRING,
    user_name=_STRING,
    service_principal_name=_STRING,
    group_name=_STRING,
    workspace_id=_LONG,
)

# workspace_id is the directory partition in every entity but workspaces. It is
# declared so that its type is bigint whatever values occur.
RAW = {
    "workspaces": _struct(
        account_id=_STRING,
        creation_time=_LONG,
        deployment_name=_STRING,
        location=_STRING,
        pricing_tier=_STRING,
        workspace_id=_LONG,
        workspace_name=_STRING,
    ),
    "users": _struct(
        emails=ArrayType(_struct(primary=_BOOL, type=_STRING, value=_STRING)),
        active=_BOOL,
        displayName=_STRING,
        externalId=_STRING,
        id=_STRING,
        name=_struct(familyName=_STRING, givenName=_STRING),
        roles=ArrayType(_struct(type=_STRING, value=_STRING)),
        userName=_STRING,
    ),
    "workspace_assignments": _struct(
        permissions=ArrayType(_STRING),
        principal=_struct(
            principal_id=_LONG,
            display_name=_STRING,
            user_name=_STRING,
            group_name=_STRING,
            service_principal_name=_STRING,
        ),
        workspace_id=_LONG,
    ),
    "clusters": _struct(
        cluster_name=_STRING,
        spark_version=_STRING,
        node_type_id=_STRING,
        driver_node_type_id=_STRING,
        custom_tags=_TAGS,
        autotermination_minutes=_INT,
        runtime_engine=_STRING,
        data_security_mode=_STRING,
        single_user_name=_STRING,
        cluster_id=_STRING,
        spark_context_id=_LONG,
        cluster_memory_mb=_INT,
        cluster_cores=FloatType(),
        default_tags=_TAGS,
        workspace_id=_LONG,
    ),
    "warehouses": _struct(
        auto_stop_mins=_INT,
        creator_name=_STRING,
        enable_photon=_BOOL,
        enable_serverless_compute=_BOOL,
        id=_STRING,
        name=_STRING,
        spot_instance_policy=_STRING,
        tags=_struct(custom_tags=ArrayType(_TAGS)),
        warehouse_type=_STRING,
        workspace_id=_LONG,
    ),
    "cluster_acl": _ACL,
    "warehouse_acl": _ACL,
    "dashboard_acl": _ACL,
    "volume_acl": _ACL,
    "runtime_pages": _struct(page_id=_LONG, url=_STRING, html=_STRING),
}

# The published audit relation, in column order.
PRIVILEGE_COLUMNS = [
    "object_type",
    "object_name",
    "object_owner",
    "grantee",
    "catalog_name",
    "schema_name",
    "privilege_type",
    "is_grantable",
    "inherited_from",
]

OUTCOMES = _struct(outcome_id=_INT, outcome_value=_STRING)

REVIEWS = _struct(access_review_id=_LONG, created_date=TimestampType(), created_by=_STRING)

REVIEW_DETAIL = _struct(
    access_review_detail_id=_LONG,
    access_review_id=_LONG,
    outcome_id=_INT,
    **dict.fromkeys(PRIVILEGE_COLUMNS, _STRING),
)

# Review files lead with a row number under a blank header, which reads as _c0.
REVIEW_CSV = StructType([StructField("_c0", _LONG), *REVIEW_DETAIL.fields])
