import pytest
from pyspark.sql import functions as F

from core_helpers import rows
from custodia.operators.keys import count_by_owner
from custodia.plans.privileges import KINDS, all_privileges, branch, privileges_by_owner
from custodia.schemas import PRIVILEGE_COLUMNS

ACL = (
    "{key} string, display_name string, workspace_id bigint, inherited boolean, "
    "inherited_from_object array<string>, privilege_type string, type string"
)
GRANT = "grantee string, privilege_type string, is_grantable string, inherited_from string"


def frames(spark):
    def make(ddl, *data):
        return spark.createDataFrame(list(data), ddl)

    grant = ("g", "USE", "NO", "NONE")
    names = "{0}_catalog string, {0}_schema string, {0}_name string"
    return {
        "warehouses": make("id string, name string, owner string", ("w1", "W1", "Ann"), ("w2", "W2", None)),
        "warehouse_privileges": make(
            ACL.format(key="warehouse_id"),
            ("w1", "u", 1, True, ["/x/", "/y/"], "CAN_USE", "User"),
            ("w2", "u", 1, False, [], "CAN_USE", "User"),
            ("gone", "u", 1, False, None, "CAN_USE", "User"),
        ),
        "clusters": make(
            "cluster_id string, cluster_name string, owner string",
            ("c1", "C1", "System user"),
            ("c2", "C2", None),
            ("c3", "C2", "Ann"),
        ),
        "cluster_privileges": make(
            ACL.format(key="cluster_id"),
            ("c1", "u", 1, False, None, "CAN_USE", "User"),
            ("c2", "u", 1, False, None, "CAN_USE", "User"),
            ("c3", None, 1, None, None, None, "UNKNOWN"),
        ),
        "workspaces": make("workspace_id bigint, workspace_name string", (1, "one"), (3_000_000_000, "big")),
        "workspace_privileges": make(
            "workspace_id bigint, privilege_type string, principal_id bigint, type string, display_name string",
            (1, "ADMIN", 1, "User", "u"),
            (3_000_000_000, "USER", 1, "User", "u"),
        ),
        "metastores": make("metastore_id string, metastore_owner string", ("m", "Ann")),
        "metastore_privileges": make(f"metastore_id string, {GRANT}", ("m", *grant)),
        "catalogs": make("catalog_name string, catalog_owner string", ("k", None), ("l", "Ann")),
        "catalog_privileges": make(f"catalog_name string, {GRANT}", ("k", *grant), ("l", *grant)),
        "schemata": make(
            "catalog_name string, schema_name string, schema_owner string", ("k", "s", "Ann"), ("l", "s", "Bob")
        ),
        "schema_privileges": make(f"catalog_name string, schema_name string, {GRANT}", ("k", "s", *grant)),
        "tables": make(f"{names.format('table')}, table_owner string", ("k", "s", "t", "Ann"), ("l", "s", "t", "Bob")),
        "table_privileges": make(f"{names.format('table')}, {GRANT}", ("k", "s", "t", *grant)),
        "volumes": make(f"{names.format('volume')}, volume_owner string", ("k", "s", "v", "Ann")),
        "volume_privileges": make(f"{names.format('volume')}, {GRANT}", ("k", "s", "v", *grant)),
        "connections": make("connection_name string, connection_owner string", ("n", "Ann")),
        "connection_privileges": make(f"connection_name string, {GRANT}", ("n", *grant)),
        "external_locations": make("external_location_name string, external_location_owner string", ("e", "Ann")),
        "external_location_privileges": make(f"external_location_name string, {GRANT}", ("e", *grant)),
    }


GRANTED = ("USE", "NO", "NONE")
NA = "N/A"

EXPECTED = [
    ("warehouse", "W1", "Ann", "u", NA, NA, "CAN_USE", NA, "/x/"),
    ("warehouse", "W2", "Not tagged", "u", NA, NA, "CAN_USE", NA, "NONE"),
    ("cluster", "C2", "Not tagged", "u", NA, NA, "CAN_USE", NA, "NONE"),
    ("cluster", "C2", "Ann", None, NA, NA, None, NA, "NONE"),
    ("workspace", "one", NA, "u", NA, NA, "ADMIN", NA, "NONE"),
    ("workspace", "big", NA, "u", NA, NA, "USER", NA, "NONE"),
    ("metastore", "m", "Ann", "g", NA, NA, *GRANTED),
    ("catalog", "l", "Ann", "g", "l", NA, *GRANTED),
    ("schema", "s", "Ann", "g", "k", "s", *GRANTED),
    ("table", "t", "Ann", "g", "k", "s", *GRANTED),
    ("volume", "v", "Ann", "g", NA, NA, *GRANTED),
    ("connection", "n", "Ann", "g", NA, NA, *GRANTED),
    ("external_location", "e", "Ann", "g", NA, NA, *GRANTED),
]


def test_every_kind_of_object(spark):
    result = all_privileges(frames(spark))
    assert result.columns == PRIVILEGE_COLUMNS
    assert {f.dataType.simpleString() for f in result.schema} == {"string"}
    assert sorted(map(str, rows(result))) == sorted(map(str, EXPECTED))


def test_counts_per_owner_equal_the_counted_relation(spark):
    given = frames(spark)
    assert rows(privileges_by_owner(given)) == rows(count_by_owner(all_privileges(given)))


def test_relation_is_the_sum_of_its_branches(testbed):
    given = testbed.frames()
    kept = sum(
        branch(name, given[kind.grants], given[kind.objects]).filter("object_owner <> 'System user'").count()
        for name, kind in KINDS.items()
    )
    assert all_privileges(given).count() == kept


@pytest.mark.parametrize("setting", ["-1", "10MB"])
def test_one_object_with_most_grants(spark, setting):
    """A third and more of all grants on one object, with and without broadcasts."""
    given = frames(spark)
    grants = spark.range(30_000).select(
        F.when(F.col("id") % 2 == 0, "w1").otherwise(F.concat(F.lit("w"), F.col("id") % 500)).alias("warehouse_id"),
        F.concat(F.lit("u"), F.col("id")).alias("display_name"),
        F.lit(1).cast("bigint").alias("workspace_id"),
        F.lit(False).alias("inherited"),
        F.array().cast("array<string>").alias("inherited_from_object"),
        F.lit("CAN_USE").alias("privilege_type"),
        F.lit("User").alias("type"),
    )
    objects = spark.range(500).select(
        F.concat(F.lit("w"), F.col("id")).alias("id"),
        F.concat(F.lit("W"), F.col("id")).alias("name"),
        F.concat(F.lit("o"), F.col("id") % 3).alias("owner"),
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", setting)
    try:
        given |= {"warehouses": objects, "warehouse_privileges": grants}
        result = all_privileges(given)
        assert result.filter("object_type = 'warehouse'").count() == 30_000
        assert rows(privileges_by_owner(given)) == rows(count_by_owner(result))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
