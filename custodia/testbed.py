"""Governance entities derived from the star-schema test tables.

Clusters are parts, warehouses are suppliers, access-list entries are line
items, workspaces are nations, principals are customers. Every entity covers its
whole tables. Access lists, tags and assignments are built nested, as they land,
so that the flattening is exercised.
"""

from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from custodia.functions.names import normalize_schema
from custodia.operators import inventory
from custodia.schemas import RAW
from custodia.sources import landing
from custodia.sources.catalog import INVENTORY_TABLES, METADATA_TABLES
from custodia.storage import GZIP, stage

AS_OF = "2024-06-01 19:00:00"
RELEASE_ANCHOR = "supported-releases"


def _text(col: str) -> Column:
    return F.col(col).cast("string")


def _named(prefix: str, col: str) -> Column:
    return F.concat(F.lit(prefix), _text(col))


def _owner(key: str, owner: Column) -> Column:
    """Every seventh object has no owner, every eleventh belongs to the system."""
    k = F.col(key)
    return F.when(k % 7 == 0, None).when(k % 11 == 0, "System user").otherwise(owner)


def _permissions(level: Column, inherited: Column, source: str) -> Column:
    sources = F.when(inherited, F.array(F.lit(source))).otherwise(F.array().cast("array<string>"))
    return F.array(
        F.struct(
            inherited.alias("inherited"),
            level.alias("permission_level"),
            sources.alias("inherited_from_object"),
        )
    )


def _acl(df: DataFrame, object_id: Column, workspace: Column, principal: str, group: Column, permissions: Column):
    line = F.col("line")
    return df.select(
        object_id.alias("object_id"),
        permissions.alias("all_permissions"),
        _named("sp_", principal).alias("display_name"),
        F.when(line % 2 == 0, _named("user_", "user_key")).alias("user_name"),
        F.when(line % 3 == 1, _named("app_", principal)).alias("service_principal_name"),
        F.when(line % 3 == 0, group).alias("group_name"),
        workspace.cast("bigint").alias("workspace_id"),
    )


def _places(nation: DataFrame, region: DataFrame) -> DataFrame:
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey",
        F.col("r_name").alias("catalog"),
        F.col("n_name").alias("schema"),
        _named("owner_", "n_nationkey").alias("place_owner"),
    )


def _grants(df: DataFrame, grantee: str, privilege, grantable="NO", inherited="NONE", **keys: Column) -> DataFrame:
    def column(value):
        return value if isinstance(value, Column) else F.lit(value)

    return df.select(
        *[col.alias(name) for name, col in keys.items()],
        F.col(grantee).alias("grantee"),
        column(privilege).alias("privilege_type"),
        column(grantable).alias("is_grantable"),
        column(inherited).alias("inherited_from"),
    )


class Testbed:
    """Entities over the parquet tables of one directory.

    ``raw_<entity>`` is an entity as landed; a method named like a published
    table is that table.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        # Plans, not data: each table and frame is analysed once.
        self.table = cache(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))
        self.frame = cache(lambda name: getattr(self, name)())

    def frames(self) -> dict[str, DataFrame]:
        """Every frame that the audit relation joins."""
        return {name: self.frame(name) for name in INVENTORY_TABLES + METADATA_TABLES}

    # Landed entities, with the raw key case.

    def raw_workspaces(self) -> DataFrame:
        places = self.table("nation").join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        return places.select(
            F.lit("a1").alias("account_id"),
            F.lit(1700000000000).cast("bigint").alias("creation_time"),
            F.lower(F.regexp_replace("n_name", "_", "-")).alias("deployment_name"),
            F.col("r_name").alias("location"),
            F.when(F.col("n_nationkey") % 3 == 0, "STANDARD").otherwise("PREMIUM").alias("pricing_tier"),
            F.col("n_nationkey").cast("bigint").alias("workspace_id"),
            F.col("n_name").alias("workspace_name"),
        )

    def raw_users(self) -> DataFrame:
        mail = F.concat(_named("user_", "c_custkey"), F.lit("@example.com"))
        return self.table("customer").select(
            F.array(
                F.struct(F.lit(True).alias("primary"), F.lit("work").alias("type"), mail.alias("value"))
            ).alias("emails"),
            (F.col("c_acctbal") >= 0).alias("active"),
            F.col("c_name").alias("displayName"),
            _named("ext-", "c_custkey").alias("externalId"),
            _text("c_custkey").alias("id"),
            F.struct(F.col("c_mktsegment").alias("familyName"), F.col("c_name").alias("givenName")).alias("name"),
            F.array(F.struct(F.lit("direct").alias("type"), F.col("c_mktsegment").alias("value"))).alias("roles"),
            mail.alias("userName"),
        )

    def raw_workspace_assignments(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.table("customer").select(
            F.array(F.when(F.col("c_acctbal") < 0, "ADMIN").otherwise("USER")).alias("permissions"),
            F.struct(
                key.alias("principal_id"),
                F.col("c_name").alias("display_name"),
                F.when(key % 4 != 3, _named("user_", "c_custkey")).alias("user_name"),
                F.when(key % 3 == 0, F.col("c_mktsegment")).alias("group_name"),
                F.when(key % 3 == 1, _named("app_", "c_custkey")).alias("service_principal_name"),
            ).alias("principal"),
            F.col("c_nationkey").cast("bigint").alias("workspace_id"),
        )

    def raw_clusters(self) -> DataFrame:
        key = F.col("p_partkey")
        version = F.concat(_text("p_size"), F.lit("."), (key % 4).cast("string"), F.lit(".x-scala2.12"))
        owner = _owner("p_partkey", F.col("p_brand"))
        # The tag key differs from the one looked up in case only.
        tags = F.when(owner.isNull(), F.create_map(F.lit("Env-Name"), F.lit("x"))).otherwise(
            F.create_map(F.lit("Owner"), owner)
        )
        return self.table("part").select(
            F.col("p_name").alias("cluster_name"),
            F.when(key % 13 == 0, "custom-image").otherwise(version).alias("spark_version"),
            F.col("p_type").alias("node_type_id"),
            F.col("p_type").alias("driver_node_type_id"),
            tags.alias("custom_tags"),
            F.col("p_size").alias("autotermination_minutes"),
            F.lit("STANDARD").alias("runtime_engine"),
            F.lit("SINGLE_USER").alias("data_security_mode"),
            F.col("p_brand").alias("single_user_name"),
            _named("c", "p_partkey").alias("cluster_id"),
            key.alias("spark_context_id"),
            (F.col("p_size") * 1024).alias("cluster_memory_mb"),
            F.col("p_size").cast("float").alias("cluster_cores"),
            F.create_map(F.lit("Vendor"), F.col("p_brand")).alias("default_tags"),
            (key % 25).alias("workspace_id"),
        )

    def raw_warehouses(self) -> DataFrame:
        owner = _owner("s_suppkey", _named("owner_", "s_nationkey"))

        def pair(key, value):
            return F.create_map(F.lit("key"), F.lit(key), F.lit("value"), value)

        env = pair("env", F.lit("x"))
        tags = F.when(owner.isNull(), F.array(env)).otherwise(F.array(env, pair("owner", owner)))
        return self.table("supplier").select(
            F.lit(10).alias("auto_stop_mins"),
            F.col("s_name").alias("creator_name"),
            F.lit(True).alias("enable_photon"),
            (F.col("s_acctbal") >= 5000).alias("enable_serverless_compute"),
            _named("w", "s_suppkey").alias("id"),
            F.col("s_name").alias("name"),
            F.lit("COST_OPTIMIZED").alias("spot_instance_policy"),
            F.struct(tags.alias("custom_tags")).alias("tags"),
            F.lit("PRO").alias("warehouse_type"),
            F.col("s_nationkey").cast("bigint").alias("workspace_id"),
        )

    def raw_cluster_acl(self) -> DataFrame:
        lines = self.table("lineitem").withColumns({"line": F.col("l_linenumber"), "user_key": F.col("l_orderkey")})
        level = F.when(F.col("l_linestatus") == "F", "CAN_MANAGE").otherwise("CAN_RESTART")
        return _acl(
            lines,
            _named("c", "l_partkey"),
            F.col("l_partkey") % 25,
            "l_suppkey",
            F.concat(F.lit("grp_"), F.col("l_returnflag")),
            _permissions(level, F.col("l_quantity") > 25, "/clusters/"),
        )

    def raw_warehouse_acl(self) -> DataFrame:
        lines = self.table("lineitem").withColumns({"line": F.col("l_linenumber"), "user_key": F.col("l_orderkey")})
        level = F.when(F.col("l_returnflag") == "A", "IS_OWNER").otherwise("CAN_USE")
        return _acl(
            lines,
            _named("w", "l_suppkey"),
            F.col("l_suppkey") % 25,
            "l_partkey",
            F.concat(F.lit("grp_"), F.col("l_linestatus")),
            _permissions(level, F.col("l_discount") > 0.05, "/sql/warehouses/"),
        )

    def raw_dashboard_acl(self) -> DataFrame:
        orders = self.table("orders").withColumns({"line": F.col("o_orderkey"), "user_key": F.col("o_custkey")})
        level = F.when(F.col("o_orderstatus") == "F", "CAN_MANAGE").otherwise("CAN_READ")
        return _acl(
            orders,
            _named("d", "o_orderkey"),
            F.col("o_custkey") % 25,
            "o_custkey",
            F.col("o_orderpriority"),
            _permissions(level, F.col("o_totalprice") > 100000, "/dashboards/"),
        )

    def raw_volume_acl(self) -> DataFrame:
        events = self.table("events").withColumns({"line": F.col("event_id"), "user_key": F.col("user_id")})
        level = F.when(F.col("event_type") == "error", "WRITE_VOLUME").otherwise("READ_VOLUME")
        return _acl(
            events,
            _named("v", "user_id"),
            F.col("user_id") % 25,
            "user_id",
            F.col("event_type"),
            _permissions(level, F.col("value") > 10, "/volumes/"),
        )

    def raw_runtime_pages(self) -> DataFrame:
        """The stored pages, each with a release list of its own put into its article.

        The list stands between heading and table, and a second table follows.
        """
        key = F.col("page_id")
        number = F.concat((key % 20).cast("string"), F.lit("."), (key % 4).cast("string"))
        version = F.concat(number, F.when(key % 3 == 0, " LTS").otherwise(""))
        released = F.date_add(F.lit("2022-06-01").cast("date"), (key % 1000).cast("int"))
        ended = F.date_add(F.lit("2024-06-01").cast("date"), (key % 1000).cast("int"))

        def cell(value):
            return F.concat(F.lit("<td>"), value, F.lit("</td>"))

        section = F.concat(
            F.lit(f'<h2 id="{RELEASE_ANCHOR}">Releases</h2><ul><li>All releases</li></ul>'),
            F.lit("<table><thead><tr><th>Version</th><th>Variants</th><th>Release date</th>"),
            F.lit("<th>End-of-support date</th><th>Engine version</th></tr></thead><tbody><tr>"),
            cell(version),
            cell(F.concat(F.lit("Std &amp; ML "), _text("page_id"))),
            cell(F.date_format(released, "MMM d, yyyy")),
            cell(F.date_format(ended, "MMMM d, yyyy")),
            cell(F.concat(F.lit("e"), _text("page_id"))),
            F.lit("</tr></tbody></table><table><tr><th>Version</th></tr><tr><td>old</td></tr></table></article>"),
        )
        html = F.replace(F.col("html"), F.lit("</article>"), section)
        return self.table("pages").select("page_id", "url", html.alias("html"))

    def raw(self, entity: str) -> DataFrame:
        return getattr(self, f"raw_{entity}")()

    def entities(self) -> list[str]:
        return list(RAW)

    def land(self, entity: str, landing_dir: str) -> None:
        """Write an entity as collectors land it, one directory per workspace.

        The rebalance evens out the files: a large workspace is split, small ones
        are not spread over every task. Files are compressed, as names and levels
        repeat in every line.
        """
        raw, path = self.raw(entity), f"{landing_dir}/{entity}"
        if entity in ("workspaces", "users", "runtime_pages"):
            raw.write.options(**GZIP).json(path)
        else:
            raw.hint("rebalance", "workspace_id").write.options(**GZIP).partitionBy("workspace_id").json(path)

    # Published entities.

    def workspaces(self) -> DataFrame:
        return landing.workspaces(normalize_schema(self.raw_workspaces()))

    def users(self) -> DataFrame:
        return inventory.flat_users(landing.users(normalize_schema(self.raw_users())))

    def workspace_privileges(self) -> DataFrame:
        raw = normalize_schema(self.raw_workspace_assignments())
        return inventory.flatten_assignments(landing.workspace_assignments(raw))

    def clusters(self) -> DataFrame:
        return inventory.owned_clusters(landing.clusters(normalize_schema(self.raw_clusters())))

    def warehouses(self) -> DataFrame:
        return inventory.owned_warehouses(landing.warehouses(normalize_schema(self.raw_warehouses())))

    def _object_privileges(self, kind: str) -> DataFrame:
        raw = normalize_schema(self.raw(f"{kind.removesuffix('s')}_acl"))
        return inventory.flatten_acl(landing.object_acls(raw, kind), landing.ACL_KEY[kind])

    def cluster_privileges(self) -> DataFrame:
        return self._object_privileges("clusters")

    def warehouse_privileges(self) -> DataFrame:
        return self._object_privileges("warehouses")

    def dashboard_privileges(self) -> DataFrame:
        return self._object_privileges("dashboards")

    def volume_acl_privileges(self) -> DataFrame:
        """Access lists of volumes; the catalog's grants on volumes are another table."""
        return self._object_privileges("volumes")

    def runtime_versions(self) -> DataFrame:
        """Listed runtimes, staged: a small dimension out of a large table.

        Every part lists one, under a shifted number, so that clusters of low numbers run on unlisted ones.
        """
        size, key = F.col("p_size") + 5, F.col("p_partkey")
        lts = F.when(size % 3 == 0, " LTS").otherwise("")
        version = F.concat(size.cast("string"), F.lit("."), (key % 4).cast("string"), lts)

        def day(start):
            return F.date_add(F.lit(start).cast("date"), size * 30).cast("timestamp")

        listed = self.table("part").select(
            version.alias("version"),
            F.lit("Standard").alias("variants"),
            day("2022-06-01").alias("release_date"),
            day("2023-06-01").alias("end_of_support_date"),
        )
        return inventory.numbered_runtimes(stage(listed.distinct(), "runtime-versions"))

    # Catalog metadata.

    def _places(self) -> DataFrame:
        return _places(self.table("nation"), self.table("region"))

    def _customer_places(self) -> DataFrame:
        customer = self.table("customer").select("c_custkey", "c_name", "c_nationkey")
        return customer.join(self._places(), F.col("c_nationkey") == F.col("n_nationkey"))

    def _supplier_places(self) -> DataFrame:
        supplier = self.table("supplier").select("s_suppkey", "s_nationkey")
        return supplier.join(self._places(), F.col("s_nationkey") == F.col("n_nationkey"))

    def metastores(self) -> DataFrame:
        return self.table("region").select(
            _named("m", "r_regionkey").alias("metastore_id"),
            F.when(F.col("r_regionkey") == 0, "System user").otherwise("platform").alias("metastore_owner"),
        )

    def metastore_privileges(self) -> DataFrame:
        return _grants(
            self.table("nation"), "n_name", "CREATE CATALOG", metastore_id=_named("m", "n_regionkey")
        )

    def catalogs(self) -> DataFrame:
        key = F.col("r_regionkey")
        return self.table("region").select(
            F.col("r_name").alias("catalog_name"),
            F.when(key == 1, None).otherwise(_named("owner_", "r_regionkey")).alias("catalog_owner"),
        )

    def catalog_privileges(self) -> DataFrame:
        return _grants(
            self._customer_places(), "c_name", "USE CATALOG", inherited="METASTORE", catalog_name=F.col("catalog")
        )

    def schemata(self) -> DataFrame:
        owner = F.when(F.col("n_nationkey") % 11 == 0, "System user").otherwise(F.col("place_owner"))
        return self._places().select(
            F.col("catalog").alias("catalog_name"), F.col("schema").alias("schema_name"), owner.alias("schema_owner")
        )

    def schema_privileges(self) -> DataFrame:
        return _grants(
            self._customer_places(),
            "c_name",
            "USE SCHEMA",
            inherited="CATALOG",
            catalog_name=F.col("catalog"),
            schema_name=F.col("schema"),
        )

    def tables(self) -> DataFrame:
        owner = F.when(F.col("c_custkey") % 11 == 0, "System user").otherwise(F.col("place_owner"))
        return self._customer_places().select(
            F.col("catalog").alias("table_catalog"),
            F.col("schema").alias("table_schema"),
            _named("t", "c_custkey").alias("table_name"),
            owner.alias("table_owner"),
        )

    def table_privileges(self) -> DataFrame:
        orders = self.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
        return _grants(
            orders.join(self._customer_places(), F.col("o_custkey") == F.col("c_custkey")),
            "o_orderpriority",
            F.when(F.col("o_orderstatus") == "F", "SELECT").otherwise("MODIFY"),
            grantable=F.when(F.col("o_orderkey") % 2 == 0, "YES").otherwise("NO"),
            inherited="SCHEMA",
            table_catalog=F.col("catalog"),
            table_schema=F.col("schema"),
            table_name=_named("t", "c_custkey"),
        )

    def volumes(self) -> DataFrame:
        return self._supplier_places().select(
            F.col("catalog").alias("volume_catalog"),
            F.col("schema").alias("volume_schema"),
            _named("v", "s_suppkey").alias("volume_name"),
            F.col("place_owner").alias("volume_owner"),
        )

    def volume_privileges(self) -> DataFrame:
        lines = self.table("lineitem").select("l_orderkey", "l_suppkey")
        granted = lines.join(self._supplier_places(), F.col("l_suppkey") == F.col("s_suppkey"))
        return _grants(
            granted.withColumn("user", _named("user_", "l_orderkey")),
            "user",
            "READ VOLUME",
            volume_catalog=F.col("catalog"),
            volume_schema=F.col("schema"),
            volume_name=_named("v", "s_suppkey"),
        )

    def connections(self) -> DataFrame:
        brands = stage(self.table("part").select("p_brand").distinct(), "connections")
        return brands.select(
            F.col("p_brand").alias("connection_name"), _named("owner_", "p_brand").alias("connection_owner")
        )

    def connection_privileges(self) -> DataFrame:
        return _grants(self.table("part"), "p_name", "USE CONNECTION", connection_name=F.col("p_brand"))

    def external_locations(self) -> DataFrame:
        segments = stage(self.table("customer").select("c_mktsegment").distinct(), "external-locations")
        return segments.select(
            F.col("c_mktsegment").alias("external_location_name"), F.lit("platform").alias("external_location_owner")
        )

    def external_location_privileges(self) -> DataFrame:
        return _grants(
            self.table("customer"),
            "c_name",
            "READ FILES",
            grantable="YES",
            external_location_name=F.col("c_mktsegment"),
        )
