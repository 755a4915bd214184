
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custodia.functions.names import normalize_columns, normalize_map, slug, snake
from custodia.functions.scalars import parse_ts
from custodia.operators import inventory, keys
from custodia.operators.export import export_review, owner_counts, owner_files
from custodia.operators.keyed import ensure_keyed_table, upsert_table
from custodia.operators.sinks import ensure_namespace, publish
from custodia.operators.versions import publish_version
from custodia.plans.owner_counts import owner_totals, renew_owner_counts
from custodia.plans.privileges import KINDS, all_privileges, branch, privileges_by_owner
from custodia.plans.refresh import TABLES, VOLUME_TABLE, refresh
from custodia.plans.review import ReviewTables, create_review, newest_review_id, snapshot
from custodia.plans.support import cluster_version_support, support_counter, support_histogram, support_table
from custodia.plans.views import create_views, register_views
from custodia.schemas import PRIVILEGE_COLUMNS
from custodia.sources.catalog import METADATA_TABLES, read_table
from custodia.sources.html_tables import extract_tables, nav_links
from custodia.sources.landing import read_inventory
from custodia.sources.reviews import read_reviews_csv
from custodia.storage import new_folder, stage
from custodia.streaming.review_import import import_reviews
from custodia.testbed import AS_OF, RELEASE_ANCHOR, Testbed
from oracles import ORACLES

SMOKE_DIR = "/root/testdata/sf0.001"

Query = Callable[[Testbed], DataFrame]

REVIEW_COLUMNS = ["access_review_id", "outcome_id", *PRIVILEGE_COLUMNS]


def _plain_sources(privileges: DataFrame) -> DataFrame:
    """Access list with its source list as one text."""
    return privileges.withColumn(
        "inherited_from_object", F.array_join("inherited_from_object", ",")
    ).withColumnRenamed("inherited_from_object", "inherited_from")


def _users(users: DataFrame) -> DataFrame:
    role = F.concat_ws(":", F.col("roles")[0]["type"], F.col("roles")[0]["value"])
    return users.withColumn("role", role).drop("roles")


def _clusters(clusters: DataFrame) -> DataFrame:
    return clusters.select(
        "cluster_id", "cluster_name", "workspace_id", "spark_version", "owner", "spark_version_number"
    )


def _warehouses(warehouses: DataFrame) -> DataFrame:
    return warehouses.select("id", "name", "workspace_id", "enable_serverless_compute", "owner")


def _landed(tb: Testbed, table: str) -> DataFrame:
    """A published relation by way of landed JSON files."""
    entity, build = (TABLES | VOLUME_TABLE)[table]
    landing = new_folder(tb.spark, "landing")
    tb.land(entity, landing)
    return build(read_inventory(tb.spark, f"{landing}/{entity}", entity))


def _schema(tb: Testbed, name: str) -> tuple[str, str]:
    """Name and folder of a new schema."""
    folder = new_folder(tb.spark, name)
    return folder.rsplit("/", 1)[1].replace("-", "_"), folder


def _refresh(tb: Testbed) -> str:
    landing = new_folder(tb.spark, "landing")
    for entity in tb.entities():
        tb.land(entity, landing)
    schema, folder = _schema(tb, "inventory")
    refresh(tb.spark, landing, schema, RELEASE_ANCHOR, volumes=True, location=folder)
    return schema


def refresh_tables(tb: Testbed) -> DataFrame:
    schema = _refresh(tb)
    counts = [
        read_table(tb.spark, f"{schema}.{table}").select(F.lit(table).alias("table_name"))
        for table in ["runtime_versions", *TABLES, *VOLUME_TABLE]
    ]
    return keys.union_frames([df.groupBy("table_name").agg(F.count("*").alias("n_rows")) for df in counts])


def published_runtime_versions(tb: Testbed) -> DataFrame:
    """The release table of the newest stored page, published with all its columns."""
    schema, folder = _schema(tb, "published")
    ensure_namespace(tb.spark, schema, folder)
    landing = new_folder(tb.spark, "landing")
    tb.land("runtime_pages", landing)
    pages = read_inventory(tb.spark, f"{landing}/runtime_pages", "runtime_pages")
    return publish(inventory.runtime_versions(pages, RELEASE_ANCHOR), f"{schema}.runtime_versions")


def view_counts(tb: Testbed) -> DataFrame:
    inventory_schema, folder = _schema(tb, "inventory")
    ensure_namespace(tb.spark, inventory_schema, folder)
    metadata_schema, folder = _schema(tb, "metadata")
    ensure_namespace(tb.spark, metadata_schema, folder)
    for name, df in (tb.frames() | {"runtime_versions": tb.runtime_versions()}).items():
        publish(df, f"{metadata_schema if name in METADATA_TABLES else inventory_schema}.{name}")
    register_views(tb.spark, inventory_schema, metadata_schema, AS_OF)
    return tb.spark.sql(
        """
        SELECT object_type, privilege_type, count(*) AS n_rows FROM all_privileges GROUP BY ALL
        UNION ALL
        SELECT 'supported cluster', variants, count(*) FROM cluster_version_support GROUP BY ALL
        """
    )


def _reviews(tb: Testbed) -> DataFrame:
    """Review headers: one per order year."""
    return _review_rows(tb).select("access_review_id").distinct()


def _review_rows(tb: Testbed) -> DataFrame:
    return tb.table("orders").select(
        F.year("o_orderdate").cast("bigint").alias("access_review_id"),
        F.lit(3).alias("outcome_id"),
        F.concat(F.lit("d"), F.col("o_orderkey").cast("string")).alias("object_name"),
        F.col("o_orderpriority").alias("object_owner"),
        F.col("o_custkey").cast("string").alias("grantee"),
    )


def _review_detail(tb: Testbed) -> DataFrame:
    """Review rows with all columns of the detail."""
    rows = _review_rows(tb)
    missing = [name for name in REVIEW_COLUMNS if name not in rows.columns]
    return rows.select("*", *[F.lit("-").alias(name) for name in missing]).select(*REVIEW_COLUMNS)


def _exported(tb: Testbed) -> str:
    """Folder with the exported snapshot of all privileges."""
    reviews = _reviews(tb)
    rows = snapshot(all_privileges(tb.frames()), newest_review_id(reviews))
    detail = stage(keys.assign_ids(rows, "access_review_detail_id"), "detail")
    folder = new_folder(tb.spark, "export")
    export_review(detail, reviews, folder, compressed=True)
    return folder


def published(tb: Testbed, table: str) -> DataFrame:
    """One published table, by way of landed files."""
    schema, folder = _schema(tb, "published")
    ensure_namespace(tb.spark, schema, folder)
    return publish(_landed(tb, table), f"{schema}.{table}")


def stored_schema(tb: Testbed) -> str:
    """A schema with all tables and both views."""
    schema, folder = _schema(tb, "views")
    ensure_namespace(tb.spark, schema, folder)
    publish_version(tb.spark, schema, tb.frames() | {"runtime_versions": tb.runtime_versions()})
    create_views(tb.spark, schema, schema, schema)
    return schema


def stored_support(tb: Testbed) -> DataFrame:
    support = tb.spark.table(f"{stored_schema(tb)}.cluster_version_support")
    # Days count from the time of the query.
    return support.drop("days_until_end_of_support")


def stored_owner_counts(tb: Testbed) -> DataFrame:
    """Counts kept per kind, renewed after the grants on one kind were published again."""
    schema = stored_schema(tb)
    grants = KINDS["cluster"].grants
    publish(tb.frame(grants).limit(0), f"{schema}.{grants}")
    renew_owner_counts(tb.spark, schema, schema, schema)
    publish(tb.frame(grants), f"{schema}.{grants}")
    renew_owner_counts(tb.spark, schema, schema, schema)
    return owner_totals(tb.spark, schema)


def created_review(tb: Testbed) -> DataFrame:
    schema, folder = _schema(tb, "reviews")
    create_review(all_privileges(tb.frames()), schema, by="tester", at=AS_OF, location=folder)
    tables = ReviewTables(schema)
    detail, reviews, outcomes = (read_table(tb.spark, t) for t in (tables.detail, tables.reviews, tables.outcomes))
    rows = keys.latest_review(detail, reviews).join(reviews, "access_review_id").join(outcomes, "outcome_id")
    return rows.select(*REVIEW_COLUMNS, "outcome_value", "created_by", "created_date")


def export_numbers(tb: Testbed) -> DataFrame:
    """Per file name: how many rows, and whether they are numbered from 0 without a gap; files are small."""
    reviews = _reviews(tb)
    detail = keys.assign_ids(_review_detail(tb), "access_review_detail_id")
    folder = new_folder(tb.spark, "export")
    export_review(stage(detail, "detail"), reviews, folder, rows_per_file=100)
    number = F.col("_c0").cast("long")
    return read_reviews_csv(tb.spark, folder).groupBy("object_owner").agg(
        F.count("*").alias("n_rows"),
        F.count_distinct(number).alias("n_numbers"),
        F.min(number).alias("lowest"),
        F.max(number).alias("highest"),
    )


def exported_review(tb: Testbed) -> DataFrame:
    return read_reviews_csv(tb.spark, _exported(tb)).select(*REVIEW_COLUMNS)


def csv_import(tb: Testbed) -> DataFrame:
    schema, folder = _schema(tb, "import")
    ensure_namespace(tb.spark, schema, folder)
    checkpoint = new_folder(tb.spark, "checkpoint")
    imported = import_reviews(tb.spark, _exported(tb), f"{schema}.access_review_import", checkpoint)
    return imported.select(
        *REVIEW_COLUMNS,
        F.col("import_file_name").endswith(".csv").alias("from_csv"),
        F.col("import_timestamp").isNotNull().alias("has_time"),
    )


def identity_ids(tb: Testbed) -> DataFrame:
    numbered = keys.assign_ids(tb.table("lineitem"), "line_id", start=100)
    return numbered.agg(
        F.count("*").alias("n_rows"),
        F.count_distinct("line_id").alias("n_ids"),
        (F.min("line_id") >= 100).alias("from_start"),
    )


def _outcome_frames(tb: Testbed) -> tuple[DataFrame, DataFrame]:
    """Outcomes by order, and changed and added ones."""
    orders = tb.table("orders")
    target = orders.select(F.col("o_orderkey").alias("outcome_id"), F.col("o_orderstatus").alias("outcome_value"))
    changed = orders.filter("o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("outcome_id"), F.lit("Approved").alias("outcome_value")
    )
    added = orders.filter("o_orderstatus = 'O'").select(
        (-1 - F.col("o_orderkey")).alias("outcome_id"), F.col("o_orderpriority").alias("outcome_value")
    )
    return target, changed.unionByName(added)


def outcomes_upsert(tb: Testbed) -> DataFrame:
    return keys.upsert(*_outcome_frames(tb), ["outcome_id"])


def stored_outcomes_upsert(tb: Testbed) -> DataFrame:
    """The same by way of two merges into a keyed table."""
    schema, folder = _schema(tb, "outcomes")
    ensure_namespace(tb.spark, schema, folder)
    table = f"{schema}.outcomes"
    frames = _outcome_frames(tb)
    ensure_keyed_table(tb.spark, table, frames[0].schema, ["outcome_id"], required=["outcome_value"])
    for frame in frames:
        upsert_table(frame, table)
    return tb.spark.table(table)


def union_frames(tb: Testbed) -> DataFrame:
    customers = tb.table("customer").selectExpr("c_custkey AS id", "c_name AS name", "c_mktsegment AS segment")
    return keys.union_frames([customers, tb.table("supplier").selectExpr("s_suppkey AS id", "s_name AS name")])


def normalized_tags(tb: Testbed) -> DataFrame:
    tags = F.create_map(
        F.lit("Owner"), F.col("p_name"), F.lit("Cost-Center"), F.col("p_brand"), F.lit("owner"), F.col("p_type")
    )
    return tb.table("part").select("p_partkey", F.explode(normalize_map(tags)).alias("key", "value"))


def owner_slug(tb: Testbed) -> DataFrame:
    review = snapshot(all_privileges(tb.frames()), 2024)
    return owner_files(review, rows_per_file=1_000_000).select("object_owner", "owner_slug", "n_rows")


def html_tables(tb: Testbed) -> DataFrame:
    headers = {
        "Version": "version",
        "Variants": "variants",
        "Release date": "release_date",
        "End-of-support date": "end_of_support_date",
        "Engine version": "engine_version",
    }
    rows = extract_tables(tb.raw_runtime_pages(), RELEASE_ANCHOR, headers)
    dated = rows.withColumns({name: parse_ts(name) for name in ("release_date", "end_of_support_date")})
    return inventory.numbered_runtimes(dated)


def _branch(kind: str) -> Query:
    return lambda tb: branch(kind, tb.frame(KINDS[kind].grants), tb.frame(KINDS[kind].objects))


QUERIES: dict[str, Query] = {
    # Inventory.
    "workspaces": lambda tb: tb.workspaces(),
    "users_flat": lambda tb: _users(tb.users()),
    "workspace_privileges": lambda tb: tb.workspace_privileges(),
    "clusters_owner": lambda tb: _clusters(tb.clusters()),
    "warehouses_owner": lambda tb: _warehouses(tb.warehouses()),
    "cluster_privileges": lambda tb: _plain_sources(tb.cluster_privileges()),
    "warehouse_privileges": lambda tb: _plain_sources(tb.warehouse_privileges()),
    "dashboard_privileges": lambda tb: _plain_sources(tb.dashboard_privileges()),
    "volume_privileges": lambda tb: _plain_sources(tb.volume_acl_privileges()),
    "serverless_warehouses": lambda tb: inventory.serverless_warehouses(tb.warehouses()),
    "runtime_versions": lambda tb: tb.runtime_versions(),
    "union_frames": union_frames,
    # Landing.
    "landed_workspaces": lambda tb: _landed(tb, "workspaces"),
    "landed_users": lambda tb: _users(_landed(tb, "users")),
    "landed_assignments": lambda tb: _landed(tb, "workspace_privileges"),
    "landed_clusters": lambda tb: _clusters(_landed(tb, "clusters")),
    "landed_warehouses": lambda tb: _warehouses(_landed(tb, "warehouses")),
    "landed_cluster_acl": lambda tb: _plain_sources(_landed(tb, "cluster_privileges")),
    "landed_warehouse_acl": lambda tb: _plain_sources(_landed(tb, "warehouse_privileges")),
    "landed_dashboard_acl": lambda tb: _plain_sources(_landed(tb, "dashboard_privileges")),
    "landed_volume_acl": lambda tb: _plain_sources(_landed(tb, "volume_privileges")),
    "refresh_tables": refresh_tables,
    "published_users": lambda tb: _users(published(tb, "users")),
    "published_workspaces": lambda tb: published(tb, "workspaces"),
    "published_workspace_privileges": lambda tb: published(tb, "workspace_privileges"),
    "published_clusters": lambda tb: _clusters(published(tb, "clusters")),
    "published_warehouses": lambda tb: _warehouses(published(tb, "warehouses")),
    "published_cluster_privileges": lambda tb: _plain_sources(published(tb, "cluster_privileges")),
    "published_warehouse_privileges": lambda tb: _plain_sources(published(tb, "warehouse_privileges")),
    "published_dashboard_privileges": lambda tb: _plain_sources(published(tb, "dashboard_privileges")),
    "published_volume_privileges": lambda tb: _plain_sources(published(tb, "volume_privileges")),
    "published_runtime_versions": published_runtime_versions,
    # Support windows.
    "cluster_version_support": lambda tb: cluster_version_support(tb.clusters(), tb.runtime_versions(), AS_OF),
    "support_table": lambda tb: support_table(
        cluster_version_support(tb.clusters(), tb.runtime_versions(), AS_OF)
    ),
    "support_histogram": lambda tb: support_histogram(tb.clusters(), tb.runtime_versions()),
    "support_counter": lambda tb: support_counter(tb.clusters(), tb.runtime_versions(), AS_OF),
    # Privileges.
    **{f"branch_{kind}": _branch(kind) for kind in KINDS},
    "all_privileges": lambda tb: all_privileges(tb.frames()),
    "privileges_by_owner": lambda tb: privileges_by_owner(tb.frames()),
    "stored_owner_counts": stored_owner_counts,
    "owners": lambda tb: keys.owners(all_privileges(tb.frames())),
    "owner_rows": lambda tb: keys.rows_of_owner(all_privileges(tb.frames()), "owner_3"),
    "view_counts": view_counts,
    "stored_privileges": lambda tb: tb.spark.table(f"{stored_schema(tb)}.all_privileges"),
    "stored_support": stored_support,
    # Reviews.
    "latest_id": lambda tb: keys.latest_id(_reviews(tb), "access_review_id"),
    "latest_review": lambda tb: keys.latest_review(_review_rows(tb), _reviews(tb)),
    "owner_counts": lambda tb: owner_counts(_review_rows(tb), _reviews(tb)),
    "review_snapshot": lambda tb: snapshot(all_privileges(tb.frames()), newest_review_id(_reviews(tb))),
    "created_review": created_review,
    "exported_review": exported_review,
    "export_numbers": export_numbers,
    "csv_import": csv_import,
    "identity_ids": identity_ids,
    "outcomes_upsert": outcomes_upsert,
    "stored_outcomes_upsert": stored_outcomes_upsert,
    "key_violations": lambda tb: keys.check_key(tb.table("lineitem"), ["l_orderkey", "l_linenumber"]),
    # Names and keys.
    "snake_keys": lambda tb: tb.table("part").select(
        "p_partkey", snake("p_name").alias("name_key"), snake("p_type").alias("type_key")
    ),
    "snake_text": lambda tb: tb.table("documents").select("doc_id", snake("text").alias("key")),
    "normalized_columns": lambda tb: normalize_columns(
        tb.table("part").select(F.col("p_partkey").alias("Part Key"), F.col("p_name").alias("Part-Name"))
    ),
    "normalized_tags": normalized_tags,
    "owner_slug": owner_slug,
    "text_slug": lambda tb: tb.table("documents").select("doc_id", slug("text").alias("slug")),
    "unicode_slug": lambda tb: tb.table("documents").select("doc_id", slug("text", True).alias("slug")),
    # Pages.
    "html_nav_links": lambda tb: nav_links(tb.table("pages")),
    "html_tables": html_tables,
}


def entry(spark: SparkSession) -> DataFrame:
    """Every privilege on every object of the smoke tables."""
    return all_privileges(Testbed(spark, SMOKE_DIR).frames())


def _over_directory(query: Query) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: query(Testbed(spark, sf_dir))


def _text_operators() -> tuple[dict, dict]:
    """Queries and SQL of the text operators and their pipeline; none if they are not installed."""
    try:
        import corpus_pipeline
        from custodia.llm.oracles import ORACLES as text_oracles
        from custodia.llm.queries import QUERIES as text_queries
    except ImportError:
        return {}, {}
    sql = text_oracles | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
    return text_queries | {"pipeline": corpus_pipeline.run}, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _over_directory(query) for name, query in QUERIES.items()} | _text_operators()[0]


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES) | _text_operators()[1]
