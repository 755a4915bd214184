"""Published form of each inventory entity."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custodia.functions.names import snake_name
from custodia.functions.scalars import (
    acl_display_name,
    assignment_display_name,
    drop_cols,
    first_field,
    first_of,
    flatten_struct,
    map_value,
    parse_ts,
    principal_type,
    runtime_number,
    strip_lts,
    tag_value,
)
from custodia.operators.keys import DuplicateKeyError, check_key
from custodia.sources.html_tables import cell, may_have_anchor, table_cells
from custodia.storage import stage

# Headers of the release table that downstream reports use. Fixed values.
RELEASE_HEADERS = ("Version", "Variants", "Release date", "End-of-support date")


def flatten_acl(df: DataFrame, key: str) -> DataFrame:
    """One row per access-list entry with its first permission and its principal."""
    typed = df.withColumn("type", principal_type("group_name", "service_principal_name", "user_name"))
    return typed.select(
        key,
        acl_display_name("type", "group_name", "user_name", "display_name").alias("display_name"),
        "workspace_id",
        first_field("all_permissions", "inherited").alias("inherited"),
        first_field("all_permissions", "inherited_from_object").alias("inherited_from_object"),
        first_field("all_permissions", "permission_level").alias("privilege_type"),
        "type",
    )


def flatten_assignments(df: DataFrame) -> DataFrame:
    """One row per principal of a workspace with its first permission."""
    typed = df.withColumn(
        "type",
        principal_type("principal.group_name", "principal.service_principal_name", "principal.user_name"),
    )
    return typed.select(
        "workspace_id",
        first_of("permissions").alias("privilege_type"),
        F.col("principal.principal_id").alias("principal_id"),
        "type",
        assignment_display_name("type", "principal.user_name", "principal.display_name").alias("display_name"),
    )


def flat_users(users: DataFrame) -> DataFrame:
    return drop_cols(flatten_struct(users, "name", ["givenname", "familyname"]), "name", "emails")


def owned_clusters(clusters: DataFrame) -> DataFrame:
    """Clusters with the owner tag and the number of their runtime."""
    return clusters.withColumns(
        {"owner": map_value("custom_tags", "owner"), "spark_version_number": runtime_number("spark_version")}
    )


def owned_warehouses(warehouses: DataFrame) -> DataFrame:
    return warehouses.withColumn("owner", tag_value("tags.custom_tags", "owner"))


def serverless_warehouses(warehouses: DataFrame) -> DataFrame:
    return warehouses.filter("enable_serverless_compute").select("id", "name")


def numbered_runtimes(runtimes: DataFrame) -> DataFrame:
    return runtimes.withColumn("spark_version_number", strip_lts("version"))


#: Pages that are parsed in the first step of the search for the newest release table, and by how much steps grow.
FIRST_PAGES, GROWTH = 64, 8


def release_rows(pages: DataFrame, anchor_id: str) -> DataFrame:
    """Rows of the release table of the newest stored page that has one, the one with the highest id.

    Pages that cannot have the table are left out without parsing them. Of the others,
    the newest are parsed first, then ever more older ones until one has the table, so
    no page is parsed twice and most are not parsed at all. Rows are returned from the
    stored result of the parsing. The driver reads two ids for each step. Pages without
    an id are never the newest.
    """
    possible = pages.filter(may_have_anchor("html", anchor_id) & F.col("page_id").isNotNull())
    ids = stage(possible.select("page_id").distinct(), "release-pages")
    below, n_pages = F.lit(True), FIRST_PAGES
    while True:
        batch = ids.filter(below).orderBy(F.col("page_id").desc()).limit(n_pages)
        lowest, n_found = batch.agg(F.min("page_id"), F.count("*")).first()
        within = below & (F.col("page_id") >= F.lit(lowest)) if n_found else F.lit(False)
        rows = stage(table_cells(possible.filter(within).select("page_id", "html"), anchor_id), "release-rows")
        newest = rows.agg(F.max("page_id")).first()[0]
        if newest is not None or n_found < n_pages:
            return rows.filter(F.col("page_id") == F.lit(newest))
        below, n_pages = F.col("page_id") < F.lit(lowest), n_pages * GROWTH


def runtime_versions(pages: DataFrame, anchor_id: str, headers=RELEASE_HEADERS) -> DataFrame:
    """Runtimes listed in the release table of stored pages, with all its columns.

    ``headers`` must be in the table; others follow in its order. The driver reads
    the names from one row. Fails if a runtime number is missing or listed twice.
    """
    rows = release_rows(pages, anchor_id)
    needed = [snake_name(header) for header in headers]
    first = rows.select(F.map_keys("cells").alias("names")).first()
    names = needed + [name for name in (first.names if first else []) if name not in needed]
    runtimes = rows.select(*[cell(name).alias(name) for name in names])
    dates = [name for name in needed if name.endswith("_date")]
    numbered = numbered_runtimes(runtimes.withColumns({name: parse_ts(name) for name in dates}))
    wrong = check_key(numbered, ["spark_version_number"]).first()
    if wrong:
        raise DuplicateKeyError(f"runtime {wrong.spark_version_number} is listed {wrong.n_rows} times")
    return numbered
