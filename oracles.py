"""DuckDB SQL for the registered queries, over the same tables.

``SKIN`` names the governance entities as common table expressions; `_with`
puts the ones a query needs, in order, before it.
"""

AS_OF = "timestamp '2024-06-01 19:00:00'"

_TYPE = (
    "case when group_name is not null then 'Group' when service_principal_name is not null then 'Service Principal' "
    "when user_name is not null then 'User' else 'UNKNOWN' end"
)
_ACL_NAME = "case type when 'Group' then group_name when 'User' then user_name else display_name end"


def _acl(object_id, workspace, principal, line, user, group, level, inherited, source, table):
    """Flattened access list: entry columns, then the published ones."""
    return f"""
    select object_id, {_ACL_NAME} as display_name, workspace_id, inherited,
           case when inherited then '{source}' else '' end as inherited_from, privilege_type, type
    from (select *, {_TYPE} as type from (
        select concat({object_id}) as object_id, cast({workspace} % 25 as bigint) as workspace_id,
               concat('sp_', cast({principal} as varchar)) as display_name,
               case when {line} % 3 = 0 then {group} end as group_name,
               case when {line} % 3 = 1 then concat('app_', cast({principal} as varchar)) end as service_principal_name,
               case when {line} % 2 = 0 then concat('user_', cast({user} as varchar)) end as user_name,
               {level} as privilege_type, {inherited} as inherited
        from {table}))"""


SKIN = {
    "workspaces": """
    select 'a1' as account_id, cast(1700000000000 as bigint) as creation_time,
           lower(replace(n_name, '_', '-')) as deployment_name, r_name as location,
           case when n_nationkey % 3 = 0 then 'STANDARD' else 'PREMIUM' end as pricing_tier,
           cast(n_nationkey as bigint) as workspace_id, n_name as workspace_name
    from nation join region on n_regionkey = r_regionkey""",
    "users": """
    select c_acctbal >= 0 as active, c_name as displayname, concat('ext-', cast(c_custkey as varchar)) as externalid,
           cast(c_custkey as varchar) as id, concat('user_', cast(c_custkey as varchar), '@example.com') as username,
           c_name as givenname, c_mktsegment as familyname, concat('direct:', c_mktsegment) as role
    from customer""",
    "clusters": """
    select *, split_part(spark_version, '.x', 1) as spark_version_number from (
        select concat('c', cast(p_partkey as varchar)) as cluster_id, p_name as cluster_name,
               p_partkey % 25 as workspace_id,
               case when p_partkey % 13 = 0 then 'custom-image'
                    else concat(cast(p_size as varchar), '.', cast(p_partkey % 4 as varchar), '.x-scala2.12')
               end as spark_version,
               case when p_partkey % 7 = 0 then null when p_partkey % 11 = 0 then 'System user'
                    else p_brand end as owner
        from part)""",
    "runtime_versions": """
    select *, replace(version, ' LTS', '') as spark_version_number from (
        select distinct concat(cast(size as varchar), '.', cast(p_partkey % 4 as varchar),
                               case when size % 3 = 0 then ' LTS' else '' end) as version,
               'Standard' as variants,
               cast(date '2022-06-01' + size * 30 as timestamp) as release_date,
               cast(date '2023-06-01' + size * 30 as timestamp) as end_of_support_date
        from (select p_partkey, p_size + 5 as size from part))""",
    "support": f"""
    select cluster_id, cluster_name, coalesce(owner, 'Not tagged') as object_owner, c.spark_version_number,
           variants, release_date, end_of_support_date,
           date_sub('day', {AS_OF}, end_of_support_date) as days_until_end_of_support
    from clusters c join runtime_versions r on c.spark_version_number = r.spark_version_number""",
    "warehouses": """
    select concat('w', cast(s_suppkey as varchar)) as id, s_name as name, cast(s_nationkey as bigint) as workspace_id,
           s_acctbal >= 5000 as enable_serverless_compute,
           case when s_suppkey % 7 = 0 then null when s_suppkey % 11 = 0 then 'System user'
                else concat('owner_', cast(s_nationkey as varchar)) end as owner
    from supplier""",
    "cluster_privileges": _acl(
        "'c', cast(l_partkey as varchar)",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "l_orderkey",
        "concat('grp_', l_returnflag)",
        "case when l_linestatus = 'F' then 'CAN_MANAGE' else 'CAN_RESTART' end",
        "l_quantity > 25",
        "/clusters/",
        "lineitem",
    ),
    "warehouse_privileges": _acl(
        "'w', cast(l_suppkey as varchar)",
        "l_suppkey",
        "l_partkey",
        "l_linenumber",
        "l_orderkey",
        "concat('grp_', l_linestatus)",
        "case when l_returnflag = 'A' then 'IS_OWNER' else 'CAN_USE' end",
        "l_discount > 0.05",
        "/sql/warehouses/",
        "lineitem",
    ),
    "dashboard_privileges": _acl(
        "'d', cast(o_orderkey as varchar)",
        "o_custkey",
        "o_custkey",
        "o_orderkey",
        "o_custkey",
        "o_orderpriority",
        "case when o_orderstatus = 'F' then 'CAN_MANAGE' else 'CAN_READ' end",
        "o_totalprice > 100000",
        "/dashboards/",
        "orders",
    ),
    "volume_acl_privileges": _acl(
        "'v', cast(user_id as varchar)",
        "user_id",
        "user_id",
        "event_id",
        "user_id",
        "event_type",
        "case when event_type = 'error' then 'WRITE_VOLUME' else 'READ_VOLUME' end",
        "value > 10",
        "/volumes/",
        "events",
    ),
    "workspace_privileges": f"""
    select workspace_id, privilege_type, principal_id, type,
           case when type = 'User' then user_name else display_name end as display_name
    from (select *, {_TYPE} as type from (
        select cast(c_nationkey as bigint) as workspace_id, c_custkey as principal_id, c_name as display_name,
               case when c_custkey % 3 = 0 then c_mktsegment end as group_name,
               case when c_custkey % 3 = 1 then concat('app_', cast(c_custkey as varchar)) end
                   as service_principal_name,
               case when c_custkey % 4 <> 3 then concat('user_', cast(c_custkey as varchar)) end as user_name,
               case when c_acctbal < 0 then 'ADMIN' else 'USER' end as privilege_type
        from customer))""",
    "places": """
    select n_nationkey, r_name as catalog_name, n_name as schema_name,
           concat('owner_', cast(n_nationkey as varchar)) as owner
    from nation join region on n_regionkey = r_regionkey""",
    "customer_places": """
    select c_custkey, c_name, p.* from customer join places p on c_nationkey = n_nationkey""",
    "warehouse_branch": """
    select 'warehouse' as object_type, w.name as object_name, coalesce(w.owner, 'Not tagged') as object_owner,
           p.display_name as grantee, 'N/A' as catalog_name, 'N/A' as schema_name, p.privilege_type,
           'N/A' as is_grantable, case when p.inherited then p.inherited_from else 'NONE' end as inherited_from
    from warehouse_privileges p join warehouses w on p.object_id = w.id""",
    "cluster_branch": """
    select 'cluster' as object_type, c.cluster_name as object_name, coalesce(c.owner, 'Not tagged') as object_owner,
           p.display_name as grantee, 'N/A' as catalog_name, 'N/A' as schema_name, p.privilege_type,
           'N/A' as is_grantable, case when p.inherited then p.inherited_from else 'NONE' end as inherited_from
    from cluster_privileges p join clusters c on p.object_id = c.cluster_id""",
    "workspace_branch": """
    select 'workspace' as object_type, w.workspace_name as object_name, 'N/A' as object_owner,
           p.display_name as grantee, 'N/A' as catalog_name, 'N/A' as schema_name, p.privilege_type,
           'N/A' as is_grantable, 'NONE' as inherited_from
    from workspace_privileges p join workspaces w on p.workspace_id = w.workspace_id""",
    "metastore_branch": """
    select 'metastore' as object_type, concat('m', cast(n_regionkey as varchar)) as object_name,
           case when r_regionkey = 0 then 'System user' else 'platform' end as object_owner, n_name as grantee,
           'N/A' as catalog_name, 'N/A' as schema_name, 'CREATE CATALOG' as privilege_type,
           'NO' as is_grantable, 'NONE' as inherited_from
    from nation join region on n_regionkey = r_regionkey""",
    "catalog_branch": """
    select 'catalog' as object_type, r_name as object_name,
           case when r_regionkey = 1 then null else concat('owner_', cast(r_regionkey as varchar)) end as object_owner,
           c_name as grantee, r_name as catalog_name, 'N/A' as schema_name, 'USE CATALOG' as privilege_type,
           'NO' as is_grantable, 'METASTORE' as inherited_from
    from customer_places join region on catalog_name = r_name""",
    "schema_branch": """
    select 'schema' as object_type, c.schema_name as object_name,
           case when p.n_nationkey % 11 = 0 then 'System user' else p.owner end as object_owner, c_name as grantee,
           c.catalog_name, c.schema_name, 'USE SCHEMA' as privilege_type,
           'NO' as is_grantable, 'CATALOG' as inherited_from
    from customer_places c join places p on c.catalog_name = p.catalog_name and c.schema_name = p.schema_name""",
    "table_branch": """
    select 'table' as object_type, p.table_name as object_name, t.table_owner as object_owner, p.grantee,
           p.catalog_name, p.schema_name, p.privilege_type, p.is_grantable, 'SCHEMA' as inherited_from
    from (select catalog_name, schema_name, concat('t', cast(c_custkey as varchar)) as table_name,
                 o_orderpriority as grantee,
                 case when o_orderstatus = 'F' then 'SELECT' else 'MODIFY' end as privilege_type,
                 case when o_orderkey % 2 = 0 then 'YES' else 'NO' end as is_grantable
          from orders join customer_places on o_custkey = c_custkey) p
    join (select catalog_name, schema_name, concat('t', cast(c_custkey as varchar)) as table_name,
                 case when c_custkey % 11 = 0 then 'System user' else owner end as table_owner
          from customer_places) t
      on p.catalog_name = t.catalog_name and p.schema_name = t.schema_name and p.table_name = t.table_name""",
    "volumes": """
    select catalog_name, schema_name, concat('v', cast(s_suppkey as varchar)) as volume_name,
           concat('owner_', cast(s_nationkey as varchar)) as volume_owner
    from supplier join places on s_nationkey = n_nationkey""",
    "volume_branch": """
    select 'volume' as object_type, p.volume_name as object_name, v.volume_owner as object_owner, p.grantee,
           'N/A' as catalog_name, 'N/A' as schema_name, 'READ VOLUME' as privilege_type,
           'NO' as is_grantable, 'NONE' as inherited_from
    from (select volume_name, catalog_name, schema_name, concat('user_', cast(l_orderkey as varchar)) as grantee
          from lineitem join volumes on concat('v', cast(l_suppkey as varchar)) = volume_name) p
    join volumes v
      on p.catalog_name = v.catalog_name and p.schema_name = v.schema_name and p.volume_name = v.volume_name""",
    "connection_branch": """
    select 'connection' as object_type, connection_name as object_name,
           concat('owner_', connection_name) as object_owner, p_name as grantee,
           'N/A' as catalog_name, 'N/A' as schema_name, 'USE CONNECTION' as privilege_type,
           'NO' as is_grantable, 'NONE' as inherited_from
    from part join (select distinct p_brand as connection_name from part) on p_brand = connection_name""",
    "external_location_branch": """
    select 'external_location' as object_type, c_mktsegment as object_name, 'platform' as object_owner,
           c_name as grantee, 'N/A' as catalog_name, 'N/A' as schema_name, 'READ FILES' as privilege_type,
           'YES' as is_grantable, 'NONE' as inherited_from
    from customer join (select distinct c_mktsegment as location from customer) on c_mktsegment = location""",
}

BRANCHES = (
    "warehouse",
    "cluster",
    "workspace",
    "metastore",
    "catalog",
    "schema",
    "table",
    "volume",
    "connection",
    "external_location",
)

SKIN["all_privileges"] = (
    "\n    select * from ("
    + " union all ".join(f"select * from {kind}_branch" for kind in BRANCHES)
    + ") where object_owner not in ('System user')"
)

SKIN["review_rows"] = """
    select year(o_orderdate)::bigint as access_review_id, 3 as outcome_id,
           concat('d', cast(o_orderkey as varchar)) as object_name, o_orderpriority as object_owner,
           cast(o_custkey as varchar) as grantee
    from orders"""


def _with(query: str) -> str:
    return "with " + ",".join(f"{name} as ({body})" for name, body in SKIN.items()) + "\n" + query


def _published(table: str, key: str) -> str:
    return _with(
        f"select object_id as {key}, display_name, workspace_id, inherited, inherited_from, privilege_type, type "
        f"from {table}"
    )


_LABEL = "case when {0} < 60 then 'red' when {0} < 90 then 'orange' else 'default' end as support_label"

_CLUSTERS = "select cluster_id, cluster_name, workspace_id, spark_version, owner, spark_version_number from clusters"
_WAREHOUSES = "select id, name, workspace_id, enable_serverless_compute, owner from warehouses"
_SNAPSHOT = "select {0} as access_review_id, 3 as outcome_id, * from all_privileges"

_SLUG = "trim(regexp_replace(regexp_replace(lower({0}), '[^{1}\\s-]', '', 'g'), '[-\\s]+', '-', 'g'), '-_')"

# NFKD then ASCII: the test texts hold no characters with a compatibility form.
_ASCII_SLUG = _SLUG.format("regexp_replace(strip_accents({0}), '[^\\x00-\\x7F]', '', 'g')", "a-z0-9_")
_UNICODE_SLUG = _SLUG.format("nfc_normalize({0})", "\\p{{L}}\\p{{N}}_")

_TABLE_COUNTS = {
    "runtime_versions": "(select max(page_id) as newest from pages where html like '%</article>%') where newest is not null",
    "users": "customer",
    "workspaces": "nation",
    "workspace_privileges": "customer",
    "clusters": "part",
    "warehouses": "supplier",
    "cluster_privileges": "lineitem",
    "warehouse_privileges": "lineitem",
    "dashboard_privileges": "orders",
    "volume_privileges": "events",
}

_RELEASES = """
        select *, replace(version, ' LTS', '') as spark_version_number from (
            select page_id, url, 0 as row_number,
                   concat(cast(page_id % 20 as varchar), '.', cast(page_id % 4 as varchar),
                          case when page_id % 3 = 0 then ' LTS' else '' end) as version,
                   concat('Std & ML ', cast(page_id as varchar)) as variants,
                   cast(date '2022-06-01' + cast(page_id % 1000 as integer) as timestamp) as release_date,
                   cast(date '2024-06-01' + cast(page_id % 1000 as integer) as timestamp) as end_of_support_date,
                   concat('e', cast(page_id as varchar)) as engine_version
            from pages where html like '%</article>%')"""

_ITEM = '\'<li><a href="([^"]*)">([^<]*)</a></li>\''

_UPSERTED = """
        with source as (
            select o_orderkey as outcome_id, 'Approved' as outcome_value from orders where o_orderstatus = 'F'
            union all select -1 - o_orderkey, o_orderpriority from orders where o_orderstatus = 'O')
        select o_orderkey as outcome_id, o_orderstatus as outcome_value from orders
        where o_orderkey not in (select outcome_id from source)
        union all select * from source"""

ORACLES = {
    # Inventory.
    "workspaces": _with("select * from workspaces"),
    "users_flat": _with("select * from users"),
    "workspace_privileges": _with("select * from workspace_privileges"),
    "clusters_owner": _with(_CLUSTERS),
    "warehouses_owner": _with(_WAREHOUSES),
    "cluster_privileges": _published("cluster_privileges", "cluster_id"),
    "warehouse_privileges": _published("warehouse_privileges", "warehouse_id"),
    "dashboard_privileges": _published("dashboard_privileges", "dashboard_id"),
    "volume_privileges": _published("volume_acl_privileges", "volume_id"),
    "serverless_warehouses": _with("select id, name from warehouses where enable_serverless_compute"),
    "runtime_versions": _with("select * from runtime_versions"),
    "union_frames": """
        select c_custkey as id, c_name as name, c_mktsegment as segment from customer
        union all select s_suppkey, s_name, null from supplier""",
    # Landing.
    "landed_workspaces": _with("select * from workspaces"),
    "landed_users": _with("select * from users"),
    "landed_assignments": _with("select * from workspace_privileges"),
    "landed_clusters": _with(_CLUSTERS),
    "landed_warehouses": _with(_WAREHOUSES),
    "landed_cluster_acl": _published("cluster_privileges", "cluster_id"),
    "landed_warehouse_acl": _published("warehouse_privileges", "warehouse_id"),
    "landed_dashboard_acl": _published("dashboard_privileges", "dashboard_id"),
    "landed_volume_acl": _published("volume_acl_privileges", "volume_id"),
    "refresh_tables": " union all ".join(
        f"select '{table}' as table_name, count(*) as n_rows from {source}" for table, source in _TABLE_COUNTS.items()
    ),
    "published_users": _with("select * from users"),
    "published_workspaces": _with("select * from workspaces"),
    "published_workspace_privileges": _with("select * from workspace_privileges"),
    "published_clusters": _with(_CLUSTERS),
    "published_warehouses": _with(_WAREHOUSES),
    "published_cluster_privileges": _published("cluster_privileges", "cluster_id"),
    "published_warehouse_privileges": _published("warehouse_privileges", "warehouse_id"),
    "published_dashboard_privileges": _published("dashboard_privileges", "dashboard_id"),
    "published_volume_privileges": _published("volume_acl_privileges", "volume_id"),
    "published_runtime_versions": f"select * exclude (page_id, url, row_number) from ({_RELEASES}) "
    "where page_id = (select max(page_id) from pages where html like '%</article>%')",
    # Support windows.
    "cluster_version_support": _with("select * from support"),
    "support_table": _with(
        "select days_until_end_of_support, end_of_support_date, cluster_name, object_owner, spark_version_number, "
        f"{_LABEL.format('days_until_end_of_support')} from support"
    ),
    "support_histogram": _with(
        "select spark_version_number, cast(date_trunc('month', end_of_support_date) as timestamp) "
        "as end_of_support_month, count(*) as n_clusters from support group by all"
    ),
    "support_counter": _with(
        "select min(days_until_end_of_support) as min_days_until_end_of_support, "
        f"{_LABEL.format('min(days_until_end_of_support)')} from support"
    ),
    # Privileges.
    **{f"branch_{kind}": _with(f"select * from {kind}_branch") for kind in BRANCHES},
    "all_privileges": _with("select * from all_privileges"),
    "privileges_by_owner": _with(
        "select object_owner, count(*) as n_privileges from all_privileges group by object_owner"
    ),
    "stored_owner_counts": _with(
        "select object_owner, count(*) as n_privileges from all_privileges group by object_owner"
    ),
    "owners": _with("select distinct object_owner from all_privileges"),
    "owner_rows": _with("select * from all_privileges where object_owner = 'owner_3'"),
    "view_counts": _with(
        "select object_type, privilege_type, count(*) as n_rows from all_privileges group by all "
        "union all select 'supported cluster', variants, count(*) from support group by all"
    ),
    "stored_privileges": _with("select * from all_privileges"),
    "stored_support": _with("select * exclude (days_until_end_of_support) from support"),
    # Reviews.
    "latest_id": _with("select max(access_review_id) as access_review_id from review_rows"),
    "latest_review": _with(
        "select * from review_rows where access_review_id = (select max(access_review_id) from review_rows)"
    ),
    "owner_counts": _with(
        "select object_owner, count(*) as n_rows from review_rows "
        "where access_review_id = (select max(access_review_id) from review_rows) group by object_owner"
    ),
    "review_snapshot": _with(
        _SNAPSHOT.format("(select max(year(o_orderdate))::bigint from orders)")
    ),
    "created_review": _with(
        "select *, 'Not reviewed' as outcome_value, 'tester' as created_by, "
        f"cast({AS_OF} as timestamp) as created_date from ({_SNAPSHOT.format('cast(1 as bigint)')})"
    ),
    "export_numbers": _with(
        "select object_owner, count(*) as n_rows, count(*) as n_numbers, cast(0 as bigint) as lowest, "
        "count(*) - 1 as highest from review_rows "
        "where access_review_id = (select max(access_review_id) from review_rows) group by object_owner"
    ),
    "exported_review": _with(_SNAPSHOT.format("(select max(year(o_orderdate))::bigint from orders)")),
    "csv_import": _with(
        "select *, true as from_csv, true as has_time from ("
        + _SNAPSHOT.format("(select max(year(o_orderdate))::bigint from orders)")
        + ")"
    ),
    "identity_ids": "select count(*) as n_rows, count(*) as n_ids, true as from_start from lineitem",
    "outcomes_upsert": _UPSERTED,
    "stored_outcomes_upsert": _UPSERTED,
    "key_violations": """
        select l_orderkey, l_linenumber, count(*) as n_rows from lineitem
        group by l_orderkey, l_linenumber
        having count(*) > 1 or l_orderkey is null or l_linenumber is null""",
    # Names and keys.
    "snake_keys": """
        select p_partkey, lower(regexp_replace(p_name, '[-\\s]', '_', 'g')) as name_key,
               lower(regexp_replace(p_type, '[-\\s]', '_', 'g')) as type_key from part""",
    "snake_text": "select doc_id, lower(regexp_replace(text, '[-\\s]', '_', 'g')) as key from documents",
    "normalized_columns": "select p_partkey as part_key, p_name as part_name from part",
    "normalized_tags": """
        select p_partkey, 'owner' as key, p_type as value from part
        union all select p_partkey, 'cost_center', p_brand from part""",
    "owner_slug": _with(
        "select object_owner, "
        + _ASCII_SLUG.format("concat('2024_', object_owner)")
        + " as owner_slug, count(*) as n_rows from all_privileges group by object_owner"
    ),
    "text_slug": f"select doc_id, {_ASCII_SLUG.format('text')} as slug from documents",
    "unicode_slug": f"select doc_id, {_UNICODE_SLUG.format('text')} as slug from documents",
    # Pages.
    "html_nav_links": f"""
        select page_id, cast(unnest(range(len(hrefs))) as integer) as position, unnest(hrefs) as href,
               unnest(texts) as text
        from (select page_id, regexp_extract_all(html, {_ITEM}, 1) as hrefs,
                     regexp_extract_all(html, {_ITEM}, 2) as texts from pages)""",
    "html_tables": _RELEASES,
}
