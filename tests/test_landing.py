import json

import pytest

from core_helpers import rows
from custodia.operators import inventory
from custodia.plans.refresh import TABLES, inventory_frames, refresh
from custodia.schemas import RAW
from custodia.sources import landing
from custodia.sources.landing import ACL_KEY, read_inventory


def land(folder, records, workspace=None):
    target = folder if workspace is None else folder / f"workspace_id={workspace}"
    target.mkdir(parents=True, exist_ok=True)
    (target / "part.json").write_text("".join(json.dumps(r) + "\n" for r in records))


def test_users_by_raw_keys(spark, tmp_path):
    land(
        tmp_path,
        [
            {
                "displayName": "Ann B",
                "userName": "ann@example.com",
                "externalId": "e1",
                "id": "1",
                "active": True,
                "name": {"givenName": "Ann", "familyName": "B"},
                "emails": [{"primary": True, "type": "work", "value": "ann@example.com"}],
                "roles": [{"type": "direct", "value": "admin"}],
                "entitlements": ["unlisted"],
            },
            {"id": "2"},
        ],
    )
    listed = landing.users(read_inventory(spark, str(tmp_path), "users"))
    assert listed.columns == ["emails", "active", "displayname", "externalid", "id", "name", "roles", "username"]
    flat = inventory.flat_users(listed)
    assert flat.columns == [
        "active",
        "displayname",
        "externalid",
        "id",
        "roles",
        "username",
        "givenname",
        "familyname",
    ]
    by_id = {row.id: row for row in flat.collect()}
    assert (by_id["1"].displayname, by_id["1"].username, by_id["1"].givenname) == ("Ann B", "ann@example.com", "Ann")
    assert by_id["1"].roles[0].value == "admin"
    assert by_id["2"].familyname is None


def test_clusters_keep_their_workspace_and_owner_tag(spark, tmp_path):
    land(
        tmp_path,
        [
            {"cluster_id": "a", "spark_version": "15.4.x-scala2.12", "custom_tags": {"Owner": "Ann"}, "state": "UP"},
            {"cluster_id": "b", "custom_tags": {"Owner": "Ann", "owner": "Bob"}, "cluster_cores": 4.0},
        ],
        workspace=3_000_000_000,
    )
    land(tmp_path, [{"cluster_id": "c", "custom_tags": {}}, {"cluster_id": "d"}], workspace=7)
    owned = inventory.owned_clusters(landing.clusters(read_inventory(spark, str(tmp_path), "clusters")))
    assert owned.columns[-3:] == ["workspace_id", "owner", "spark_version_number"]
    assert owned.schema["workspace_id"].dataType.simpleString() == "bigint"
    assert rows(owned.select("cluster_id", "workspace_id", "owner", "spark_version_number")) == [
        ("a", 3_000_000_000, "Ann", "15.4"),
        ("b", 3_000_000_000, "Bob", None),
        ("c", 7, None, None),
        ("d", 7, None, None),
    ]


def test_workspace_id_is_bigint_for_small_ids_too(spark, tmp_path):
    land(tmp_path, [{"id": "w"}], workspace=1)
    assert read_inventory(spark, str(tmp_path), "warehouses").schema["workspace_id"].dataType.simpleString() == "bigint"


def test_empty_listing_is_an_empty_typed_frame(spark, tmp_path):
    for entity, schema in RAW.items():
        folder = tmp_path / entity
        folder.mkdir()
        df = read_inventory(spark, str(folder), entity)
        assert len(df.columns) == len(schema)
        assert df.count() == 0


def test_a_value_of_the_wrong_type_fails(spark, tmp_path):
    land(tmp_path, [{"workspace_id": "not a number"}])
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILFAST|workspace_id"):
        read_inventory(spark, str(tmp_path), "workspaces").collect()


def test_warehouse_owner_and_serverless(spark, tmp_path):
    def tags(*pairs):
        return {"custom_tags": [{"key": k, "value": v} for k, v in pairs]}

    land(
        tmp_path,
        [
            {"id": "1", "name": "one", "tags": tags(("env", "x"), ("owner", "Ann")), "enable_serverless_compute": True},
            {"id": "2", "name": "two", "tags": tags(("Owner", "Ann")), "enable_serverless_compute": False},
            {"id": "3", "name": "three", "tags": {}},
        ],
        workspace=1,
    )
    owned = inventory.owned_warehouses(landing.warehouses(read_inventory(spark, str(tmp_path), "warehouses")))
    assert rows(owned.select("id", "owner")) == [("1", "Ann"), ("2", None), ("3", None)]
    assert rows(inventory.serverless_warehouses(owned)) == [("1", "one")]


def permission(level, inherited=None, sources=None):
    return {"permission_level": level, "inherited": inherited, "inherited_from_object": sources}


@pytest.mark.parametrize("kind", list(ACL_KEY))
def test_access_lists(spark, tmp_path, kind):
    land(
        tmp_path,
        [
            {
                "object_id": "o1",
                "group_name": "admins",
                "user_name": "ann",
                "display_name": "d",
                "all_permissions": [permission("CAN_MANAGE", True, ["/a/", "/b/"]), permission("CAN_USE")],
            },
            {"object_id": "o1", "user_name": "ann", "display_name": "Ann", "all_permissions": []},
        ],
        workspace=1,
    )
    land(
        tmp_path,
        [
            {"object_id": "o2", "service_principal_name": "app", "display_name": "App", "all_permissions": None},
            {"object_id": "o3", "display_name": "nobody"},
        ],
        workspace=2,
    )
    key = ACL_KEY[kind]
    flat = inventory.flatten_acl(landing.object_acls(read_inventory(spark, str(tmp_path), "cluster_acl"), kind), key)
    assert flat.columns == [
        key,
        "display_name",
        "workspace_id",
        "inherited",
        "inherited_from_object",
        "privilege_type",
        "type",
    ]
    assert rows(flat) == [
        ("o1", "admins", 1, True, ["/a/", "/b/"], "CAN_MANAGE", "Group"),
        ("o1", "ann", 1, None, None, None, "User"),
        ("o2", "App", 2, None, None, None, "Service Principal"),
        ("o3", "nobody", 2, None, None, None, "UNKNOWN"),
    ]


def test_assignments(spark, tmp_path):
    land(
        tmp_path,
        [
            {"permissions": ["ADMIN", "USER"], "principal": {"principal_id": 1, "group_name": "g", "display_name": "G"}},
            {"permissions": ["USER"], "principal": {"principal_id": 2, "user_name": "u", "display_name": "U"}},
            {"permissions": [], "principal": {"principal_id": 3, "service_principal_name": "s", "display_name": "S"}},
        ],
        workspace=5,
    )
    raw = landing.workspace_assignments(read_inventory(spark, str(tmp_path), "workspace_assignments"))
    flat = inventory.flatten_assignments(raw)
    assert flat.columns == ["workspace_id", "privilege_type", "principal_id", "type", "display_name"]
    assert rows(flat) == [
        (5, None, 3, "Service Principal", "S"),
        (5, "ADMIN", 1, "Group", "G"),
        (5, "USER", 2, "User", "u"),
    ]


def test_refresh_publishes_all_tables_and_replaces_them(spark, tmp_path, schema):
    page = (
        '<h2 id="rel">x</h2><table><tr><th>Version</th><th>Variants</th><th>Release date</th>'
        "<th>End-of-support date</th></tr><tr><td>15.4 LTS</td><td>all</td><td>Aug 19, 2024</td>"
        "<td>Aug 19, 2027</td></tr></table>"
    )
    for entity in RAW:
        (tmp_path / "in" / entity).mkdir(parents=True)
    land(tmp_path / "in" / "runtime_pages", [{"page_id": 1, "url": "u", "html": page}])
    land(tmp_path / "in" / "workspaces", [{"workspace_id": 1, "workspace_name": "w"}])
    name, folder = schema
    for _ in range(2):
        tables = refresh(spark, str(tmp_path / "in"), name, "rel", location=folder)
    assert set(tables) == {"runtime_versions", *TABLES} and len(tables) == 9
    assert tables["runtime_versions"].first().spark_version_number == "15.4"
    assert tables["workspaces"].count() == 1
    assert tables["clusters"].count() == 0
    assert "volume_privileges" in inventory_frames(spark, str(tmp_path / "in"), "rel", volumes=True)


def test_landed_files_are_compressed(spark, testbed, tmp_path):
    for entity in ("workspaces", "clusters"):
        testbed.land(entity, str(tmp_path))
        files = [path for path in (tmp_path / entity).rglob("part-*")]
        assert files and all(path.name.endswith(".json.gz") for path in files)
        assert read_inventory(spark, str(tmp_path / entity), entity).count() == testbed.raw(entity).count()
