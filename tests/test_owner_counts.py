"""Counts per owner that are kept up to date."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import stored_schema
from core_helpers import rows
from custodia.operators.sinks import ensure_namespace, publish
from custodia.operators.versions import published, publish_version
from custodia.plans import owner_counts
from custodia.plans.owner_counts import owner_totals, renew_owner_counts
from custodia.plans.privileges import KINDS, all_privileges, privileges_by_owner
from custodia.sources.catalog import INVENTORY_TABLES, METADATA_TABLES, privilege_frames


@pytest.fixture
def stored(spark, schema, testbed):
    name, folder = schema
    ensure_namespace(spark, name, folder)
    frames = testbed.frames()
    publish_version(spark, name, {table: frames[table] for table in (*INVENTORY_TABLES, *METADATA_TABLES)})
    return name


def recount(spark, schema):
    return rows(privileges_by_owner(privilege_frames(spark, schema, schema)))


def test_only_changed_kinds_are_counted_again(spark, stored, testbed, monkeypatch):
    counted, count = [], owner_counts.counts_of_kind
    monkeypatch.setattr(owner_counts, "counts_of_kind", lambda kind, *frames: counted.append(kind) or count(kind, *frames))
    assert renew_owner_counts(spark, stored, stored, stored) == list(KINDS)
    assert rows(owner_totals(spark, stored)) == recount(spark, stored)
    assert renew_owner_counts(spark, stored, stored, stored) == []
    counted.clear()
    grants = KINDS["table"].grants
    publish(testbed.frame(grants).filter(F.xxhash64("grantee") % 2 == 0), f"{stored}.{grants}")
    before = published(spark, stored)
    assert renew_owner_counts(spark, stored, stored, stored) == counted == ["table"]
    assert rows(owner_totals(spark, stored)) == recount(spark, stored)
    # One version more, with one kind's counts.
    (version,) = set(published(spark, stored)) - set(before)
    assert set(published(spark, stored)[version]) == {"owner_counts_table", "owner_counts_inputs"}


def test_new_owners_of_objects_count(spark, stored, testbed):
    renew_owner_counts(spark, stored, stored, stored)
    clusters = testbed.frame("clusters").withColumn("owner", F.lit("someone else"))
    publish(clusters, f"{stored}.clusters")
    assert renew_owner_counts(spark, stored, stored, stored) == ["cluster"]
    assert rows(owner_totals(spark, stored)) == recount(spark, stored)


def test_a_failed_renewal_is_made_up_for(spark, stored, monkeypatch):
    with monkeypatch.context() as patched:
        broken = spark.range(1).select(F.lit("x").alias("object_owner"), F.raise_error(F.lit("broken")).cast("bigint").alias("n_privileges"))
        patched.setattr(owner_counts, "counts_of_kind", lambda *_: broken)
        with pytest.raises(Exception, match="broken"):
            renew_owner_counts(spark, stored, stored, stored)
    assert renew_owner_counts(spark, stored, stored, stored) == list(KINDS)
    assert rows(owner_totals(spark, stored)) == recount(spark, stored)


def test_plain_tables_are_counted_every_time(spark, schema, testbed):
    name, folder = schema
    ensure_namespace(spark, name, folder)
    frames = testbed.frames()
    for table in (*INVENTORY_TABLES, *METADATA_TABLES):
        frames[table].write.saveAsTable(f"{name}.{table}")
    for _ in range(2):
        assert renew_owner_counts(spark, name, name, name) == list(KINDS)
    want = all_privileges(frames).groupBy("object_owner").count()
    assert rows(owner_totals(spark, name)) == rows(want)


def test_tables_of_the_stored_schema_are_published_side_by_side(spark, testbed):
    name = stored_schema(testbed)
    versions = published(spark, name)
    assert list(versions) == [1]
    assert set(versions[1]) == {"runtime_versions", *INVENTORY_TABLES, *METADATA_TABLES}
    spark.sql(f"DROP SCHEMA {name} CASCADE")
