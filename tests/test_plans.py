"""The shape of the plans: what a large cluster would run."""

import contextlib
import io
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from custodia.operators.keys import latest_review
from custodia.operators.sinks import ensure_namespace, publish
from custodia.plans.privileges import KINDS, all_privileges
from custodia.plans.review import ReviewTables, create_review
from custodia.plans.support import cluster_version_support
from custodia.plans.views import create_views
from custodia.sources.catalog import privilege_frames
from custodia.storage import shared_folder, staging

# Queries that run jobs of their own before they return; their parts are checked alone.
EAGER = {"refresh_tables", "view_counts", "created_review", "exported_review", "export_numbers", "csv_import"}
EAGER |= {name for name in entry.QUERIES if name.startswith(("published_", "stored_"))}


def plan(df, mode="simple"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode=mode)
    return out.getvalue()


PYTHON = {"owner_slug", "text_slug", "unicode_slug", "html_tables"}


@pytest.mark.parametrize("name", sorted(set(entry.QUERIES) - EAGER))
def test_no_cross_join_no_global_window_and_no_needless_python(testbed, name):
    text = plan(entry.QUERIES[name](testbed), "formatted")
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "Window" not in text
    assert name in PYTHON or "Python" not in text


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory, testbed):
    folder = tmp_path_factory.mktemp("published")
    ensure_namespace(spark, "published", str(folder))
    frames = {name: publish(df, f"published.{name}") for name, df in testbed.frames().items()}
    publish(testbed.runtime_versions(), "published.runtime_versions")
    yield frames
    spark.sql("DROP SCHEMA published CASCADE")


def test_a_filter_on_the_kind_drops_all_other_branches(published):
    text = plan(all_privileges(published).filter("object_type = 'volume'"))
    assert "Union" not in text
    assert text.count("FileScan") == 2


def test_only_needed_columns_are_read(published):
    text = plan(all_privileges(published).select("object_owner"))
    assert "grantee" not in text
    assert "inherited_from" not in text


def test_filters_reach_the_files(spark, published):
    frames = privilege_frames(spark, "published", "published")
    text = plan(all_privileges(frames).filter("object_owner = 'owner_3'"))
    assert "EqualTo(table_owner,owner_3)" in text
    # Branches whose owner is a literal cannot match and are gone.
    assert "workspace_name" not in text


def test_small_objects_are_broadcast_by_size_and_large_ones_are_not(spark, published):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    assert plan(all_privileges(published)).count("BroadcastHashJoin") == len(KINDS)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        text = plan(all_privileges(published))
        assert "BroadcastHashJoin" not in text
        assert text.count("SortMergeJoin") == len(KINDS)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_views_equal_the_frames(spark, published):
    for _ in range(2):
        create_views(spark, "published", "published", "published")
    view = spark.table("published.all_privileges")
    frame = all_privileges(published)
    assert view.columns == frame.columns
    assert view.exceptAll(frame).count() == frame.exceptAll(view).count() == 0
    support = cluster_version_support(published["clusters"], spark.table("published.runtime_versions"))
    view = spark.table("published.cluster_version_support")
    assert view.schema == support.schema
    assert view.exceptAll(support).count() == 0 < view.count()


def test_the_latest_review_reads_one_partition(spark, schema, published):
    name, folder = schema
    data = all_privileges(published).filter(F.col("object_type") == "metastore")
    for _ in range(3):
        create_review(data, name, location=folder)
    tables = ReviewTables(name)
    newest = latest_review(spark.table(tables.detail), spark.table(tables.reviews))
    assert newest.count() == data.count()
    text = plan(newest)
    assert "PartitionFilters: [isnotnull(access_review_id" in text
    assert len(newest.select(F.input_file_name()).distinct().collect()) < len(
        spark.table(tables.detail).select(F.input_file_name()).distinct().collect()
    )


def test_the_scratch_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_without_one_the_scratch_folder_is_in_the_warehouse():
    assert shared_folder(SimpleNamespace(conf={"spark.sql.warehouse.dir": "file:/w/"})) == "file:/w/scratch"
    assert shared_folder(SimpleNamespace(conf={"spark.checkpoint.dir": "/x/"})) == "/x"


def test_staged_folders_go_with_their_job(spark):
    with staging(spark) as staged:
        table = staged.stage(spark.range(3), "some")
        assert table.count() == 3
        assert len(staged.paths) == 1
    assert not Path(staged.paths[0]).exists()
