"""Keyed tables, declared keys and required columns, and reviews side by side."""

import glob
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from core_helpers import rows
from custodia.operators import constraints, keyed
from custodia.operators.keyed import ensure_keyed_table, newest_buckets, upsert_table
from custodia.operators.keys import DuplicateKeyError, numbered_ids
from custodia.operators.sinks import append, ensure_namespace, ensure_table, replace_partition
from custodia.plans.review import ReviewTables, create_review, ensure_review_tables
from custodia.schemas import OUTCOMES, PRIVILEGE_COLUMNS
from custodia.sources.reviews import review_outcomes

PAIRS = StructType([StructField("a", IntegerType()), StructField("b", StringType()), StructField("v", StringType())])


@pytest.fixture
def home(spark, schema):
    ensure_namespace(spark, *schema)
    return schema[0]


def outcomes(spark, *values):
    return spark.createDataFrame(list(values), OUTCOMES)


@pytest.fixture
def table(spark, home):
    name = f"{home}.outcomes"
    ensure_keyed_table(spark, name, OUTCOMES, ["outcome_id"], required=["outcome_value"], buckets=8)
    return name


def test_merges_into_a_table(spark, table):
    assert rows(spark.table(table)) == []
    assert spark.table(table).columns == OUTCOMES.names
    upsert_table(outcomes(spark, (1, "wrong"), (9, "own")), table)
    for _ in range(2):
        upsert_table(review_outcomes(spark), table)
        assert rows(spark.table(table)) == [
            (1, "Approved"), (2, "Denied"), (3, "Not reviewed"), (4, "Don't know"), (9, "own")
        ]


def test_only_changed_buckets_are_written(spark, table):
    upsert_table(spark.range(500).select(F.col("id").cast("int").alias("outcome_id"), F.lit("a").alias("outcome_value")), table)
    before = newest_buckets(spark, table)
    assert len(before) == 8 and set(before.values()) == {1}
    files = set(glob.glob(f"{folder_of(spark, table)}__rows__files/**/*.parquet", recursive=True))
    assert upsert_table(outcomes(spark, (3, "b"), (4, "a")), table) == 1
    after = newest_buckets(spark, table)
    assert sorted(after.values()) == [1] * 7 + [2]
    new = set(glob.glob(f"{folder_of(spark, table)}__rows__files/**/*.parquet", recursive=True)) - files
    assert {path.split("/")[-2] for path in new} == {f"key_bucket={b}" for b, merge in after.items() if merge == 2}
    assert upsert_table(outcomes(spark, (3, "b"), (4, "a")), table) == 0
    assert spark.table(table).count() == 500
    assert rows(spark.table(table).filter("outcome_id IN (3, 4)")) == [(3, "b"), (4, "a")]


def folder_of(spark, table):
    schema, name = table.split(".")
    return spark.catalog.getDatabase(schema).locationUri.removeprefix("file:") + f"/{name}"


def test_a_merge_reads_only_the_partitions_that_it_touches(spark, table):
    upsert_table(spark.range(500).select(F.col("id").cast("int").alias("outcome_id"), F.lit("a").alias("outcome_value")), table)
    held = keyed._of_buckets(spark, table, {2: 1})
    assert held.select(F.input_file_name().alias("f")).distinct().count() == len(
        glob.glob(f"{folder_of(spark, table)}__rows__files/merge=1/key_bucket=2/*.parquet")
    )
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert "(key_bucket" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]


def test_old_merges_go(spark, table):
    for k in range(5):
        upsert_table(outcomes(spark, (1, f"v{k}"), (2, "same")), table)
    assert rows(spark.table(table)) == [(1, "v4"), (2, "same")]
    left = {path.split("merge=")[1].split("/")[0] for path in glob.glob(f"{folder_of(spark, table)}__rows__files/*/*/*.parquet")}
    # The first merge holds a bucket that no later one changed.
    assert left == {"1", "4", "5"}


@pytest.mark.parametrize(
    ("bad", "error"),
    [
        ([(1, None)], "null in outcome_value"),
        ([(None, "x")], "null in outcome_id"),
        ([(5, "x"), (5, "y")], "2 rows with outcome_id = 5"),
    ],
)
def test_a_merge_that_breaks_a_constraint_changes_nothing(spark, table, bad, error):
    upsert_table(outcomes(spark, (1, "a")), table)
    with pytest.raises(Exception, match=error):
        upsert_table(outcomes(spark, *bad), table)
    assert rows(spark.table(table)) == [(1, "a")]


def test_a_merge_that_dies_changes_nothing(spark, table, monkeypatch):
    upsert_table(outcomes(spark, (1, "a"), (2, "b")), table)

    def die(*_):
        raise RuntimeError("killed")

    monkeypatch.setattr(keyed, "_show", die)
    with pytest.raises(RuntimeError, match="killed"):
        upsert_table(outcomes(spark, (1, "lost"), (7, "lost")), table)
    monkeypatch.undo()
    assert rows(spark.table(table)) == [(1, "a"), (2, "b")]
    upsert_table(outcomes(spark, (1, "c")), table)
    assert rows(spark.table(table)) == [(1, "c"), (2, "b")]


def test_keys_of_several_columns(spark, home):
    name = f"{home}.pairs"
    ensure_keyed_table(spark, name, PAIRS, ["a", "b"], buckets=3)
    upsert_table(spark.createDataFrame([(1, "x", "p"), (1, "y", None), (2, "x", "q")], PAIRS), name)
    upsert_table(spark.createDataFrame([("new", 1, "y"), (None, 3, "z")], "v string, a int, b string"), name)
    assert rows(spark.table(name)) == [(1, "x", "p"), (1, "y", "new"), (2, "x", "q"), (3, "z", None)]


def test_appends_and_partitions_are_checked(spark, home):
    plain, parted = f"{home}.plain", f"{home}.parted"
    ensure_table(spark, plain, PAIRS, required=["v"])
    append(spark.createDataFrame([(1, "x", "p")], PAIRS), plain)
    with pytest.raises(Exception, match="null in v"):
        append(spark.createDataFrame([(2, "x", "p"), (3, "y", None)], PAIRS), plain)
    assert spark.table(plain).count() == 1
    ensure_table(spark, parted, PAIRS, partition_by=["a"], key=["b"])
    replace_partition(spark.createDataFrame([("x", "p"), ("y", "p")], "b string, v string"), parted, "a", 1)
    for bad in ([("x", "p"), ("x", "q")], [(None, "p")]):
        with pytest.raises(Exception, match="2 rows with b = x|null in b"):
            replace_partition(spark.createDataFrame(bad, "b string, v string"), parted, "a", 2)
    assert rows(spark.table(parted).groupBy("a").count()) == [(1, 2)]


def privileges(spark, n=6):
    names = [F.concat(F.lit(f"{name}-"), F.col("id")).alias(name) for name in PRIVILEGE_COLUMNS]
    return spark.range(n).select(*names).repartition(3)


def test_repeated_ids_stop_a_review_before_it_shows(spark, home, monkeypatch):
    from custodia.plans import review

    create_review(privileges(spark), home)
    with monkeypatch.context() as patched:
        patched.setattr(review, "numbered_ids", lambda df, name, run: df.select(F.lit(7).cast("bigint").alias(name), "*"))
        with pytest.raises(DuplicateKeyError, match="access_review_detail_id = 7"):
            create_review(privileges(spark), home)
    tables = ReviewTables(home)
    assert spark.table(tables.reviews).count() == 1
    assert spark.table(tables.detail).count() == 6
    assert create_review(privileges(spark), home) > 1


def test_an_outcome_without_a_text_stops_a_review_before_it_shows(spark, home, monkeypatch):
    from custodia.plans import review

    ensure_review_tables(spark, home)
    monkeypatch.setattr(review, "review_outcomes", lambda spark: outcomes(spark, (1, None)))
    with pytest.raises(Exception, match="null in outcome_value"):
        create_review(privileges(spark), home)
    assert spark.table(ReviewTables(home).reviews).count() == 0


def test_reviews_side_by_side_are_complete_and_apart(spark, home):
    ensure_review_tables(spark, home)
    with ThreadPoolExecutor(3) as pool:
        ids = list(pool.map(lambda n: create_review(privileges(spark, n), home, by=str(n)), (5, 6, 7)))
    assert sorted(ids) == [1, 2, 3]
    tables = ReviewTables(home)
    detail = spark.table(tables.detail)
    assert rows(detail.groupBy("access_review_id").count()) == sorted(zip(ids, (5, 6, 7), strict=True))
    assert detail.select("access_review_detail_id").distinct().count() == 18
    assert rows(spark.table(tables.reviews).select("access_review_id", "created_by")) == sorted(
        (i, str(n)) for i, n in zip(ids, (5, 6, 7), strict=True)
    )


def test_ids_of_runs(spark):
    first = [r.i for r in numbered_ids(spark.range(9).repartition(4), "i", 1).collect()]
    second = [r.i for r in numbered_ids(spark.range(9).repartition(4), "i", 2).collect()]
    assert len(set(first + second)) == 18
    assert max(first) < min(second)


def test_keys_are_dealt_before_they_are_counted(spark, monkeypatch):
    """Counts before a shuffle would hold all keys of a file in memory."""
    plans, count = [], constraints.check_key

    def watched(rows, key):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return count(rows, key)

    monkeypatch.setattr(constraints, "check_key", watched)
    constraints.refuse_repeats(spark.range(20), "t", ["id"])
    with pytest.raises(DuplicateKeyError, match="t: 2 rows with id = 7"):
        constraints.refuse_repeats(spark.range(20).union(spark.range(7, 8)), "t", ["id"])
    assert len(plans) == 2 and all(plan.startswith("RepartitionByExpression [id") for plan in plans)
