import pytest
from pyspark.sql import functions as F

from core_helpers import rows
from custodia.operators import keys
from custodia.operators.sinks import append, ensure_namespace, ensure_table, publish, replace_partition
from custodia.schemas import OUTCOMES, REVIEW_DETAIL, REVIEWS
from custodia.sources.reviews import review_outcomes


def test_check_key(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "a"), (2, None)], "a int, b string")
    assert rows(keys.check_key(df, ["a", "b"])) == [(None, "a", 1), (1, "a", 2), (2, None, 1)]
    assert keys.check_key(spark.range(10), ["id"]).count() == 0


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_assigned_ids_are_unique_and_start_above(spark, partitions):
    copies = spark.range(5000).select(F.lit("same").alias("x")).repartition(partitions)
    ids = [row.id for row in keys.assign_ids(copies, "id", start=11).collect()]
    assert len(set(ids)) == 5000
    assert min(ids) == 11
    assert keys.assign_ids(copies, "id").schema["id"].dataType.simpleString() == "bigint"


def test_latest_ids(spark):
    df = spark.createDataFrame([(1,), (3,)], "id bigint")
    assert rows(keys.latest_id(df, "id")) == [(3,)]
    assert keys.next_id(df, "id") == 4
    assert keys.next_id(df.limit(0), "id") == 1


def test_latest_review(spark):
    detail = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "access_review_id bigint, x string")
    reviews = spark.createDataFrame([(1,), (2,)], "access_review_id bigint")
    assert rows(keys.latest_review(detail, reviews)) == [(2, "b"), (2, "c")]
    assert keys.latest_review(detail, reviews.limit(0)).count() == 0


def test_owner_filters(spark):
    df = spark.createDataFrame([("System user",), (None,), ("Ann",), ("Ann",)], "object_owner string")
    assert rows(keys.exclude_owners(df, ["System user"])) == [("Ann",), ("Ann",)]
    assert keys.rows_of_owner(df, "Ann").count() == 2
    assert rows(keys.owners(df)) == [(None,), ("Ann",), ("System user",)]
    assert rows(keys.count_by_owner(df)) == [(None, 1), ("Ann", 2), ("System user", 1)]


def test_union_frames_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id int, name string")
    b = spark.createDataFrame([("y", 2)], "name string, n int")
    assert rows(keys.union_frames([a, b])) == [(None, "y", 2), (1, "x", None)]


def test_upsert(spark):
    target = spark.createDataFrame([(1, "old"), (2, "kept"), (None, "null")], "id int, v string")
    source = spark.createDataFrame([("new", 1), ("added", 3), ("n1", None), ("n2", None)], "v string, id int")
    assert rows(keys.upsert(target, source, ["id"])) == [
        (None, "n1"),
        (None, "n2"),
        (None, "null"),
        (1, "new"),
        (2, "kept"),
        (3, "added"),
    ]
    with pytest.raises(keys.DuplicateKeyError):
        keys.upsert(target, source.unionByName(source.filter("id = 1")), ["id"])


def test_tables(spark, schema):
    name, folder = schema
    ensure_namespace(spark, name, folder)
    ensure_namespace(spark, name, folder)
    reviews = f"{name}.reviews"
    for _ in range(2):
        ensure_table(spark, reviews, REVIEWS)
        header = "SELECT 'me' AS created_by, 1L AS access_review_id, timestamp'2024-01-01' AS created_date"
        append(spark.sql(header), reviews)
    assert spark.table(reviews).count() == 2
    published = publish(spark.range(3), f"{name}.numbers")
    published = publish(spark.range(5), f"{name}.numbers")
    assert published.count() == 5


def test_replaced_partition_leaves_the_others(spark, schema):
    name, folder = schema
    ensure_namespace(spark, name, folder)
    table = f"{name}.detail"
    ensure_table(spark, table, REVIEW_DETAIL, partition_by=["access_review_id"])

    def detail(n):
        others = [F.lit("x").alias(f.name) for f in REVIEW_DETAIL.fields[3:]]
        return spark.range(n).select(
            F.lit(3).alias("outcome_id"), F.col("id").alias("access_review_detail_id"), *others
        )

    for review, n in ((1, 4), (2, 5), (2, 6)):
        replace_partition(detail(n), table, "access_review_id", review)
    assert rows(spark.table(table).groupBy("access_review_id").count()) == [(1, 4), (2, 6)]
