"""Access reviews: a snapshot of all privileges to be judged by their owners."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from custodia.functions.scalars import stamp
from custodia.operators.keyed import ensure_keyed_table, upsert_table
from custodia.operators.keys import latest_id, next_id, numbered_ids
from custodia.operators.partitions import schema_folder
from custodia.operators.sinks import ensure_namespace, ensure_table, replace_partition
from custodia.operators.versions import claim
from custodia.schemas import OUTCOMES, PRIVILEGE_COLUMNS, REVIEW_DETAIL, REVIEWS
from custodia.sources.reviews import DEFAULT_OUTCOME, review_outcomes


def snapshot(privileges: DataFrame, review_id: int | Column) -> DataFrame:
    """Every privilege as a row of the given review, not reviewed yet.

    ``review_id`` is a number or a scalar subquery.
    """
    review = review_id if isinstance(review_id, Column) else F.lit(review_id)
    return privileges.select(
        review.cast("bigint").alias("access_review_id"),
        F.lit(DEFAULT_OUTCOME).alias("outcome_id"),
        *PRIVILEGE_COLUMNS,
    )


@dataclass(frozen=True)
class ReviewTables:
    """The three tables of a review schema."""

    schema: str

    @property
    def outcomes(self) -> str:
        return f"{self.schema}.access_review_outcomes"

    @property
    def reviews(self) -> str:
        return f"{self.schema}.access_reviews"

    @property
    def detail(self) -> str:
        return f"{self.schema}.access_review_detail"


def ensure_review_tables(spark: SparkSession, schema: str, location: str | None = None) -> ReviewTables:
    """Create what is missing and bring the outcomes up to date."""
    tables = ReviewTables(schema)
    ensure_namespace(spark, schema, location)
    ensure_keyed_table(spark, tables.outcomes, OUTCOMES, ["outcome_id"], required=["outcome_value"], buckets=4)
    ensure_table(spark, tables.reviews, REVIEWS, partition_by=["access_review_id"], key=["access_review_id"])
    ensure_table(
        spark, tables.detail, REVIEW_DETAIL, partition_by=["access_review_id"], key=["access_review_detail_id"]
    )
    upsert_table(review_outcomes(spark), tables.outcomes)
    return tables


def create_review(
    privileges: DataFrame, schema: str, by: str | None = None, at=None, location: str | None = None
) -> int:
    """Snapshot all privileges as a new review and return its id.

    The id is claimed first, so runs side by side create reviews of their own. The
    detail is one partition, checked and written before the header. A review therefore
    shows up only when it is complete; what a failed run leaves is never seen. Ids of rows
    hold the id of their review, so they ascend over reviews and no two are the same.
    """
    spark = privileges.sparkSession
    tables = ensure_review_tables(spark, schema, location)
    claims = f"{schema_folder(spark, schema)}/_access_reviews"
    review_id = claim(spark, claims, next_id(spark.table(tables.reviews), "access_review_id"))
    rows = numbered_ids(snapshot(privileges, review_id), "access_review_detail_id", review_id)
    replace_partition(rows, tables.detail, "access_review_id", review_id)
    replace_partition(stamp(spark.range(1).drop("id"), user=by, now=at), tables.reviews, "access_review_id", review_id)
    return review_id


def newest_review_id(reviews: DataFrame) -> Column:
    """The newest review id as a scalar subquery."""
    return latest_id(reviews, "access_review_id").scalar()
