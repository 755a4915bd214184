"""How long the runtime of each cluster stays supported."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custodia.functions.scalars import days_until, month_of, support_label
from custodia.plans.privileges import NOT_TAGGED


def support_query(clusters: str, runtimes: str, now: str = "current_timestamp()") -> str:
    """Clusters on a listed runtime with its dates; clusters on any other runtime are left out."""
    return f"""
        SELECT c.cluster_id, c.cluster_name, ifnull(c.owner, '{NOT_TAGGED}') AS object_owner,
               c.spark_version_number, r.variants, r.release_date, r.end_of_support_date,
               timestampdiff(DAY, {now}, r.end_of_support_date) AS days_until_end_of_support
        FROM {clusters} c JOIN {runtimes} r ON r.spark_version_number = c.spark_version_number
    """


def cluster_version_support(clusters: DataFrame, runtimes: DataFrame, as_of=None) -> DataFrame:
    """`support_query` over frames.

    The list of runtimes is broadcast if its files are small, which they are
    unless the list is wrong; Spark checks that.
    """
    now = "current_timestamp()" if as_of is None else f"timestamp '{as_of}'"
    query = support_query("{clusters}", "{runtimes}", now)
    return clusters.sparkSession.sql(query, clusters=clusters, runtimes=runtimes)


def support_table(support: DataFrame) -> DataFrame:
    """The columns shown in the report, with the warning label."""
    return support.select(
        "days_until_end_of_support",
        "end_of_support_date",
        "cluster_name",
        "object_owner",
        "spark_version_number",
        support_label("days_until_end_of_support").alias("support_label"),
    )


def _clusters_per_runtime(clusters: DataFrame, runtimes: DataFrame) -> DataFrame:
    # A few versions hold most clusters: count them before the join.
    counts = clusters.groupBy("spark_version_number").agg(F.count("*").alias("n"))
    return counts.join(runtimes, "spark_version_number")


def support_histogram(clusters: DataFrame, runtimes: DataFrame) -> DataFrame:
    """Clusters per runtime and month in which its support ends."""
    return (
        _clusters_per_runtime(clusters, runtimes)
        .groupBy("spark_version_number", month_of("end_of_support_date").alias("end_of_support_month"))
        .agg(F.sum("n").alias("n_clusters"))
    )


def support_counter(clusters: DataFrame, runtimes: DataFrame, as_of=None) -> DataFrame:
    """Days until the next cluster leaves support, with the warning label; null without clusters."""
    days = _clusters_per_runtime(clusters, runtimes).select(days_until("end_of_support_date", as_of).alias("days"))
    soonest = days.agg(F.min("days").alias("min_days_until_end_of_support"))
    return soonest.withColumn("support_label", support_label("min_days_until_end_of_support"))
