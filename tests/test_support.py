from datetime import datetime, timedelta

from core_helpers import rows
from custodia.plans.support import cluster_version_support, support_counter, support_histogram, support_table

AS_OF = "2024-06-01 19:00:00"
MIDNIGHT = datetime(2024, 6, 1)


def given(spark):
    clusters = spark.createDataFrame(
        [("c1", "C1", "Ann", "15.4"), ("c2", "C2", None, "15.4"), ("c3", "C3", "Bob", "9.1"), ("c4", "C4", "Bob", None)],
        "cluster_id string, cluster_name string, owner string, spark_version_number string",
    )
    runtimes = spark.createDataFrame(
        [
            ("15.4", "all", MIDNIGHT, MIDNIGHT + timedelta(days=61)),
            ("16.0", "all", MIDNIGHT, MIDNIGHT - timedelta(days=400)),
            ("9.9", "all", MIDNIGHT, None),
        ],
        "spark_version_number string, variants string, release_date timestamp, end_of_support_date timestamp",
    )
    return clusters, runtimes


def test_unlisted_versions_vanish_and_missing_owners_are_named(spark):
    support = cluster_version_support(*given(spark), AS_OF)
    assert support.columns == [
        "cluster_id",
        "cluster_name",
        "object_owner",
        "spark_version_number",
        "variants",
        "release_date",
        "end_of_support_date",
        "days_until_end_of_support",
    ]
    assert rows(support.select("cluster_id", "object_owner", "days_until_end_of_support")) == [
        ("c1", "Ann", 60),
        ("c2", "Not tagged", 60),
    ]


def test_reports(spark):
    clusters, runtimes = given(spark)
    table = support_table(cluster_version_support(clusters, runtimes, AS_OF))
    assert [r.support_label for r in table.collect()] == ["orange", "orange"]
    assert rows(support_histogram(clusters, runtimes)) == [("15.4", datetime(2024, 8, 1), 2)]
    assert rows(support_counter(clusters, runtimes, AS_OF)) == [(60, "orange")]
    assert rows(support_counter(clusters.limit(0), runtimes, AS_OF)) == [(None, "default")]


def test_reports_agree_with_the_relation(testbed):
    clusters, runtimes = testbed.clusters(), testbed.runtime_versions()
    support = cluster_version_support(clusters, runtimes, AS_OF)
    assert support_histogram(clusters, runtimes).agg({"n_clusters": "sum"}).first()[0] == support.count()
    least = support.agg({"days_until_end_of_support": "min"}).first()[0]
    assert support_counter(clusters, runtimes, AS_OF).first()[0] == least


def test_versions_listed_twice_count_twice(spark):
    clusters, runtimes = given(spark)
    twice = runtimes.unionByName(runtimes)
    assert cluster_version_support(clusters, twice, AS_OF).count() == 4
    assert support_histogram(clusters, twice).first().n_clusters == 4
