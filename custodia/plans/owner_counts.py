"""Privileges per owner, kept as a published table for each kind of object.

A kind is counted again only when the grants or the objects that it joins have a new
version. The counts and what they were made from are published as one version.
"""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custodia.operators.keys import exclude_owners
from custodia.operators.versions import newest_versions, publish_version, published, read_version
from custodia.plans.privileges import KINDS, SYSTEM_OWNERS, counts_of_kind
from custodia.sources.catalog import INVENTORY_TABLES

INPUTS = "owner_counts_inputs"


def count_table(kind: str) -> str:
    return f"owner_counts_{kind}"


def renew_owner_counts(spark: SparkSession, schema: str, inventory_schema: str, metadata_schema: str) -> list[str]:
    """Count the kinds whose tables have changed since the last run, and publish their counts; returns these kinds.

    Tables that are not published by version count as changed. One run at a time keeps
    the counts of a schema. The driver holds two numbers for each kind.
    """
    seen = {name: published(spark, name) for name in {inventory_schema, metadata_schema}}

    def home(table: str) -> str:
        return inventory_schema if table in INVENTORY_TABLES else metadata_schema

    def version(table: str) -> int | None:
        return newest_versions(seen[home(table)]).get(table)

    now = {kind: (version(KINDS[kind].grants), version(KINDS[kind].objects)) for kind in KINDS}
    known = {}
    if INPUTS in newest_versions(published(spark, schema)):
        rows = read_version(spark, schema, [INPUTS])[INPUTS].collect()
        known = {row.kind: (row.grants_version, row.objects_version) for row in rows}
    changed = [kind for kind in KINDS if None in now[kind] or now[kind] != known.get(kind)]
    if not changed:
        return []

    def frame(table: str) -> DataFrame:
        return read_version(spark, home(table), [table], seen[home(table)])[table]

    frames = {count_table(kind): counts_of_kind(kind, frame(KINDS[kind].grants), frame(KINDS[kind].objects)) for kind in changed}
    made_from = [(kind, *versions) for kind, versions in now.items()]
    inputs = spark.createDataFrame(made_from, "kind string, grants_version long, objects_version long")
    publish_version(spark, schema, frames | {INPUTS: inputs})
    return changed


def owner_totals(spark: SparkSession, schema: str, without=SYSTEM_OWNERS) -> DataFrame:
    """Number of privileges per owner, from the kept counts, all of one moment."""
    counts = read_version(spark, schema, [count_table(kind) for kind in KINDS]).values()
    every = exclude_owners(reduce(DataFrame.unionByName, counts), without)
    return every.groupBy("object_owner").agg(F.sum("n_privileges").alias("n_privileges"))
