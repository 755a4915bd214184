"""Tables that are published together, as versions, and switched by one pointer.

The rows of a table ``t`` lie in ``t__versions``, a partition for each version. The table
``published_versions`` has a row for each version with the tables and columns in it; it
is the pointer, and adding that row is the one step that makes a version visible, all its
tables at once. ``t`` itself is a view of the newest version that has the table, found
when a query runs, so it never has to be replaced to show new rows and is never missing.

A statement that reads several views sees one version of each, at the time it runs. A
program that reads several tables one after the other takes them from `read_version`,
which looks at the pointer once.
"""

import json
import threading
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from custodia.operators.partitions import drop_partitions, schema_folder, write_partition

POINTER = "published_versions"
#: Partition column of the rows of all versions.
VERSION = "published_version"
#: Versions of a table that stay for queries that have begun.
KEPT = 2

_CLAIM = threading.Lock()


def claim(spark: SparkSession, folder: str, first: int) -> int:
    """The lowest number from ``first`` on that no other run has, taken by creating a file that must not exist.

    The file system of the folder decides between runs on several machines.
    """
    jvm = spark.sparkContext._jvm
    files = jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    number = first
    while True:
        path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{number}")
        try:
            # Local file systems look and create in two steps, so runs of one driver take turns.
            with _CLAIM:
                files.create(path, False).close()
            return number
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in error.java_exception.getClass().getName():
                raise
            number += 1


def _rows_table(schema: str, table: str) -> str:
    return f"{schema}.{table}__versions"


def _is_versioned(spark: SparkSession, schema: str) -> bool:
    return spark.catalog.tableExists(f"{schema}.{POINTER}")


def published(spark: SparkSession, schema: str) -> dict[int, dict[str, list[str]]]:
    """Tables and their columns by version; what `remove_old` leaves, so a few rows."""
    if not _is_versioned(spark, schema):
        return {}
    pointer = f"{schema}.{POINTER}"
    spark.catalog.refreshTable(pointer)
    return {row.version: dict(row.tables) for row in spark.table(pointer).collect()}


def newest_versions(versions: dict[int, dict[str, list[str]]]) -> dict[str, int]:
    """Table -> the newest version that has it."""
    return {table: version for version in sorted(versions) for table in versions[version]}


def read_version(
    spark: SparkSession,
    schema: str,
    tables: Iterable[str] | None = None,
    versions: dict[int, dict[str, list[str]]] | None = None,
) -> dict[str, DataFrame]:
    """Published tables, all as of one look at the pointer; those never published by version are read as they are.

    ``versions`` is what an earlier look, by `published`, has shown.
    """
    versions = published(spark, schema) if versions is None else versions
    newest = newest_versions(versions)
    frames = {}
    for table in newest if tables is None else tables:
        if table in newest:
            rows = spark.table(_rows_table(schema, table)).filter(F.col(VERSION) == newest[table])
            frames[table] = rows.select(*versions[newest[table]][table])
        else:
            frames[table] = spark.table(f"{schema}.{table}")
    return frames


def _prepare(spark: SparkSession, schema: str, table: str, wanted: StructType) -> None:
    """Create the table for a relation's rows, or add the columns that it lacks."""
    name = _rows_table(schema, table)
    # A column may be absent from another version, so all may be null.
    types = {field.name: field.dataType.simpleString() for field in wanted}
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{column}` {kind}" for column, kind in types.items())
        spark.sql(f"CREATE TABLE {name} ({columns}, {VERSION} BIGINT) USING parquet PARTITIONED BY ({VERSION})")
        return
    held = {field.name: field.dataType.simpleString() for field in spark.table(name).schema}
    for column, kind in types.items():
        if column not in held:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS (`{column}` {kind})")
        elif held[column] != kind:
            raise TypeError(f"column {column} of {schema}.{table} is published as {held[column]}, not {kind}")


def _write(df: DataFrame, schema: str, table: str, version: int) -> None:
    """All rows of a version."""
    _prepare(df.sparkSession, schema, table, df.schema)
    write_partition(df, _rows_table(schema, table), VERSION, version)


def _show(spark: SparkSession, schema: str, table: str, columns: list[str]) -> None:
    """The view of a table's newest version."""
    newest = f"SELECT max(version) FROM {schema}.{POINTER} WHERE map_contains_key(tables, '{table}')"
    listed = ", ".join(f"`{name}`" for name in columns)
    rows = _rows_table(schema, table)
    spark.sql(f"CREATE OR REPLACE VIEW {schema}.{table} AS SELECT {listed} FROM {rows} WHERE {VERSION} = ({newest})")


def publish_version(spark: SparkSession, schema: str, frames: dict[str, DataFrame], kept: int = KEPT) -> int:
    """Write frames as the tables of a new version, which shows up at once when all are complete.

    A run that fails at any point before leaves every table as it was; what it wrote is
    never shown and removed with old versions. Of runs side by side, the one that began
    last wins. Columns that a new version lacks are gone from its tables; a column whose
    type changes stops the run.
    """
    pointer = f"{schema}.{POINTER}"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {pointer} (tables MAP<STRING, ARRAY<STRING>>, published_at TIMESTAMP, version BIGINT) "
        # Only superseded entries are ever removed, so a reader does not need those that go while it reads.
        "USING parquet OPTIONS (ignoreMissingFiles 'true') PARTITIONED BY (version)"
    )
    versions = published(spark, schema)
    version = claim(spark, f"{schema_folder(spark, schema)}/_{POINTER}", max(versions, default=0) + 1)
    with ThreadPoolExecutor(len(frames)) as pool:
        jobs = [pool.submit(_write, df, schema, table, version) for table, df in frames.items()]
        for job in jobs:
            job.result()
    columns = {table: df.columns for table, df in frames.items()}
    newest = newest_versions(versions)
    for table in frames:
        if table not in newest or versions[newest[table]][table] != columns[table]:
            _show(spark, schema, table, columns[table])
    listed = F.from_json(F.lit(json.dumps(columns)), "map<string, array<string>>").alias("tables")
    row = spark.range(1).select(listed, F.current_timestamp().alias("published_at"))
    write_partition(row, pointer, "version", version)
    remove_old(spark, schema, kept)
    return version


def remove_old(spark: SparkSession, schema: str, kept: int = KEPT) -> None:
    """Drop all but the newest ``kept`` versions of every table, and what failed runs before them left."""
    versions = published(spark, schema)
    needed = set()
    for table in newest_versions(versions):
        having = sorted((version for version in versions if table in versions[version]), reverse=True)[:kept]
        needed.update(having)
        drop_partitions(spark, _rows_table(schema, table), lambda oldest=having[-1], **at: at[VERSION] < oldest)
    # First the rows, then their entry, so nothing is listed without its rows being tried.
    drop_partitions(spark, f"{schema}.{POINTER}", lambda version: version not in needed and version < max(needed))
