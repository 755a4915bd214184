"""Shared scratch folder for written intermediate tables."""

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Options of a writer of compressed text files. A higher level takes more time than it saves.
GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor reaches: ``spark.checkpoint.dir``, or else one in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"


def new_folder(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write a derived table and read it back.

    This cuts the lineage, survives lost executors, and gives the planner the
    table's true size, so that it broadcasts the table only if that is small.
    """
    spark = df.sparkSession
    path = path or new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever it is stored."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


class Staging:
    """Folders of one job, to be removed together."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def folder(self, name: str) -> str:
        self.paths.append(new_folder(self.spark, name))
        return self.paths[-1]

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        return stage(df, name, self.folder(name))


@contextmanager
def staging(spark: SparkSession) -> Iterator[Staging]:
    """Folders that are gone after the block; write what depends on them inside it."""
    scope = Staging(spark)
    try:
        yield scope
    finally:
        for path in scope.paths:
            remove_folder(spark, path)
