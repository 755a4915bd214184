"""Import of reviewed files as streams: each file is imported once."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from custodia.sources.reviews import CSV_FILES, FILE_NAME, REJECTED, review_rows

#: Partition column of imported rows.
READABLE = "readable"


def read_review_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Rows of new CSV files under a directory; a backlog is worked off in batches of bounded size."""
    reader = spark.readStream.option("pathGlobFilter", CSV_FILES).option("maxFilesPerTrigger", files_per_batch)
    return review_rows(reader, path)


def enrich_import(df: DataFrame) -> DataFrame:
    """All rows without the row number, with the time of import and the file name, and whether they are readable."""
    kept = [name for name in df.columns if name not in ("_c0", FILE_NAME, REJECTED)]
    return df.select(
        *kept,
        F.current_timestamp().alias("import_timestamp"),
        FILE_NAME,
        REJECTED,
        F.col(REJECTED).isNull().alias(READABLE),
    )


def start_import(df: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Append everything that is new since the last run to a table, readable rows apart from others, then stop."""
    writer = df.writeStream.format("parquet").partitionBy(READABLE).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).toTable(table)


def show_imports(spark: SparkSession, rows_table: str, table: str) -> None:
    """Views of the readable rows, as ``table``, and of the others, as ``<table>_rejects``."""
    columns = [name for name in spark.table(rows_table).columns if name not in (READABLE, REJECTED)]
    apart = {table: (columns, READABLE), f"{table}_rejects": ([*columns, REJECTED], f"NOT {READABLE}")}
    for name, (listed, condition) in apart.items():
        if not spark.catalog.tableExists(name):
            spark.sql(f"CREATE VIEW {name} AS SELECT {', '.join(listed)} FROM {rows_table} WHERE {condition}")


def import_reviews(spark: SparkSession, path: str, table: str, checkpoint: str) -> DataFrame:
    """Import new review files and return the table of all imported rows.

    Each file is read once, by one stream, whose rows go to ``<table>_rows``, partitioned
    by whether they can be read. A batch is committed as a whole, so a run that dies at
    any point leaves both views right, and the next one takes up the batch again. A
    file with other columns stops the import.
    """
    rows_table = f"{table}_rows"
    stream = start_import(enrich_import(read_review_stream(spark, path)), rows_table, checkpoint)
    try:
        stream.awaitTermination()
    finally:
        stream.stop()
    # Another session may have added files since this one listed them.
    spark.catalog.refreshTable(rows_table)
    show_imports(spark, rows_table, table)
    return spark.table(table)
