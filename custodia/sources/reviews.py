"""Review outcomes and review files."""

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.types import StringType, StructField, StructType

from custodia.schemas import OUTCOMES, REVIEW_CSV

# Ids and texts of the review outcomes.
REVIEW_OUTCOMES = [
    (1, "Approved"),
    (2, "Denied"),
    (3, "Not reviewed"),
    (4, "Don't know"),
]

DEFAULT_OUTCOME = 3

#: Review files, plain and compressed.
CSV_FILES = "{*.csv,*.csv.gz}"

#: Columns for a file's name and for the text of a row that cannot be read.
FILE_NAME, REJECTED = "import_file_name", "rejected"

# How review files are written and read. Quotes are doubled, as spreadsheet
# programs do, and a value may hold a line break. Files are bounded by the
# export, so reading one file per task is no limit.
CSV_READ = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "multiLine": True,
    "recursiveFileLookup": True,
}
CSV_WRITE = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def review_outcomes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(REVIEW_OUTCOMES, OUTCOMES)


def review_rows(reader: DataFrameReader | DataStreamReader, path: str) -> DataFrame:
    """All rows of review files under a directory.

    A file whose header differs, in names or order, fails the read. A row with a value
    that does not fit its type has its text in ``rejected``; other rows have null there.
    Only columns that a query uses are parsed, so one that uses all finds every bad value.
    """
    # The row number stands under a blank header.
    blank = StructType([StructField("", REVIEW_CSV[0].dataType), *REVIEW_CSV.fields[1:], StructField(REJECTED, StringType())])
    options = CSV_READ | {"enforceSchema": False, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": REJECTED}
    rows = reader.schema(blank).options(**options).csv(path)
    # Whether a file was compressed is no part of its name.
    file_name = F.regexp_replace("_metadata.file_name", r"\.csv\.gz$", ".csv")
    named = [file_name.alias(FILE_NAME), *[F.col(f"`{name}`") for name in blank.names]]
    return rows.select(*named).toDF(FILE_NAME, *REVIEW_CSV.names, REJECTED)


def read_reviews_csv(spark: SparkSession, path: str, glob: str = CSV_FILES) -> DataFrame:
    """Readable rows of the review files under a directory whose names fit ``glob``."""
    rows = review_rows(spark.read.option("pathGlobFilter", glob), path)
    return rows.filter(F.col(REJECTED).isNull()).select(*REVIEW_CSV.names, FILE_NAME)


def read_rejected_reviews(spark: SparkSession, path: str, glob: str = CSV_FILES) -> DataFrame:
    """Rows that `read_reviews_csv` leaves out: file name, text, and what could be read."""
    return review_rows(spark.read.option("pathGlobFilter", glob), path).filter(F.col(REJECTED).isNotNull())
