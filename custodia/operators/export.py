"""Review export: CSV files per owner."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from custodia.functions.names import slug
from custodia.operators.keys import count_by_owner, latest_review
from custodia.schemas import REVIEW_DETAIL
from custodia.sources.reviews import CSV_WRITE
from custodia.storage import GZIP, Staging, staging

ROWS_PER_FILE = 1_000_000
#: Buckets of names, over which the driver adds up.
BUCKETS = 4096


def owner_files(review: DataFrame, rows_per_file: int, allow_unicode: bool = False) -> DataFrame:
    """Per owner of a review: the file name and the number of files under that name.

    Owners whose names have one slug share it, and the number follows from the
    rows of all of them. Slugs are computed once per owner.
    """
    owner = F.ifnull("object_owner", F.lit("None"))
    named = review.select("object_owner", F.concat_ws("_", "access_review_id", owner).alias("name"))
    per_owner = named.groupBy("object_owner", "name").agg(F.count("*").alias("n_rows"))
    slugged = per_owner.select("object_owner", slug("name", allow_unicode).alias("owner_slug"), "n_rows")
    slug_rows = F.sum("n_rows").over(W.partitionBy("owner_slug"))  # one row per owner
    return slugged.withColumn("n_files", F.ceil(slug_rows / rows_per_file).cast("int"))


def part_of(n_files) -> Column:
    """The part that a row of a name with several files belongs to; 0 for a name with one."""
    return F.pmod(F.xxhash64("access_review_detail_id"), n_files).cast("int")


def part_counts(review: DataFrame, files: DataFrame) -> DataFrame:
    """Rows per file: owner_slug, part, n, split.

    Names with one file are counted already. Only rows of the others are looked at again,
    and only their owner and id.
    """
    whole = files.filter("n_files = 1").groupBy("owner_slug").agg(F.sum("n_rows").alias("n"))
    split = files.filter("n_files > 1").select(F.col("object_owner").alias("owner"), "owner_slug", "n_files")
    rows = review.select("object_owner", "access_review_detail_id").join(split, F.col("object_owner").eqNullSafe(F.col("owner")))
    parts = rows.groupBy("owner_slug", part_of(F.col("n_files")).alias("part")).agg(F.count("*").alias("n"))
    return whole.select("owner_slug", F.lit(0).alias("part"), "n", F.lit(False).alias("split")).unionByName(
        parts.withColumn("split", F.lit(True))
    )


def file_tasks(files: DataFrame, rows_per_file: int) -> tuple[DataFrame, int]:
    """Per file (owner_slug, part): the number of its first row, and the task that writes it; and the number of tasks.

    A part of a split name has a task of its own. Names of one file share tasks, which
    are full at half of ``rows_per_file``, so none gets more than 1.5 times that number.

    Sums over all files run in two levels: within buckets of names, and over the buckets,
    whose totals, `BUCKETS` rows, the driver adds up.
    """
    spark = files.sparkSession
    bucketed = files.withColumn("bucket", F.pmod(F.xxhash64("owner_slug"), F.lit(BUCKETS)).cast("int"))
    shared = F.when(F.col("split"), 0).otherwise(F.col("n"))
    totals = bucketed.groupBy("bucket").agg(F.sum(shared).alias("n"), F.count_if("split").alias("alone")).collect()
    starts, n_shared, n_alone = [], 0, 0
    for row in sorted(totals):
        starts.append((row.bucket, n_shared, n_alone))
        n_shared, n_alone = n_shared + row.n, n_alone + row.alone
    before = spark.createDataFrame(starts, "bucket int, shared_before long, alone_before long")
    in_bucket = W.partitionBy("bucket").orderBy("owner_slug", "part").rowsBetween(W.unboundedPreceding, -1)
    earlier = W.partitionBy("owner_slug").orderBy("part").rowsBetween(W.unboundedPreceding, -1)

    def so_far(value, window):
        return F.coalesce(F.sum(value).over(window), F.lit(0))

    summed = bucketed.select(
        "*",
        so_far(F.col("n"), earlier).alias("first"),
        so_far(shared, in_bucket).alias("shared"),
        so_far(F.col("split").cast("int"), in_bucket).alias("alone"),
    ).join(F.broadcast(before), "bucket")
    packed = n_alone + F.floor(2 * (F.col("shared") + F.col("shared_before")) / rows_per_file)
    task = F.when(F.col("split"), F.col("alone") + F.col("alone_before")).otherwise(packed)
    n_tasks = n_alone + 2 * max(0, n_shared - 1) // rows_per_file + 1
    return summed.select("owner_slug", "part", "first", task.cast("int").alias("task")), n_tasks


def export_rows(review: DataFrame, files: DataFrame, rows_per_file: int, staged: Staging) -> DataFrame:
    """Review rows, numbered from 0 within a slug, with the slug to write them under, in the tasks that do.

    An owner with more than ``rows_per_file`` rows is split by row id into parts of
    about that size. Counts per part tell where its numbers start, so they have no
    gaps, and no row is ordered outside of its part.
    """
    tasks, n_tasks = file_tasks(staged.stage(part_counts(review, files), "file-rows"), rows_per_file)
    parted = (
        review.join(files.drop("n_rows"), review["object_owner"].eqNullSafe(files["object_owner"]))
        .drop(files["object_owner"])
        .withColumn("part", part_of(F.col("n_files")))
    )
    spread = parted.join(staged.stage(tasks, "file-tasks"), ["owner_slug", "part"]).repartitionById(n_tasks, "task")
    in_part = W.partitionBy("task", "owner_slug", "part").orderBy("access_review_detail_id")
    number = (F.col("first") + F.row_number().over(in_part) - 1).cast("bigint")
    return spread.select(number.alias("_c0"), *REVIEW_DETAIL.names, "owner_slug")


def export_review(
    detail: DataFrame,
    reviews: DataFrame,
    out_dir: str,
    rows_per_file: int = ROWS_PER_FILE,
    allow_unicode: bool = False,
    compressed: bool = False,
) -> DataFrame:
    """Write the latest review as CSV under ``<out_dir>/owner_slug=<review id>-<owner>/``, compressed if wanted.

    An owner of at most ``rows_per_file`` rows gets one file. The owner stays a
    column, so owners that share a slug stay apart. Files of earlier reviews are
    kept, files of this one are replaced. Returns the owners and their files, which
    are written to ``<out_dir>/_owners``; readers of the directory pass over it.
    """
    spark = detail.sparkSession
    review = latest_review(detail, reviews)
    listed = f"{out_dir}/_owners"
    owner_files(review, rows_per_file, allow_unicode).write.mode("overwrite").parquet(listed)
    files = spark.read.parquet(listed)
    with staging(spark) as staged:
        rows = export_rows(review, files, rows_per_file, staged)
        options = CSV_WRITE | (GZIP if compressed else {})
        writer = rows.withColumnRenamed("_c0", "").write.options(**options).partitionBy("owner_slug")
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").csv(out_dir)
    return files


def owner_counts(detail: DataFrame, reviews: DataFrame) -> DataFrame:
    """Rows per owner of the latest review."""
    return count_by_owner(latest_review(detail, reviews))
