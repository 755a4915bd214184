import csv
import glob
import json
import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from core_helpers import rows
from custodia.operators.export import export_review, file_tasks, owner_files
from custodia.operators.sinks import publish, replace_partition
from custodia.plans.privileges import all_privileges
from custodia.plans.review import ReviewTables, create_review, snapshot
from custodia.schemas import PRIVILEGE_COLUMNS, REVIEW_DETAIL, REVIEWS
from custodia.sources.reviews import read_rejected_reviews, read_reviews_csv
from custodia.storage import shared_folder
from custodia.streaming.review_import import enrich_import, import_reviews, read_review_stream

OWNERS = ["A B", "a-b", "Zoë", "中文", "Not tagged", None]


def privileges(spark, per_owner=3):
    data = []
    for owner in OWNERS:
        for i in range(per_owner):
            data.append(("table", f'na"me, {i}\nline', owner, " g ", "N/A", "", None, "a\\b", "NONE"))
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in PRIVILEGE_COLUMNS))


@pytest.fixture
def review(spark, schema):
    name, folder = schema
    create_review(privileges(spark), name, by="tester", at="2024-01-01 00:00:00", location=folder)
    tables = ReviewTables(name)
    return spark.table(tables.detail), spark.table(tables.reviews)


def test_each_run_adds_a_complete_review(spark, schema):
    name, folder = schema
    tables = ReviewTables(name)
    data = privileges(spark)
    assert create_review(data, name, location=folder) == 1
    # What a failed run leaves behind: rows without a header.
    stray = snapshot(data.limit(2), 2).withColumn("access_review_detail_id", F.monotonically_increasing_id())
    replace_partition(stray, tables.detail, "access_review_id", 2)
    assert create_review(data, name, by="me", at="2024-01-01 00:00:00") == 2
    detail = spark.table(tables.detail)
    assert rows(detail.groupBy("access_review_id").count()) == [(1, 18), (2, 18)]
    assert detail.select("access_review_detail_id").distinct().count() == 36
    first, second = (
        [r[0] for r in detail.filter(f"access_review_id = {i}").select("access_review_detail_id").collect()]
        for i in (1, 2)
    )
    assert max(first) < min(second)
    assert rows(detail.select("outcome_id").distinct()) == [(3,)]
    assert spark.table(tables.outcomes).count() == 4
    headers = {r.access_review_id: r for r in spark.table(tables.reviews).collect()}
    assert set(headers) == {1, 2}
    assert headers[2].created_by == "me"
    assert rows(detail.filter("access_review_id = 2").select(PRIVILEGE_COLUMNS)) == rows(data)


def test_files_per_owner(spark, review, tmp_path):
    detail, reviews = review
    files = export_review(detail, reviews, str(tmp_path / "out"))
    slugs = {r.object_owner: (r.owner_slug, r.n_files) for r in files.collect()}
    assert slugs == {
        "A B": ("1_a-b", 1),
        "a-b": ("1_a-b", 1),
        "Zoë": ("1_zoe", 1),
        "中文": ("1", 1),
        "Not tagged": ("1_not-tagged", 1),
        None: ("1_none", 1),
    }
    found = {p.parent.name: p for p in Path(tmp_path / "out").glob("*/*.csv")}
    assert len(list(Path(tmp_path / "out").glob("*/*.csv"))) == 5
    assert set(found) == {f"owner_slug={s}" for s, _ in slugs.values()}
    with open(found["owner_slug=1_a-b"], newline="") as handle:
        header, *lines = list(csv.reader(handle))
    assert header == ["", *REVIEW_DETAIL.names]
    assert sorted(int(line[0]) for line in lines) == list(range(6))
    assert {line[header.index("object_owner")] for line in lines} == {"A B", "a-b"}


def test_unicode_names(spark, review):
    detail, _ = review
    files = owner_files(detail, 10, allow_unicode=True)
    assert {r.object_owner: r.owner_slug for r in files.collect()}["中文"] == "1_中文"


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_a_large_owner_is_split_and_small_ones_are_not(spark, tmp_path, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        check_split(spark, tmp_path)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def check_split(spark, tmp_path):
    rows_per_file = 1000
    detail = spark.range(30_000).select(
        F.col("id").alias("access_review_detail_id"),
        F.lit(4).cast("bigint").alias("access_review_id"),
        F.lit(3).alias("outcome_id"),
        *[
            (
                F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("o"), F.col("id") % 20))
                if name == "object_owner"
                else F.lit("x")
            ).alias(name)
            for name in PRIVILEGE_COLUMNS
        ],
    )
    reviews = spark.createDataFrame([(4, None, None)], REVIEWS)
    files = export_review(detail, reviews, str(tmp_path), rows_per_file)
    assert {r.n_files for r in files.collect() if r.object_owner != "hot"} == {1}
    sizes = {}
    for path in Path(tmp_path).glob("*/*.csv"):
        sizes.setdefault(path.parent.name, []).append(sum(1 for _ in open(path)) - 1)
    assert sum(sizes["owner_slug=4_hot"]) == 20_000
    assert len(sizes["owner_slug=4_hot"]) > 5
    # Parts differ by their hash spread only.
    assert max(sizes["owner_slug=4_hot"]) < 1.25 * rows_per_file
    assert all(len(found) == 1 for name, found in sizes.items() if name != "owner_slug=4_hot")
    back = read_reviews_csv(spark, str(tmp_path))
    assert rows(back.select("access_review_detail_id")) == rows(detail.select("access_review_detail_id"))
    numbers = back.filter("object_owner = 'hot'")
    assert rows(numbers.select(F.col("_c0").cast("int"))) == sorted([(i,) for i in range(20_000)], key=lambda r: str(r[0]))
    tasks = {path.name.split("-")[1] for path in Path(tmp_path).glob("owner_slug=4_hot/*.csv")}
    assert len(tasks) == len(sizes["owner_slug=4_hot"])


def test_export_again_replaces_only_its_own_review(spark, review, tmp_path):
    detail, reviews = review
    export_review(detail, reviews, str(tmp_path))
    other = tmp_path / "owner_slug=0_x"
    other.mkdir()
    (other / "x.csv").write_text("kept\n")
    export_review(detail, reviews, str(tmp_path))
    assert (other / "x.csv").exists()
    assert len(glob.glob(f"{tmp_path}/owner_slug=1*/*.csv")) == 5


def test_round_trip(spark, review, schema, tmp_path):
    """Exported, edited, imported: every row comes back once, however often the import runs."""
    detail, reviews = review
    export_review(detail, reviews, str(tmp_path / "out"))
    inbox = tmp_path / "in"
    inbox.mkdir()
    for path in (tmp_path / "out").glob("*/*.csv"):
        shutil.copy(path, inbox / f"{path.parent.name.removeprefix('owner_slug=')}.csv")
    (inbox / "notes.txt").write_text("not a review\n")
    table, checkpoint = f"{schema[0]}.access_review_import", str(tmp_path / "checkpoint")
    for _ in range(2):
        imported = import_reviews(spark, str(inbox), table, checkpoint)
        names = REVIEW_DETAIL.names
        assert imported.columns == [*names, "import_timestamp", "import_file_name"]
        # A blank field is null, so an empty text comes back as null.
        sent = detail.withColumn("schema_name", F.nullif("schema_name", F.lit("")))
        assert rows(imported.select(names)) == rows(sent.select(names))
    assert {r[0] for r in imported.select("import_file_name").distinct().collect()} == {
        "1_a-b.csv",
        "1_zoe.csv",
        "1.csv",
        "1_not-tagged.csv",
        "1_none.csv",
    }
    (inbox / "late.csv").write_text("," + ",".join(names) + "\n0,99,1,2,t,n,o,g,c,s,p,YES,NONE\n")
    imported = import_reviews(spark, str(inbox), table, checkpoint)
    assert imported.count() == detail.count() + 1
    late = imported.filter("import_file_name = 'late.csv'").first()
    assert (late.access_review_detail_id, late.outcome_id, late.object_type) == (99, 2, "t")
    assert late.import_timestamp is not None


def test_batch_read_takes_a_glob(spark, review, tmp_path):
    detail, reviews = review
    (tmp_path / "a.csv").write_text(f",{','.join(REVIEW_DETAIL.names)}\n0,1,1,3,t,\"a, b\",,g,c,s,p,NO,NONE\n")
    (tmp_path / "b.csv").write_text("h\n1,2\n")
    row = read_reviews_csv(spark, str(tmp_path), "a*.csv").first()
    assert (row.access_review_detail_id, row.object_name, row.object_owner) == (1, "a, b", None)
    assert row.import_file_name == "a.csv"
    stream = read_review_stream(spark, str(tmp_path))
    assert stream.isStreaming
    assert enrich_import(stream).columns == [
        *REVIEW_DETAIL.names, "import_timestamp", "import_file_name", "rejected", "readable"
    ]


def test_swapped_columns_are_refused(spark, schema, tmp_path):
    names = list(REVIEW_DETAIL.names)
    names[4], names[5] = names[5], names[4]
    (tmp_path / "a.csv").write_text(f",{','.join(names)}\n0,1,1,3,t,o,n,g,c,s,p,NO,NONE\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_reviews_csv(spark, str(tmp_path)).collect()
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema[0]} LOCATION '{schema[1]}'")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        import_reviews(spark, str(tmp_path), f"{schema[0]}.imported", str(tmp_path / "checkpoint"))


def test_unreadable_rows_are_kept_apart(spark, schema, tmp_path):
    good, bad = "0,1,1,3,t,n,o,g,c,s,p,NO,NONE", "1,2,1,two,t,n,o,g,c,s,p,NO,NONE"
    inbox = tmp_path / "in"
    inbox.mkdir()
    (inbox / "a.csv").write_text(f",{','.join(REVIEW_DETAIL.names)}\n{good}\n{bad}\n")
    assert [r.access_review_detail_id for r in read_reviews_csv(spark, str(inbox)).collect()] == [1]
    rejected = read_rejected_reviews(spark, str(inbox)).collect()
    assert [(r.import_file_name, r.rejected, r.object_name) for r in rejected] == [("a.csv", bad, "n")]
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema[0]} LOCATION '{schema[1]}'")
    imported = import_reviews(spark, str(inbox), f"{schema[0]}.imported", str(tmp_path / "checkpoint"))
    assert [r.access_review_detail_id for r in imported.collect()] == [1]
    rejects = spark.table(f"{schema[0]}.imported_rejects").collect()
    assert [(r.rejected, r.import_file_name) for r in rejects] == [(bad, "a.csv")]


GOOD, BAD = "0,{},1,3,t,n,o,g,c,s,p,NO,NONE", "1,{},1,two,t,n,o,g,c,s,p,NO,NONE"


def review_file(path, number):
    lines = [f",{','.join(REVIEW_DETAIL.names)}", GOOD.format(number), BAD.format(number)]
    path.write_text("\n".join(lines) + "\n")


def records_read(events):
    """Records that the tasks of an event log have read."""
    records = 0
    for log in Path(events).rglob("*"):
        if log.is_file() and log.name.startswith("events"):
            for line in log.read_text().splitlines():
                event = json.loads(line)
                if event["Event"] == "SparkListenerTaskEnd":
                    records += event["Task Metrics"]["Input Metrics"]["Records Read"]
    return records


def test_each_file_is_read_once(tmp_path):
    """In a session of its own, which writes an event log."""
    inbox = tmp_path / "in"
    inbox.mkdir()
    (tmp_path / "events").mkdir()
    for n in range(20):
        review_file(inbox / f"{n}.csv", n)
    script = tmp_path / "run.py"
    script.write_text(
        f"""
import sys
sys.path.insert(0, {str(Path(__file__).resolve().parent.parent)!r})
from pyspark.sql import SparkSession
builder = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", {str(tmp_path / "events")!r})
builder = builder.config("spark.eventLog.compress", "false").config("spark.sql.shuffle.partitions", "2")
spark = builder.config("spark.sql.warehouse.dir", {str(tmp_path / "warehouse")!r}).getOrCreate()
from custodia.streaming.review_import import import_reviews
spark.sql("CREATE SCHEMA s")
import_reviews(spark, {str(inbox)!r}, "s.imported", {str(tmp_path / "checkpoint")!r})
spark.stop()
"""
    )
    subprocess.run([sys.executable, str(script)], check=True, timeout=300)
    # Two rows a file and no header; two passes would read twice as many.
    assert 40 <= records_read(tmp_path / "events") <= 60


def test_a_killed_batch_is_taken_up_again(spark, schema, tmp_path):
    """The run dies when some of the batch's files are written and its commit is not."""
    name, folder = schema
    spark.sql(f"CREATE SCHEMA {name} LOCATION '{folder}'")
    inbox, checkpoint, table = tmp_path / "in", str(tmp_path / "checkpoint"), f"{name}.imported"
    inbox.mkdir()
    review_file(inbox / "a.csv", 1)
    import_reviews(spark, str(inbox), table, checkpoint)
    review_file(inbox / "b.csv", 2)
    (inbox / "c.csv").write_text("other,columns\n1,2\n")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        import_reviews(spark, str(inbox), table, checkpoint)
    ids = "access_review_detail_id"
    assert rows(spark.table(table).select(ids)) == rows(spark.table(f"{table}_rejects").select(ids)) == [(1,)]
    # The batch is planned already; now its files can be read.
    review_file(inbox / "c.csv", 3)
    for _ in range(2):
        import_reviews(spark, str(inbox), table, checkpoint)
        assert rows(spark.table(table).select(ids)) == [(1,), (2,), (3,)]
        assert rows(spark.table(f"{table}_rejects").select(ids)) == [(1,), (2,), (3,)]


def test_an_export_leaves_no_scratch_tables(spark, review, tmp_path):
    def scratch():
        return {p.name for p in Path(shared_folder(spark)).glob("*")}

    before = scratch()
    export_review(*review, str(tmp_path))
    assert scratch() == before


def test_a_failed_publish_keeps_the_table(spark, schema):
    name, folder = schema
    spark.sql(f"CREATE SCHEMA {name} LOCATION '{folder}'")
    table = f"{name}.t"
    publish(spark.range(5), table)
    broken = spark.range(5).select(F.raise_error(F.lit("broken")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="broken"):
        publish(broken, table)
    assert spark.table(table).count() == 5
    assert publish(spark.range(6), table).count() == 6


def test_review_of_the_test_tables(spark, testbed, schema):
    name, folder = schema
    data = all_privileges(testbed.frames())
    create_review(data, name, location=folder)
    assert spark.table(ReviewTables(name).detail).count() == data.count()


def many_files(spark, n):
    """One file for each of n names, and every thousandth name split into three."""
    name = F.format_string("o%07d", "id")
    split = F.col("id") % 1000 == 0
    parts = F.when(split, F.array(F.lit(0), F.lit(1), F.lit(2))).otherwise(F.array(F.lit(0)))
    files = spark.range(n).select(name.alias("owner_slug"), split.alias("split"), F.explode(parts).alias("part"))
    return files.withColumn("n", (F.pmod(F.xxhash64("owner_slug", "part"), F.lit(90)) + 1).cast("long"))


def test_a_million_owners_are_packed_without_a_window_over_all(spark):
    files = many_files(spark, 1_000_000)
    tasks, n_tasks = file_tasks(files, 1000)
    plan = tasks._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") and "windowspecdefinition(owner_slug" in plan and "windowspecdefinition(bucket" in plan
    assert "SinglePartition" not in tasks._jdf.queryExecution().executedPlan().toString()
    joined = tasks.join(files, ["owner_slug", "part"])
    per_task = joined.groupBy("task").agg(F.sum("n").alias("n"), F.count("*").alias("files"), F.max("split").alias("split"))
    worst = per_task.agg(
        F.max("task").alias("last"),
        F.count("*").alias("tasks"),
        F.max(F.when(F.col("split"), F.col("files"))).alias("alone"),
        F.max(F.when(~F.col("split"), F.col("n"))).alias("most"),
    ).first()
    assert worst.last < n_tasks
    assert worst.alone == 1
    assert worst.most <= 500 + 90
    assert joined.count() == files.count()
    # Few tasks are left without a file.
    assert worst.tasks >= 0.9 * n_tasks


def test_numbers_of_split_names_follow_from_their_parts(spark):
    files = spark.createDataFrame([("a", 0, 5, True), ("a", 1, 7, True), ("a", 2, 2, True), ("b", 0, 4, False)], "owner_slug string, part int, n long, split boolean")
    tasks, _ = file_tasks(files, 10)
    assert rows(tasks.select("owner_slug", "part", "first")) == [("a", 0, 0), ("a", 1, 5), ("a", 2, 12), ("b", 0, 0)]


def test_nothing_to_pack(spark):
    files = many_files(spark, 0)
    tasks, n_tasks = file_tasks(files, 10)
    assert (tasks.count(), n_tasks) == (0, 1)


def test_compressed_files_are_read_and_imported_like_plain_ones(spark, review, schema, tmp_path):
    detail, reviews = review
    plain, packed = str(tmp_path / "plain"), str(tmp_path / "packed")
    export_review(detail, reviews, plain)
    export_review(detail, reviews, packed, compressed=True)
    assert len(list(Path(packed).glob("*/*.csv.gz"))) == 5 and not list(Path(packed).glob("*/*.csv"))
    names = REVIEW_DETAIL.names
    assert rows(read_reviews_csv(spark, packed).select(names)) == rows(read_reviews_csv(spark, plain).select(names))
    imported = import_reviews(spark, packed, f"{schema[0]}.access_review_import", str(tmp_path / "checkpoint"))
    assert rows(imported.select(names)) == rows(read_reviews_csv(spark, plain).select(names))
    assert imported.filter("import_file_name NOT LIKE '%.csv'").isEmpty()
