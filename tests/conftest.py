import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path[:0] = [str(Path(__file__).resolve().parent.parent), str(Path(__file__).resolve().parent)]

from core_helpers import SMALL  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[*]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        # Many small plans, each run once: compile them fast rather than well.
        .config("spark.driver.extraJavaOptions", "-XX:TieredStopAtLevel=1")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(folder / "warehouse"))
        .config("spark.checkpoint.dir", str(folder / "shared"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def schema(spark, tmp_path):
    """Name and folder of a new schema, dropped afterwards."""
    name = f"s_{abs(hash(str(tmp_path)))}"
    yield name, str(tmp_path / "schema")
    spark.sql(f"DROP SCHEMA IF EXISTS {name} CASCADE")


@pytest.fixture(scope="session")
def testbed(spark):
    from custodia.testbed import Testbed

    return Testbed(spark, SMALL)
