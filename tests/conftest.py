import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TESTDATA = Path(os.environ.get("LOADSTAR_TESTDATA", "/root/testdata"))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[*]")
        .appName("loadstar-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.maxPlanStringLength", "100000000")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    path = TESTDATA / "sf0.001"
    if not path.exists():
        pytest.skip(f"no test tables in {path}")
    return str(path)


@pytest.fixture(scope="session")
def derived(spark, sf_dir):
    """The lazily derived star over the smallest tables."""
    from loadstar.sources.orders_star import derive_star

    return derive_star(spark, sf_dir)


@pytest.fixture(scope="session")
def stored(spark, sf_dir, tmp_path_factory):
    """The same star written by month and read back."""
    from loadstar.sources.orders_star import derive_star
    from loadstar.sources.warehouse import read_star, write_star

    path = str(tmp_path_factory.mktemp("star") / "star")
    write_star(derive_star(spark, sf_dir, by_month=True), path)
    return read_star(spark, path)
