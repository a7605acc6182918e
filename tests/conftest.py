import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__)))]

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (SparkSession.builder.master("local[8]")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("tables")))
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
               .config("spark.driver.memory", "8g"))
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set Spark settings, given as a dict, for one test."""
    before = {}

    def change(settings):
        for name, value in settings.items():
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)
    yield change
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def warehouse_inputs(spark, sf_dir):
    """Library, review sources and feeds, as written to files of their own."""
    from checks.fixtures import feeds, library, review_sources
    from checks.queries import _copy

    def stored(name, frame):
        return spark.read.parquet(_copy(spark, sf_dir, name, frame.write.parquet))
    return {
        "library": stored("library", library(spark, sf_dir)),
        "reviews": [stored(f"review_{i}", r)
                    for i, r in enumerate(review_sources(spark, sf_dir))],
        "feeds": {n: stored(f"feed_{n}", f) for n, f in feeds(spark, sf_dir).items()},
    }
