import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="tablewinnow-tests-")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tablewinnow-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", f"{scratch}/checkpoints")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(params=["broadcast", "shuffled"])
def join_path(request, spark):
    """Run a test with key sets broadcast, and again with none small enough."""
    if request.param == "shuffled":
        spark.conf.set("spark.tablewinnow.broadcastBytes", "0")
    yield request.param
    spark.conf.unset("spark.tablewinnow.broadcastBytes")


def rows(df, *columns):
    """The rows of a DataFrame as a sorted list of tuples, repeats included."""
    df = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in df.collect()), key=repr)
