import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shardloom.session import attach


@pytest.fixture(scope="session")
def spark():
    builder = (
        SparkSession.builder.master("local[8,3]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("OFF")
    yield attach(session)
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="shardloom-test-")
