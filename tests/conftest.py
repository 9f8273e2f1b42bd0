import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="homeledger-tests-"))
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "6g").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    from homeledger.session import configure
    yield configure(session)
    session.stop()
