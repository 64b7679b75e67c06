import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (SparkSession.builder.master("local[4]").appName("millrace-tests")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.ui.enabled", "false")
               .config("spark.driver.memory", "4g")
               .config("spark.driver.host", "localhost")
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    if session.conf.get("spark.checkpoint.dir", None) is None:
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
    yield session
    session.stop()


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "store")
