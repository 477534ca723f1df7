import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    spark = (SparkSession.builder.master("local[4]")
             .appName("delaystats-tests")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.execution.arrow.pyspark.enabled", "true")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir() and not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="delaystats-test-ckpt-"))
    yield spark
    spark.stop()


@pytest.fixture
def tmpdir_path():
    return tempfile.mkdtemp(prefix="delaystats-test-")
