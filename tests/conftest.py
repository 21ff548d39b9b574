import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    builder = (SparkSession.builder.master("local[4]").appName("tabulon-tests")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.execution.arrow.pyspark.enabled", "true")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not (s.conf.get("spark.checkpoint.dir", None) or s.sparkContext.getCheckpointDir()):
        # only where the cluster does not name a shared folder
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tabulon-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def employees(spark):
    # The operator tour's inline tables.
    return spark.createDataFrame(
        [(1, "Mike", 28, "Male"), (2, "Lily", 30, "Female"), (3, "Raymond", 26, "Male"), (5, "Dave", 36, "Male")],
        "id bigint, name string, age bigint, gender string")


@pytest.fixture(scope="session")
def salaries(spark):
    return spark.createDataFrame([(1, 26000), (2, 30000), (4, 25000), (3, 20000)], "id bigint, salary bigint")
