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

    from forumlens.session import tune

    s = (SparkSession.builder.master("local[4]")
         .appName("forumlens-tests")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.driver.memory", "8g")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    # Tests own their session, so they may pick the checkpoint folder.
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="forumlens-test-ckpt-"))
    tune(s)
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="forumlens-test-")
