import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from gazette.session import get_session
    spark = get_session(master="local[4]", app="gazette-tests", conf={
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    # tests only: a checkpoint folder when the session names none
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="gazette-ckpt-"))
    yield spark
    SparkSession.getActiveSession()


@pytest.fixture(scope="session")
def sf():
    return SF_SMALL
