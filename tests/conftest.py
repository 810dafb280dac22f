import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from shelfcast.session import ensure_checkpoint_dir

    sess = (
        SparkSession.builder.master("local[*]")
        .appName("shelfcast-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    sess.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(sess)
    yield sess


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)
