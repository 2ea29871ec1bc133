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

    builder = (
        SparkSession.builder.master("local[4]")
        .appName("querytrail-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    # Tests set their own shared dir only where the session has none.
    from querytrail.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(session)
    yield session
    session.stop()


@pytest.fixture()
def scratch():
    """A fresh scratch directory per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="qt-test-", dir="/tmp")


def messages(spark, texts):
    """A topic frame (``value binary``) from Python strings / bytes / None."""
    from pyspark.sql.types import BinaryType, StructField, StructType

    rows = [(None if t is None else (t if isinstance(t, bytes) else t.encode("utf-8")),) for t in texts]
    return spark.createDataFrame(rows, StructType([StructField("value", BinaryType(), True)]))
