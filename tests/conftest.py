import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from netloom.session import ensure_checkpoint_dir

    s = (
        SparkSession.builder.master("local[4]")
        .appName("netloom-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="netloom-test-ckpt-"))
    ensure_checkpoint_dir(s)
    yield s
    from netloom.session import drop_scratch

    drop_scratch(s)


@pytest.fixture(scope="session")
def small(spark):
    from tests.small_fixture import small_network

    return small_network(spark)
