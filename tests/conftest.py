import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tidemark.session import SESSION_DEFAULTS

    b = (SparkSession.builder.master("local[*]").appName("tidemark-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false"))
    for k, v in SESSION_DEFAULTS.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # Tests set their own checkpoint folder only where the session has none.
    if not s.conf.get("spark.checkpoint.dir", None) and not s.sparkContext.getCheckpointDir():
        d = tempfile.mkdtemp(prefix="tidemark-test-ckpt-")
        s.conf.set("spark.checkpoint.dir", d)
    yield s


@pytest.fixture
def tmp(spark):
    from tidemark.session import scratch_dir
    return scratch_dir(spark, "tidemark-tests")


SF = "/root/testdata/sf0.001"
