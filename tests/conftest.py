from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from cartwheel.session import DEFAULT_CONF

    builder = SparkSession.builder.master("local[*]").appName("cartwheel-tests")
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", "8")
    # tests set their own checkpoint folder; on a cluster the session's is used
    builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="cartwheel-test-ckpt-"))
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("CARTWHEEL_TEST_SF", "/root/testdata/sf0.001")
