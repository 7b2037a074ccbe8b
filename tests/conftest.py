import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from shelfcast.session import DEFAULT_CONF, ensure_checkpoint_dir

    builder = SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # the session's spark.checkpoint.dir is used when set; tests only make
    # a folder of their own when it is not
    if not s.sparkContext.getCheckpointDir() and not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="shelfcast-test-ckpt-"))
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
