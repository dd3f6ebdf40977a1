import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from ledgerline.session import DEFAULT_CONF, ensure_checkpoint_dir
    builder = SparkSession.builder.master("local[4]").appName("ledgerline-tests")
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "4g")
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # tests set a checkpoint folder only where the session has none
    ensure_checkpoint_dir(s, fallback=tempfile.mkdtemp(prefix="ledgerline-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="ledgerline-test-")
