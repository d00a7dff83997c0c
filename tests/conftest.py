import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from kiln.session import DEFAULT_CONF, clear_scratch, ensure_checkpoint_dir

    b = SparkSession.builder.master("local[4]").appName("kiln-tests") \
        .config("spark.sql.shuffle.partitions", "8") \
        .config("spark.checkpoint.dir", "file://" + tempfile.mkdtemp(prefix="kiln-test-ckpt-"))
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s
    clear_scratch(s)
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
