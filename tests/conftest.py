import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tessera.session import DEFAULT_CONF

    b = SparkSession.builder.master("local[*]").appName("tessera-tests")
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    s = (b.config("spark.sql.shuffle.partitions", "8")
         .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tessera-test-ckpt-"))
         .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tessera-test-wh-"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
