import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from trainloom.session import DEFAULT_CONF, ensure_checkpoint_dir
    b = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "8")
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s


SF = "/root/testdata/sf0.001"
