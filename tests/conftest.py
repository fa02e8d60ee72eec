import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from runledger.session import get_spark
    extra = {}
    # tests run on one machine: a scratch checkpoint folder only when none is configured
    from pyspark import SparkConf
    if not SparkConf().get("spark.checkpoint.dir", None):
        extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="runledger-test-ckpt-")
    s = get_spark("runledger-tests", master="local[4]", shuffle_partitions=4, extra=extra)
    yield s
