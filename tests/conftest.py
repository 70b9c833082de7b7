import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tillstar.session import get_session

    s = get_session("tillstar-tests", master="local[4]", shuffle_partitions=4)
    if not s.sparkContext.getCheckpointDir():
        # Tests only: the cluster names its own shared folder.
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tillstar-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="tillstar-test-")


def text_df(spark, cols, rows):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in cols])
    return spark.createDataFrame(rows, schema)
