import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidemark import get_spark
    s = get_spark("local[4]", app="tidemark-tests", shuffle_partitions=8)
    # tests set their own checkpoint folder only when the session has none
    if not s.conf.get("spark.checkpoint.dir", None) and not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-test-ckpt-"))
    yield s


@pytest.fixture(scope="session")
def small_dir():
    return SMALL
