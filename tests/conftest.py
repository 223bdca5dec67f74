import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from spindle.session import get_spark
    ckpt = tempfile.mkdtemp(prefix="spindle-test-ckpt-")
    s = get_spark("local[*]", app="spindle-tests", shuffle_partitions=8,
                  conf={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(spark):
    from spindle.session import scratch_path
    # local tests write fixtures with plain file APIs: drop the URI scheme
    return scratch_path(spark, "test").removeprefix("file:")
