import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from periodica.session import build_session
    ckpt = tempfile.mkdtemp(prefix="periodica-test-")
    s = build_session(master="local[4]", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture()
def lake(spark):
    from periodica.plans.registry import scratch_lake
    return scratch_lake(spark)
