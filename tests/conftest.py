import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidepool.session import build_session, checkpoint_dir
    s = build_session("local[4]", shuffle_partitions=8,
                      extra={"spark.driver.memory": "6g"})
    checkpoint_dir(s)
    yield s
    s.stop()
