import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from clusterfold.session import build_session, checkpoint_dir

    s = build_session("local[4]", shuffle_partitions=8, app_name="clusterfold-tests",
                      extra_conf={"spark.driver.memory": "8g"})
    checkpoint_dir(s)
    yield s
    s.stop()
