import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from keyedlake.session import build_session, shared_root
    s = build_session("local[*]", app="keyedlake-tests", shuffle_partitions=8)
    shared_root(s)  # sets a local checkpoint folder only if the session names none
    yield s
    s.stop()


@pytest.fixture
def tmp_table(spark):
    from keyedlake.session import scratch_path
    return lambda name="t": scratch_path(spark, f"test-{name}")
