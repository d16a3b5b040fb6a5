import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from brakelight.session import get_session
    s = get_session(master="local[4]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture
def tmp_dir(spark):
    import uuid
    from brakelight.session import scratch_path
    return scratch_path(spark, "tests", uuid.uuid4().hex[:12])
