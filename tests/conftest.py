import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tradelake.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session("local[*]", app_name="tradelake-tests", shuffle_partitions=8)
    yield session
    session.stop()


@pytest.fixture()
def scratch(spark):
    from tradelake.session import scratch_path

    def make(name="t"):
        return scratch_path(spark, name)
    return make
