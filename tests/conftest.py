import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from meridian.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=4, app="meridian-tests")
    yield s


@pytest.fixture()
def tmp_root(spark):
    from meridian.session import fresh_path

    return fresh_path(spark, "test")
