import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lociframe.session import get_session, ship  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("tests", cores=4, shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    ship(s)
    return s
