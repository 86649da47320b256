import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from paths import SF_SMALL  # noqa: E402

from cartwise.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("cartwise-tests", "local[*]", 8)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck_small():
    from cartwise.plans.check import duck_connection
    return duck_connection(SF_SMALL)
