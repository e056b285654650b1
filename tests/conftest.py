from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pairloom.session import local_session, ship  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores=4, shuffle_partitions=4, memory="3g")
    s.sparkContext.setLogLevel("ERROR")
    ship(s)
    yield s
    s.stop()
