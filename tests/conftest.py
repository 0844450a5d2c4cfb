import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("TZ", "UTC")


@pytest.fixture(scope="session")
def spark():
    from corpusloom.session import local_session

    session = local_session(cores=4, shuffle_partitions=4)
    yield session
    session.stop()
