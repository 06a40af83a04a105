import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from cargoline.session import local_session

    session = local_session(cores="*", shuffle_partitions=8, app="cargoline-tests")
    yield session
    session.stop()
