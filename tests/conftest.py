import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sensoria.session import configure, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = configure(local_session(8, shuffle_partitions=4))
    session.conf.set("spark.sql.maxMetadataStringLength", "5000")
    yield session
    session.stop()
