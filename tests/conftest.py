import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from assocspark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, app="tests", shuffle_partitions=4, memory="6g")
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Collected rows as sorted plain tuples."""
    def read(df, *columns):
        return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda r: [(x is not None, str(x)) for x in r])
    return read
