import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from riskloom.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(cpus=os.environ.get("TEST_CPUS", "4"), shuffle_partitions=4, memory="6g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
