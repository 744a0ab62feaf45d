import sys
from pathlib import Path

import pytest

from strataflux.session import local_session

sys.path.insert(0, str(Path(__file__).parent))


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, 4, "4g")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def tiny():
    return "/root/testdata/sf0.001"
