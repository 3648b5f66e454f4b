import os
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, REPO)
os.environ["PYTHONPATH"] = REPO + os.pathsep + os.environ.get("PYTHONPATH", "")


@pytest.fixture(scope="session")
def spark():
    from quire.session import local

    s = local("tests", cores=8, partitions=8, memory="8g")
    s.sparkContext.setLogLevel("ERROR")
    return s
