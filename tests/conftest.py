import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from tallyspark.session import make_session

    session = make_session("local[4]", 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
