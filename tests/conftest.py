import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")


@pytest.fixture(scope="session")
def spark():
    from curatrix.session import local_session, ship_package

    session = local_session("tests", cores=4, partitions=4)
    session.sparkContext.setLogLevel("OFF")
    ship_package(session)
    yield session
    session.stop()
