import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark():
    from palimpsest.session import local_session

    session = local_session("tests", cpus=8, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
