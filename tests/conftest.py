import os

import pytest

from tests.compare import connect
from tests.session import local_session

SF_DIR = os.environ.get("LOADLENS_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    return local_session()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def duck(sf_dir):
    return connect(sf_dir)
