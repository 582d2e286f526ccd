import os

import pytest

from orderrisk.session import local_session

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
SMALL_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(app="orderrisk-tests")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def small_dir():
    return SMALL_DIR


@pytest.fixture()
def folder(tmp_path):
    return str(tmp_path)
