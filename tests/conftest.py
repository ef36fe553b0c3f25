import os

import pytest

from quillsieve.session import drop_materialised, local_session

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    yield session
    drop_materialised(session)


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
