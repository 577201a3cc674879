from __future__ import annotations

import os
import sys

import pytest

_HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(_HERE), _HERE]

from cloakframe.session import local_session  # noqa: E402

DATA_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests", memory="6g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data_dir() -> str:
    return DATA_DIR
