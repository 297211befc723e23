from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from riskframe.plans.data import incident_data  # noqa: E402
from riskframe.session import local_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session("*", memory="6g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data(spark):
    return incident_data(spark, SF_DIR)
