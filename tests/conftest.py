import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from basketflow.registry.common import Inputs  # noqa: E402
from basketflow.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", 8)
    session.sparkContext.setLogLevel("OFF")
    return session


@pytest.fixture(scope="session")
def x(spark):
    return Inputs(spark, SMALL)
