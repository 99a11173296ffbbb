import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from check import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def inputs(spark):
    from querybook.fixtures import Inputs

    return Inputs(spark, "/root/testdata/sf0.001")
