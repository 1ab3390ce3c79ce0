import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from corpusmill.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(8, 4, "6g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def data():
    d = Path("/root/testdata/sf0.001")
    if not d.exists():
        pytest.skip("no test tables")
    return str(d)
