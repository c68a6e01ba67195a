import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from larkspur import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[*]", spark__sql__shuffle__partitions=4,
                            spark__driver__memory="6g",
                            spark__ui__showConsoleProgress="false")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def smallest_tables():
    folder = Path("/root/testdata/sf0.001")
    if not folder.exists():
        pytest.skip("the given tables are not here")
    return str(folder)
