import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
for folder in (ROOT, ROOT / "tests"):
    if str(folder) not in sys.path:
        sys.path.insert(0, str(folder))

from skylattice.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    running = session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions=8,
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    running.sparkContext.setLogLevel("ERROR")
    yield running
    running.stop()


@pytest.fixture(scope="session")
def small_sf():
    return "/root/testdata/sf0.001"
