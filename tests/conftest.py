import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from lagloom.session import build_session

    s = build_session(
        "tests", "local[4]", spark__ui__enabled="false", spark__sql__shuffle__partitions="4",
        spark__driver__memory="8g", spark__ui__showConsoleProgress="false",
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
