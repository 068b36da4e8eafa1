import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark():
    from stockspark.session import build_session, drop_scratch

    session = build_session(
        "stockspark-tests", "local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8", spark__driver__memory="8g"
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    drop_scratch(session)
    session.stop()
